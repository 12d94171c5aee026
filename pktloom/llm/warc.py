"""WARC archives: a Spark writer, and a Python data source that reads them.

The reader plans archive files into partitions of about equal bytes, takes record-type and header predicates from
Spark's filter push-down, parses a record's headers first, and seeks past the payloads of records
that the predicates reject or of all records, where payloads are not wanted. Payloads of
.gz archives are skipped by decompressing without keeping them.

Archives are written by Spark's text writer, whose commit survives lost executors in any store: a record is its header,
a blank line and its block, and the writer's line separator is the two line ends that close a record.
"""

from __future__ import annotations

import gzip
import io
import json
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, IsNotNull

from .common import new_path, written

END = "\r\n"
VERSION = "WARC/1.1"
#: Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads shorter than this are always stored.
MIN_REVISIT = 100
#: Archive bytes of a partition, as far as whole files allow.
PARTITION_BYTES = 64 << 20
#: Bytes of payload in a batch of the reader.
BATCH_BYTES = 8 << 20

#: Columns that are headers; a predicate on one is checked before the block is read.
HEADERS = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "warc_date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to_id": "warc-refers-to",
    "page_id": "x-page-id",
    "refers_to": "x-refers-to-page-id",
    "payload_length": "x-payload-length",
    "content_length": "content-length",
}
_LONG = {"page_id", "refers_to", "payload_length", "content_length"}
SCHEMA = ", ".join([*(f"{c} {'bigint' if c in _LONG else 'string'}" for c in HEADERS), "payload binary"])
_ARROW = pa.schema([*((c, pa.int64() if c in _LONG else pa.string()) for c in HEADERS), ("payload", pa.binary())])


class BrokenArchive(ValueError):
    """The file is not a sequence of records."""


def _opened(uri: str) -> io.BufferedIOBase:
    """A file of the local or shared file system, or of a store that Arrow knows."""
    if "://" not in uri and uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:")
    if uri.startswith("file://"):
        f = open(uri.removeprefix("file://"), "rb")  # noqa: SIM115
    elif "://" in uri:
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(uri)
        f = pa.PythonFile(store.open_input_file(path))
    else:
        f = open(uri, "rb")  # noqa: SIM115
    return gzip.GzipFile(fileobj=f) if uri.endswith(".gz") else f


def records(f: io.BufferedIOBase, wanted=None, payloads: bool = True) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, payload) of each record whose headers are wanted; other blocks are passed over unread.

    Header names are lower-case. The payload is the block, without the HTTP header of a response; a revisit has none.
    """
    while True:
        line = f.readline()
        while line in (b"\r\n", b"\n"):
            line = f.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise BrokenArchive(f"no record starts with {line[:40]!r}")
        headers: dict[str, str] = {}
        last = None
        while (line := f.readline()) not in (b"\r\n", b"\n"):
            if not line:
                raise BrokenArchive("a header is cut off")
            if line[:1] in b" \t" and last:
                headers[last] += " " + line.strip().decode("utf-8", "replace")
                continue
            name, _, value = line.partition(b":")
            last = name.strip().decode("latin-1").lower()
            headers[last] = value.strip().decode("utf-8", "replace")
        n = int(headers.get("content-length", 0))
        if wanted is not None and not wanted(headers):
            f.seek(n, io.SEEK_CUR)
            continue
        if not payloads or headers.get("warc-type") == "revisit":
            f.seek(n, io.SEEK_CUR)
            yield headers, None
            continue
        block = f.read(n)
        if len(block) < n:
            raise BrokenArchive("a block is cut off")
        if headers.get("content-type", "").startswith("application/http"):
            _, _, block = block.partition(b"\r\n\r\n")
        yield headers, block


class _Files(InputPartition):
    def __init__(self, paths: Sequence[str]):
        super().__init__(0)
        self.paths = paths


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.files = json.loads(options["files"])
        self.payloads = options.get("payloads", "true").lower() == "true"
        self.partition_bytes = int(options.get("partitionbytes", options.get("partitionBytes", PARTITION_BYTES)))
        self.checks: list[tuple[str, frozenset | None]] = []

    def pushFilters(self, filters) -> Iterable:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in HEADERS and isinstance(f, EqualTo):
                self.checks.append((name, frozenset([f.value])))
            elif name in HEADERS and isinstance(f, In):
                self.checks.append((name, frozenset(f.value)))
            elif name in HEADERS and isinstance(f, IsNotNull):
                self.checks.append((name, None))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Whole files, largest first, each to the lightest partition."""
        total = sum(size for _, size in self.files)
        n = max(1, min(len(self.files), -(-total // self.partition_bytes)))
        bins: list[list[str]] = [[] for _ in range(n)]
        load = [(0, k) for k in range(n)]
        import heapq

        for path, size in sorted(self.files, key=lambda x: (-x[1], x[0])):
            held, k = heapq.heappop(load)
            bins[k].append(path)
            heapq.heappush(load, (held + size, k))
        return [_Files(b) for b in bins if b] or [_Files([])]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for name, values in self.checks:
            value = headers.get(HEADERS[name])
            if value is None or values is not None and (int(value) if name in _LONG else value) not in values:
                return False
        return True

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*held), _ARROW)], schema=_ARROW)

        for path in partition.paths:
            with _opened(path) as f:
                for headers, payload in records(f, self._wanted if self.checks else None, self.payloads):
                    row = [headers.get(h) for h in HEADERS.values()]
                    row = [int(v) if c in _LONG and v is not None else v for c, v in zip(HEADERS, row)]
                    held.append((*row, payload))
                    size += 500 + len(payload or b"")
                    if size >= BATCH_BYTES:
                        yield batch()
                        held, size = [], 0
        if held:
            yield batch()


class WarcDataSource(DataSource):
    """Options: files (JSON list of [path, bytes]), payloads (false: no block is read), partitionBytes."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read_archives(spark: SparkSession, path: str, payloads: bool = True, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """The records under a path, by the data source `warc`. Spark lists the files, so the path may be in any store."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    files = [[r.path, r.length] for r in listed.toLocalIterator()]
    options = {"files": json.dumps(files), "payloads": str(payloads).lower(), "partitionBytes": str(partition_bytes)}
    return spark.read.format("warc").options(**options).load()


def _uuid(*of) -> F.Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in of]))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _header(name: str, value) -> F.Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """One record for each row of pages, under path.

    Of rows with equal payloads of at least MIN_REVISIT bytes the one with the least page_id (nulls last, then the
    first in the table) is the response and the others revisit it; rows with smaller payloads are all responses. Null html
    is empty. Null ids and urls have no header. Control characters in a url are percent-encoded.

    The repeated digests are found on digests alone and their number decides how they meet the pages: Spark
    broadcasts the table of them under its size limit and sorts and merges beyond it, split where a digest is hot.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"),
        F.octet_length(html).cast("bigint").alias("n"), F.sha2(html.cast("binary"), 256).alias("digest"),
    )
    rank = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row_id")
    groups = rows.where(F.col("n") >= MIN_REVISIT).groupBy("digest").agg(F.count("*").alias("copies"), F.min(rank).alias("kept")).where("copies > 1")
    groups = written(groups.select("digest", F.col("kept.page_id").alias("first_page"), F.col("kept.row_id").alias("first_row")), "payloads")
    rows = rows.join(groups, "digest", "left")
    again = F.col("first_row").isNotNull() & (F.col("first_row") != F.col("row_id"))
    encoded = F.col("url")
    for code in (*range(0x20), 0x7F):
        encoded = F.replace(encoded, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    url = F.when(F.col("url").rlike(r"[\x00-\x1f\x7f]"), encoded).otherwise(F.col("url"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit(END * 2))
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))
    header = F.concat_ws(
        END,
        F.lit(VERSION),
        F.when(again, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        _header("WARC-Record-ID", _uuid(F.col("page_id"), F.col("row_id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(again, _header("WARC-Profile", F.lit(REVISIT_PROFILE))),
        F.when(again, _header("WARC-Refers-To", _uuid(F.col("first_page"), F.col("first_row")))),
        F.when(again, _header("X-Refers-To-Page-Id", F.col("first_page"))),
        _header("X-Page-Id", F.col("page_id")),
        _header("X-Payload-Length", F.col("n")),
        F.lit("Content-Type: application/http; msgtype=response"),
        _header("Content-Length", F.octet_length(block)),
    )
    rows.select(F.concat(header, F.lit(END * 2), block).alias("value")).write.option("lineSep", END * 2).text(path)


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri) of each page's record, read back.

    Length and digest of a response come from the payload that is read back; a revisit has no payload, and its headers
    have both. An empty table gives an empty one.
    """
    spark = pages.sparkSession
    path = new_path(spark, "archives")
    write_archives(pages, path, **columns)
    back = read_archives(spark, path)
    return back.select(
        "page_id",
        F.coalesce(F.octet_length("payload").cast("bigint"), F.col("payload_length")).alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type",
        "refers_to",
        "target_uri",
    )
