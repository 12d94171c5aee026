"""Capture files: listing, a Python data source that reads them, and a writer.

Reads the classic format in both byte orders and both time units, and pcapng, alone or as members of ZIP archives. A file is one
partition, since records can only be found one after the other. A file that can't be opened gives one row with an error
and no data; one that breaks off ends there.
"""

from __future__ import annotations

import io
import os
import re
import struct
import zipfile
from collections.abc import Iterator, Sequence
from glob import glob

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed values of the formats: magic numbers, and link types of files that a capture library names otherwise.
MAGIC_US, MAGIC_NS, MAGIC_NG = 0xA1B2C3D4, 0xA1B23C4D, 0x0A0D0D0A
RAW_IN_FILES = {101: 12}
SCHEMA = "file_ord int, frame_no bigint, ts_ns bigint, linktype int, caplen int, data binary, path string, error string"
_ARROW = pa.schema([("file_ord", pa.int32()), ("frame_no", pa.int64()), ("ts_ns", pa.int64()), ("linktype", pa.int32()), ("caplen", pa.int32()), ("data", pa.binary()), ("path", pa.string()), ("error", pa.string())])
BATCH = 4096


def natural(name: str) -> list:
    """Sort key that orders numbers in names by value."""
    return [(0, int(p), "") if p.isdigit() else (1, 0, p) for p in re.split(r"(\d+)", name) if p]


def directory(path: str) -> list[str]:
    """The .pcap files of a folder, not of its sub-folders, in natural order."""
    return [os.path.join(path, n) for n in sorted((n for n in os.listdir(path) if n.endswith(".pcap") and os.path.isfile(os.path.join(path, n))), key=natural)]


def pattern(text: str) -> list[str]:
    """Files of a glob pattern in lexicographic order, or the path itself; none is an error."""
    found = sorted(glob(text)) or ([text] if os.path.exists(text) else [])
    if not found:
        raise FileNotFoundError(text)
    return found


def dispatch(path: str) -> list[str]:
    """Captures and archives at a path: itself, or a folder's direct entries; others are left out."""
    entries = [os.path.join(path, n) for n in sorted(os.listdir(path), key=natural)] if os.path.isdir(path) else [path]
    return [e for e in entries if e.lower().rsplit(".", 1)[-1] in ("pcap", "pcapng", "zip")]


def frames_of(f: io.BufferedIOBase) -> Iterator[tuple[int, int, bytes]]:
    """(ts_ns in whole microseconds, link type, bytes) of each record of a capture; ends where the file breaks off."""
    head = f.read(24)
    if len(head) < 12:
        raise ValueError("no capture header")
    if struct.unpack("<I", head[:4])[0] == MAGIC_NG:
        yield from _pcapng(head, f)
        return
    for order in "<>":
        magic = struct.unpack(order + "I", head[:4])[0]
        if magic in (MAGIC_US, MAGIC_NS) and len(head) == 24:
            break
    else:
        raise ValueError("not a capture file")
    link = struct.unpack(order + "I", head[20:24])[0] & 0x0FFFFFFF
    link = RAW_IN_FILES.get(link, link)
    while len(record := f.read(16)) == 16:
        sec, part, caplen, _ = struct.unpack(order + "IIII", record)
        data = f.read(caplen)
        if len(data) < caplen:
            return
        micros = part // 1000 if magic == MAGIC_NS else part
        yield sec * 1_000_000_000 + micros * 1000, link, data


def _pcapng(first: bytes, f: io.BufferedIOBase) -> Iterator[tuple[int, int, bytes]]:
    """The packets of a file whose first bytes are read already; one block is held at a time."""
    order, links, ahead = "<", [], first

    def take(n: int) -> bytes:
        nonlocal ahead
        part, ahead = ahead[:n], ahead[n:]
        return part if len(part) == n else part + f.read(n - len(part))

    while len(head := take(8)) == 8:
        mark = b""
        if struct.unpack("<I", head[:4])[0] == MAGIC_NG:
            mark = take(4)
            order, links = "<" if mark == b"\x4d\x3c\x2b\x1a" else ">", []
        kind, size = struct.unpack(order + "II", head)
        if size < 12 + len(mark):
            return
        body = mark + take(size - 12 - len(mark))
        if len(body) < size - 12 or len(take(4)) < 4:
            return
        if kind == 1:
            link, units, at = struct.unpack(order + "H", body[:2])[0], 1_000_000, 8
            while at + 4 <= len(body):
                code, n = struct.unpack(order + "HH", body[at : at + 4])
                if code == 9 and n:
                    r = body[at + 4]
                    units = 2 ** (r & 127) if r & 128 else 10**r
                if code == 0:
                    break
                at += 4 + n + -n % 4
            links.append((RAW_IN_FILES.get(link, link), units))
        elif kind == 6 and len(body) >= 20:
            k, high, low, caplen, _ = struct.unpack(order + "IIIII", body[:20])
            if k >= len(links):
                return
            link, units = links[k]
            ticks = high << 32 | low
            yield ticks * 1_000_000 // units * 1000, link, body[20 : 20 + caplen]
        elif kind == 3 and links:
            yield 0, links[0][0], body[4:]


class _File(InputPartition):
    def __init__(self, file_ord: int, path: str):
        super().__init__(file_ord)
        self.file_ord, self.path = file_ord, path


class CaptureReader(DataSourceReader):
    def __init__(self, options):
        self.paths = json.loads(options["files"])

    def partitions(self) -> Sequence[InputPartition]:
        return [_File(k, p) for k, p in enumerate(self.paths)] or [_File(-1, "")]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        if partition.file_ord < 0:
            return
        held: list[tuple] = []
        number = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*held), _ARROW)], schema=_ARROW)

        def opened() -> Iterator[tuple[str, io.BufferedIOBase]]:
            if partition.path.lower().endswith(".zip"):
                with zipfile.ZipFile(partition.path) as z:
                    for name in z.namelist():
                        if name.lower().endswith((".pcap", ".pcapng")):
                            with z.open(name) as f:
                                yield f"{partition.path}!{name}", f
            else:
                with open(partition.path, "rb") as f:
                    yield partition.path, f

        path = partition.path
        try:
            for path, f in opened():
                for ts, link, data in frames_of(f):
                    held.append((partition.file_ord, number, ts, link, len(data), data, path, None))
                    number += 1
                    if len(held) == BATCH:
                        yield batch()
                        held = []
        except (OSError, ValueError, zipfile.BadZipFile) as x:
            held.append((partition.file_ord, number, None, None, None, None, path, str(x)))
        if held:
            yield batch()


class CaptureSource(DataSource):
    """Option files: a JSON list of paths, in the order of file_ord."""

    @classmethod
    def name(cls) -> str:
        return "capture"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CaptureReader:
        return CaptureReader(self.options)


def read_captures(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """Frames of capture files, with path and error; rows with an error are unreadable files."""
    spark.dataSource.register(CaptureSource)
    return spark.read.format("capture").option("files", json.dumps(list(files))).load()


def frames(captured: DataFrame) -> DataFrame:
    return captured.where("error is null").drop("path", "error")


def write_capture(packets: DataFrame, path: str, order: str) -> DataFrame:
    """Ethernet captures under path, one for each range of the order, named by it; returns (part, file, packets).

    Each file is written under another name and renamed when it is whole, so a task that runs again replaces its own file.
    """
    os.makedirs(path, exist_ok=True)
    parts = int(packets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = packets.select(order, "ts_ns", "data").repartitionByRange(parts, order).sortWithinPartitions(order)

    def write(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, n = context.partitionId(), 0
        name = os.path.join(path, f"part-{part:05d}.pcap")
        own = f"{name}.{context.taskAttemptId()}"
        with open(own, "wb") as f:
            f.write(struct.pack("<IHHiIII", MAGIC_US, 2, 4, 0, 0, 65535, 1))
            for b in batches:
                for ts, data in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                    f.write(struct.pack("<IIII", ts // 1_000_000_000, ts % 1_000_000_000 // 1000, len(data), len(data)) + data)
                    n += 1
        os.replace(own, name)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name]), pa.array([n], pa.int64())], names=["part", "file", "packets"])

    out = rows.mapInArrow(write, "part int, file string, packets bigint")
    return packets.sparkSession.createDataFrame(out.collect(), out.schema)  # a row for each file


def ordered(captured: DataFrame, name: str = "idx") -> DataFrame:
    """Frames with their number over all files, in the order of files and of frames in them."""
    from ..operators.ordering import row_numbers

    block = F.col("file_ord").cast("bigint") * (1 << 40) + F.floor(F.col("frame_no") / 65536).cast("bigint")
    return row_numbers(captured, ["file_ord", "frame_no"], block, name)
