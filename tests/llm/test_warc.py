import gzip
import hashlib
import io
import json

import duckdb
import pytest

from pktloom.llm import warc

LONG = "é<p>" * 50


def pages(spark):
    rows = [(5, "http://a/5", LONG), (2, "http://a/2", LONG), (2, "http://a/2", LONG), (9, None, None), (8, "u\r\nX: y", ""), (4, "a\x01b\x7f", "x"), (None, "n", LONG), (7, "s", "short"), (6, "s", "short"), (1, "big", "x" * 300000), (3, "tricky", "a\r\n\r\nWARC/1.1\r\n\r\n" * 20)]
    return rows, spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS digest", "2 AS row_id", "3 AS n")


def test_round_trip(spark):
    rows, df = pages(spark)
    got = warc.round_trip(df).collect()
    want = {(i, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest()) for i, _, h in rows}
    assert len(got) == len(rows) and {(r.page_id, r.payload_bytes, r.payload_digest) for r in got} == want
    long = [(r.page_id, r.record_type, r.refers_to) for r in got if r.payload_bytes == len(LONG.encode())]
    assert sorted(long, key=str) == sorted([(2, "response", None), (2, "revisit", 2), (5, "revisit", 2), (None, "revisit", 2)], key=str)
    assert all(r.record_type == "response" for r in got if r.payload_bytes < 100)
    assert {r.page_id: r.target_uri for r in got if r.page_id in (4, 8)} == {4: "a%01b%7F", 8: "u%0D%0AX: y"}
    assert warc.round_trip(df.where("false")).count() == 0


def test_push_down_and_skipping(spark, tmp_path):
    rows, df = pages(spark)
    path = str(tmp_path / "w")
    warc.write_archives(df.repartition(3), path)
    back = warc.read_archives(spark, path, partition_bytes=1000)
    assert back.where("record_type = 'revisit'").count() == 3
    assert {r.page_id for r in back.where("page_id in (7, 6)").collect()} == {6, 7}
    assert back.where("record_type = 'response' and page_id > 6").count() == 3
    bare = warc.read_archives(spark, path, payloads=False).collect()
    assert len(bare) == len(rows) and all(r.payload is None for r in bare)
    plan = back.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" not in plan or "record_type" in plan


class Counting(io.BytesIO):
    def __init__(self, data):
        super().__init__(data)
        self.got = 0

    def read(self, n=-1):
        data = super().read(n)
        self.got += len(data)
        return data


def record(kind, body, **more):
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in more.items()), f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def test_unwanted_blocks_are_not_read():
    data = record("warcinfo", b"i" * 1000) + record("response", b"r" * 500, Folded="a\r\n b") + record("request", b"q" * 2000)
    f = Counting(data)
    found = list(warc.records(f, lambda h: h["warc-type"] == "response"))
    assert f.got == 500 and found[0][0]["folded"] == "a b" and found[0][1] == b"r" * 500
    with pytest.raises(warc.BrokenArchive):
        list(warc.records(io.BytesIO(data[:-1500])))
    with pytest.raises(warc.BrokenArchive):
        list(warc.records(io.BytesIO(b"junk\r\n")))


def test_partitions_and_filters(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan

    reader = warc.WarcReader({"files": json.dumps([["a", 10], ["b", 30], ["c", 20]]), "partitionBytes": "30"})
    assert sorted(sorted(p.paths) for p in reader.partitions()) == [["a", "c"], ["b"]]
    keep = GreaterThan(("page_id",), 3)
    assert list(reader.pushFilters([EqualTo(("record_type",), "response"), keep, EqualTo(("payload",), b"x")])) != [] and len(reader.checks) == 1
    path = tmp_path / "x.warc.gz"
    path.write_bytes(gzip.compress(record("response", b"one")) + gzip.compress(record("request", b"two")))
    reader = warc.WarcReader({"files": json.dumps([[str(path), 1]])})
    list(reader.pushFilters([EqualTo(("record_type",), "request")]))
    assert [b.column("payload").to_pylist() for b in reader.read(reader.partitions()[0])] == [[b"two"]]


def test_query_against_sql(spark):
    from pktloom.llm.queries import ORACLE_SQL, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = con.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({ORACLE_SQL['op9_warc']})").fetchall()
    got = [tuple(r)[:5] for r in QUERIES["op9_warc"](spark, sf).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got) == sorted(want)
