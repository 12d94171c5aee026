import os

from pyspark.sql import functions as F

from pktloom.streaming import flows as streaming

from .test_streams import S, table

HOUR = 3600 * S


def run(spark, tmp_path, rows, build):
    """The rows go through as two files, an hour late: a watermark starts at 0 and leaves packets at 0 out."""
    df = table(spark, [(*r[:5], r[5] + HOUR, *r[6:]) for r in rows]).drop("src_sort", "dst_sort")
    half = len(rows) // 2
    for k, part in enumerate((df.where(F.col("idx") < half), df.where(F.col("idx") >= half))):
        part.coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        for f in (tmp_path / "in" / str(k)).glob("*.parquet"):
            os.utime(f, (1000 + k, 1000 + k))
    from pktloom.functions import columns as C

    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    source = source.withColumn("src_sort", C.ipv4_sort("src_ip")).withColumn("dst_sort", C.ipv4_sort("dst_ip"))
    query = build(source).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    query.awaitTermination(120)
    return spark.read.parquet(f"{tmp_path}/out").collect()


def test_sessions(spark, tmp_path):
    rows = [(1, 2, 5, 80, 6, t * S, 60) for t in (0, 60, 180, 400, 401)] + [(3, 4, 1, 1, 6, 402 * S, 50), (7, 8, 1, 1, 6, 9000 * S, 50), (7, 9, 1, 1, 6, 9001 * S, 50)]
    got = {(r.src_ip, r.session): (r.n, r.bytes, r.start_ts, r.end_ts) for r in run(spark, tmp_path, rows, streaming.stream_sessions)}
    assert got[("10.0.0.1", 0)] == (3, 180, HOUR, HOUR + 180 * S)
    assert got[("10.0.0.1", 1)] == (2, 120, HOUR + 400 * S, HOUR + 401 * S)
    assert got[("10.0.0.3", 0)] == (1, 50, HOUR + 402 * S, HOUR + 402 * S)


def flow_number(spark, tmp_path, retention):
    """Sessions of one flow, of which the watermark closes the first before the second comes."""
    early = [(1, 2, 5, 80, 6, 0, 60), (3, 4, 1, 1, 6, 1000 * S, 60), (3, 4, 1, 1, 6, 2000 * S, 60)]
    later = [(1, 2, 5, 80, 6, 5000 * S, 60), (3, 4, 1, 1, 6, 6000 * S, 60), (3, 4, 1, 1, 6, 9000 * S, 60)]
    df = table(spark, [(*r[:5], r[5] + HOUR, *r[6:]) for r in early + later]).drop("src_sort", "dst_sort")
    from pktloom.functions import columns as C

    for k, part in enumerate((df.where("idx < 2"), df.where("idx = 2"), df.where("idx = 3"), df.where("idx > 3"))):
        part.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/new")
        (tmp_path / "in").mkdir(exist_ok=True)
        next((tmp_path / "new").glob("*.parquet")).rename(tmp_path / f"in/{k}.parquet")
        source = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
        source = source.withColumn("src_sort", C.ipv4_sort("src_ip")).withColumn("dst_sort", C.ipv4_sort("dst_ip"))
        query = streaming.stream_sessions(source, retention_ns=retention).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        query.awaitTermination(120)
    return sorted((r.session, r.start_ts - HOUR) for r in spark.read.parquet(f"{tmp_path}/out").collect() if r.src_ip == "10.0.0.1")


def test_numbers_go_on_after_a_timeout(spark, tmp_path):
    assert flow_number(spark, tmp_path, streaming.RETENTION_NS) == [(0, 0), (1, 5000 * S)]


def test_state_of_flows_that_are_over_is_removed(spark, tmp_path):
    assert flow_number(spark, tmp_path, S) == [(0, 0), (0, 5000 * S)]


def test_segments(spark, tmp_path):
    rows = [(1, 2, 5, 80, 6, t * S, 60) for t in range(7)] + [(2, 1, 80, 5, 6, 100 * S, 60), (2, 1, 80, 5, 6, 101 * S, 60)] + [(7, 8, 1, 1, 6, 9000 * S, 50)]
    got = {r.segment_id: (r.start_idx, r.n, r.reason) for r in run(spark, tmp_path, rows, lambda p: streaming.stream_segments(p, cutoff=3)) if r.a_ip == "10.0.0.1"}
    assert got[0] == (0, 3, "cutoff") and got[1] == (3, 3, "cutoff") and got[2] == (6, 1, "timeout")
