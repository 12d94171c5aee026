import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from pktloom.functions import columns as C


def packets(spark, rows):
    """rows: (src_ip, src_port, dst_ip, dst_port)"""
    df = spark.createDataFrame([(i, *r, 6) for i, r in enumerate(rows)], "idx bigint, src_ip string, src_port int, dst_ip string, dst_port int, protocol int")
    return df.withColumn("src_sort", C.ip_sort("src_ip")).withColumn("dst_sort", C.ip_sort("dst_ip"))


def test_canonical_key(spark):
    rows = [("10.0.0.1", 80, "9.0.0.255", 5), ("10.0.0.1", 90, "10.0.0.1", 80), ("9.0.0.1", 1, "10.0.0.1", 2), ("::1", 5, "255.255.255.255", 6)]
    got = [tuple(r)[1:5] for r in packets(spark, rows).select("idx", *C.canonical_key()).orderBy("idx").collect()]
    assert got == [("9.0.0.255", 5, "10.0.0.1", 80), ("10.0.0.1", 80, "10.0.0.1", 90), ("9.0.0.1", 1, "10.0.0.1", 2), ("255.255.255.255", 6, "::1", 5)]


def test_swapping_endpoints_keeps_the_key(spark):
    rnd = random.Random(1)
    one = lambda: (f"10.0.{rnd.randrange(3)}.{rnd.randrange(3)}", rnd.randrange(3))
    rows = [(*one(), *one()) for _ in range(200)]
    a = packets(spark, rows).select("idx", *C.canonical_key()).collect()
    b = packets(spark, [(*r[2:], *r[:2]) for r in rows]).select("idx", *C.canonical_key()).collect()
    assert sorted(a) == sorted(b)


def test_addresses(spark):
    rnd = random.Random(2)
    six = [ipaddress.IPv6Address(bytes(rnd.choice([0, 0, 0, rnd.randrange(256)]) for _ in range(16))) for _ in range(300)]
    six += list(map(ipaddress.IPv6Address, ["::", "::1", "1::", "fe80::1:0:0:1", "1:0:0:2:0:0:0:3", "::ffff:10.0.0.1", "2001:db8::1:1:1:1:1", "1:2:3:4:5:6:7:0"]))
    df = spark.createDataFrame([(a.packed, a.exploded if k % 2 else str(a)) for k, a in enumerate(six)], "raw binary, said string")
    for a, r in zip(six, df.select(C.ipv6_text(F.col("raw")).alias("text"), C.ip_sort("said").alias("sort")).collect()):
        assert ipaddress.IPv6Address(r.text) == a and r["sort"] == b"\x06" + a.packed
        if a.ipv4_mapped is None and "0:0" not in str(a) and ":0:" not in str(a):
            assert r.text == str(a)
    bad = spark.createDataFrame([(x,) for x in ["", "1.2.3", "1.2.3.256", "1.2.3.4.5", "x", "1::2::3", ":::", "1:2:3", "12345::", "1:2:3:4:5:6:7:8:9"]], "ip string")
    assert all(r[0] is None for r in bad.select(C.ip_sort("ip")).collect())
    ok = spark.createDataFrame([("::ffff:1.2.3.4",)], "ip string").select(C.ip_sort("ip")).first()[0]
    assert ok == b"\x06" + ipaddress.IPv6Address("::ffff:1.2.3.4").packed


def test_dialects(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert [one(C.code_to_protocol(F.lit(272), d)) for d in ("flow", "pretrain", "finetune")] == [6, 17, 6]
    assert [one(C.protocol_to_code(F.lit(6), F.lit(58), d)) for d in ("pretrain", "finetune")] == [6, 514]
    assert [one(C.service_port(F.lit(a), F.lit(b))) for a, b in ((50000, 60000), (0, 0), (0, 8080))] == [50000, 0, 8080]
    assert one(C.h32(F.lit("10.0.0.1|5"))) == 941583001
    for bad in (lambda: C.code_to_protocol(F.lit(1), "x"), lambda: C.protocol_to_code(F.lit(4), F.lit(1), "flow"), lambda: C.field7(F.lit(4), F.lit(1), "x", "pretrain"), lambda: C.to_ns(F.lit(1), "ms")):
        with pytest.raises(ValueError):
            bad()


def test_flow_hash_is_salted(spark):
    r = spark.createDataFrame([("a", 1)], "x string, y int").select(C.flow_hash(["x", "y"]).alias("a"), C.flow_hash(["x", "y"], "s").alias("b"), C.flow_hash(["x", "y"], "t").alias("c")).first()
    assert len({r.a, r.b, r.c}) == 3


def test_fixed6(spark):
    rnd = random.Random(4)
    values = [0.0, -0.5, 580.1343445, 0.0000005, 1 / 128, 3 / 128, 8.9e9, 1e12, -2.0000005, *(rnd.randrange(10**12) / 1e9 for _ in range(500)), *(rnd.random() * 10 ** rnd.randrange(-8, 9) for _ in range(500)), *(rnd.randrange(10**9) * 1e-7 for _ in range(500))]
    got = [r.s for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", C.fixed6(F.col("v")).alias("s")).orderBy("i").collect()]
    assert got == [f"{v:.6f}" for v in values]
