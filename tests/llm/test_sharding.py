import math
import zlib
from collections import Counter

import xxhash

from pktloom.llm import sharding


def test_placement(spark):
    rows = [(i, "é" * (i % 7) if i % 5 else None) for i in range(3000)] + [(7, "twice")] * 5000 + [(None, "x")] * 3 + [(8, "y" * 200000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS slot", "2 AS shard", "'q' AS __n")
    got = sharding.placement(df, [1.0] * 16, [1.0] * 17).collect()
    assert sorted(str((r.doc_id, r.size, r.text_crc32)) for r in got) == sorted(str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for i, t in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
        assert r.grown_shard in (r.shard, 16) and 0 <= r.shard < 16 and r.law == "key"
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and len(by) == 16
    of = {}
    for r in got:
        of.setdefault(r.doc_id, set()).add((r.shard, r.grown_shard))
    assert all(len(x) == 1 for x in of.values())
    assert sharding.placement(df.where("false"), [1.0] * 16, [1.0] * 17).count() == 0


def test_weights_and_moves(spark):
    df = spark.range(40000)
    shards = sharding.assign(df, ["id"], [1, 2, 0, 5])
    n = Counter(r.shard for r in shards.collect())
    assert 2 not in n and abs(n[0] / 40000 - 1 / 8) < 0.01 and abs(n[1] / 40000 - 2 / 8) < 0.01
    fewer = {r.id: r.shard for r in sharding.assign(df, ["id"], [1, 2, 0]).collect()}
    assert all(fewer[r.id] == r.shard for r in shards.collect() if r.shard != 3)


def slow_shard(key, weights):
    """The least of -ln(u) / weight over the shards, each draw from the hash of the key's eight bytes and, after it, the shard's four."""
    seed = xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)
    draws = []
    for s, w in enumerate(weights):
        u = ((xxhash.xxh64_intdigest(s.to_bytes(4, "little"), seed) >> 11) + 0.5) * 2.0**-53
        draws.append((-math.log(u) / w, s))
    return min(draws)[1]


def test_query_against_plain_draws(spark):
    from pktloom.llm.queries import QUERIES

    got = QUERIES["op5_rendezvous_sharding"](spark, "/root/testdata/sf0.001").collect()
    assert got and all((r.shard, r.grown_shard) == (slow_shard(r.doc_id, [1.0] * 16), slow_shard(r.doc_id, [1.0] * 17)) for r in got)
    weights = [1.0, 2.5, 0.25, 4.0]
    df = spark.range(-500, 500)
    assert {r.id: r.shard for r in sharding.assign(df, ["id"], weights).collect()} == {i: slow_shard(i, weights) for i in range(-500, 500)}


def test_query_is_whole_and_even(spark):
    from pktloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op5_rendezvous_sharding"](spark, sf).collect()
    n = Counter(r.shard for r in got)
    assert sum(n.values()) == spark.read.parquet(f"{sf}/documents.parquet").count() and max(n.values()) < 2 * min(n.values())
    moved = sum(r.grown_shard == 16 for r in got)
    assert abs(moved / len(got) - 1 / 17) < 0.03


def test_native(spark):
    from pktloom.llm.queries import QUERIES

    plan = QUERIES["op5_rendezvous_sharding"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
