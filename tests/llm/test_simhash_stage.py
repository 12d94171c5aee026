import random

from pktloom.llm import nearcopies, simhash


def test_simhash_index_proposes_candidates(spark, monkeypatch):
    rnd = random.Random(8)
    rows = []
    for g in range(6):
        base = [f"g{g}w{rnd.randrange(5000)}" for _ in range(1500)]
        rows += [(10 * g, " ".join(base)), (10 * g + 1, " ".join([*base[:-1], "end"])), (10 * g + 2, " ".join(rnd.choices(base, k=300)))]
    rows += [(90, ""), (91, None)]
    fps = {i: simhash.of_hashes([nearcopies.shingles(t)]) for i, t in rows if t}
    near = {(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= simhash.MAX_BITS}
    assert near
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    nodes = spark.createDataFrame([(i, signed(fps.get(i, 0)), [i] if t else []) for i, t in rows], "node bigint, fp bigint, keys array<bigint>")
    of = {r.node: r.v for r in nearcopies.lists(nodes).where("k = -1").collect()}
    assert set(of) == set(fps) and all(of[a] == of[b] for a, b in near)
    # the stage goes by them: with keys that never meet, it still finds these
    met = {r.node for r in nearcopies.lists(nodes).groupBy("k", "v").agg({"node": "max", "*": "count"}).where("`count(1)` > 1").withColumnRenamed("max(node)", "node").collect()}
    assert {b for _, b in near} <= met | {a for a, _ in near}
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    numbered = docs.withColumn("__row", docs.doc_id)
    got = {tuple(sorted((r.a, r.b))) for r in nearcopies.links(nodes, numbered).collect()}
    assert got == near
