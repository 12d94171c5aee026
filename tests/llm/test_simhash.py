import random

import xxhash
from pyspark.sql import functions as F

from pktloom.llm import simhash
from pktloom.llm.components import components


def slow_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()]
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(ids_fps):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, (a, f) in enumerate(ids_fps):
        for b, g in ids_fps[:i]:
            if (f ^ g).bit_count() <= 3 and root(a) != root(b):
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {a: root(a) for a, _ in ids_fps}


def test_position_sets_cover():
    from itertools import combinations

    for width in (3, 4, 5):
        sets = simhash.position_sets(width)
        assert all(any(set(s) <= set(x) for s in sets) for x in combinations(range(8), 5))


def test_fingerprint_matches_definition():
    rnd = random.Random(1)
    texts = [None, "", " \t\n", "One", "one Two", "É a\x0bb c d", *(" ".join(rnd.choices("aB cd Éf gh ij".split(), k=n)) for n in range(1, 60))]
    assert [simhash.fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]


def test_links_connect_what_brute_force_connects(spark):
    rnd = random.Random(2)
    base = [rnd.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base[:20]:
        x = b
        for _ in range(12):
            for _ in range(rnd.randint(1, 3)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp bigint")
    for block in (4, 512):
        got = {r.node & (2**64 - 1): r.root for r in components(simhash.links(df, block=block)).collect()}
        want = slow_components([(f, f) for f in fps])
        classes = {}
        for f in fps:
            classes.setdefault(want[f], set()).add(f)
        mine = {}
        for f, r in got.items():
            mine.setdefault(r, set()).add(f)
        assert sorted(map(sorted, mine.values())) == sorted(sorted(c) for c in classes.values() if len(c) > 1)


def test_near_duplicates_edge_cases(spark):
    long = " ".join(f"w{i}" for i in range(4000))
    rows = [(5, long), (3, long), (3, long), (9, None), (8, ""), (None, "alone here now"), (7, "alone Here now"), (1, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("fp", F.lit("clash")).withColumn("k", F.lit(1))
    got = sorted(((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(df).collect()))
    assert got == [(-1, 7), (1, 1), (3, 3), (3, 3), (5, 3), (7, 7), (8, 8), (9, 8)]
    assert simhash.near_duplicates(df.where("false")).count() == 0


def test_query_against_brute_force(spark):
    from pktloom.llm.queries import QUERIES

    rows = QUERIES["op2_simhash_near_dedup"](spark, "/root/testdata/sf0.001").collect()
    want = slow_components([(r.doc_id, int(r.fingerprint, 16)) for r in sorted(rows)])
    assert {r.doc_id: r.component_id for r in rows} == want


def test_components_chain(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(201)) and got[501] == got[500] == 500
