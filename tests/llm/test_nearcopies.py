import random

import corpus_pipeline
from pktloom.llm import nearcopies, simhash


def slow_shingles(text):
    words = (text or "").lower().encode().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_kept(rows):
    sets, up = [slow_shingles(t) for _, t in rows], list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                up[root(a)] = root(b)
    groups = {}
    for k, (i, _) in enumerate(rows):
        groups.setdefault(root(k), []).append((i is None, i or 0, k))
    return sorted((rows[min(g)[2]] for g in groups.values()), key=str)


def test_stage_drops_by_similarity_and_not_by_fingerprint(spark):
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    a, b = " ".join(words), " ".join([*words[:285], *(f"y{i}" for i in range(15))])
    few = " ".join(rnd.choices(words, k=8))
    assert (simhash.fingerprint(a) ^ simhash.fingerprint(b)).bit_count() > simhash.MAX_BITS
    rows = [(1, a, "en", "s", 0), (2, b, "en", "s", 0), (3, " ".join(words[:200]) + few, "en", "s", 0)]
    # repeats outweigh what differs: equal fingerprints, and another set of shingles
    c = "a b c " * 400
    rows += [(4, c, "en", "s", 0), (5, c + " ".join(f"z{i}" for i in range(6)), "en", "s", 0)]
    assert (simhash.fingerprint(rows[3][1]) ^ simhash.fingerprint(rows[4][1])).bit_count() <= simhash.MAX_BITS
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [1, 3, 4, 5]


def test_against_brute_force(spark):
    rnd = random.Random(5)
    rows = [(None, None), (9, ""), (8, "One"), (7, "one"), (6, " \n")]
    for g in range(25):
        base = [f"g{g}w{rnd.randrange(400)}" for _ in range(rnd.randint(4, 150))]
        for _ in range(rnd.randint(1, 6)):
            own = list(base)
            for _ in range(rnd.randint(0, max(1, len(own) // 40))):
                own[rnd.randrange(len(own))] = f"n{rnd.random()}"
            rows.append((rnd.choice([None, *range(10, 60)]), " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = sorted(((r.doc_id, r.text) for r in nearcopies.one_of_each(df).collect()), key=str)
    assert got == slow_kept(rows) and len(got) < len(rows)


def test_forest_of_blocks():
    rnd = random.Random(6)
    sets = [nearcopies.shingles(" ".join(rnd.choices("a b c d".split(), k=rnd.randint(5, 9)))) for _ in range(80)]
    similar = lambda x, y: 9 * len(set(x) & set(y)) >= 4 * (len(x) + len(y))
    import numpy as np

    left, right = np.arange(0, 40), np.arange(40, 80)
    got = nearcopies.forest(sets, left, right)
    assert all(similar(sets[a], sets[b]) for a, b in got)
    linked = {a for a, _ in got} | {b for _, b in got}
    assert linked == {x for a in left for b in right if similar(sets[a], sets[b]) for x in (a, b)}
