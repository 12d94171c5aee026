import hashlib
import random
import re

import duckdb
import pytest

from pktloom.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def slow(text, bench):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    w = WORD.findall(low(text))
    hit, items = set(), set()
    for item, t in bench:
        b = WORD.findall(low(t))
        for i in range(max(1, len(b) - 9) if b else 0):
            win = b[i : i + 10]
            for j in range(len(w) - len(win) + 1):
                if w[j : j + len(win)] == win:
                    hit.update(range(j, j + len(win)))
                    items.add(item)
    return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest(), bool(hit)


def data():
    rnd = random.Random(5)
    vocab = ["a", "B", "Éa", "ß9", "x", "日本"]
    bench = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([0, 2, 9, 10, 11, 25])))) for i in range(12)] + [(99, None), (3, "only three words")]
    docs = []
    for i in range(60):
        t = " ".join(rnd.choices(vocab, k=rnd.randint(0, 60)))
        if i % 3 == 0:
            t += ", " + rnd.choice(bench)[1].__str__() + "! " + t
        docs.append((i, t))
    return docs + [(100, None), (100, None), (101, ""), (None, "x " * 30000), (5, docs[5][1])], bench


@pytest.mark.parametrize("bound", [2_000_000, 40])
def test_against_brute_force(spark, bound):
    docs, bench = data()
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS hits", "'r' AS `row`")
    b = spark.createDataFrame(bench, "item_id bigint, text string")
    got = sorted(map(tuple, dc.report(d, b, max_words=bound).collect()), key=str)
    want = sorted([(i, *slow(t if len(t or "") < 9999 else "x " * 200, bench)) if i is not None else None for i, t in docs if i is not None], key=str)
    assert [g for g in got if g[0] is not None] == want
    assert [g for g in got if g[0] is None][0][1] == 30000


def test_windows_of_pieces(spark, monkeypatch):
    """A long item in small pieces has all its windows, and no others."""
    monkeypatch.setattr(dc, "PIECE", 7)
    rnd = random.Random(6)
    long = [f"w{rnd.randrange(30)}" for _ in range(100)]
    got = [(r.piece, bytes(r.said).split(b" ")) for r in dc.pieces(spark.createDataFrame([(1, " ".join(long)), (2, "a b"), (3, None)], "item bigint, item_text string"), 10).collect() if r.item == 1]
    seen = [tuple(w[i : i + 10]) for _, w in sorted(got) for i in range(len(w) - 9)]
    assert seen == [tuple(x.encode() for x in long[i : i + 10]) for i in range(91)]
    whole = dc.WindowSet([(1, " ".join(long).encode())])
    cut = dc.WindowSet([(1, b" ".join(w)) for _, w in got])
    for _ in range(100):
        i, j = rnd.randrange(95), rnd.randrange(95)
        found = [x.encode() for x in (*long[i : i + 15], "x", *long[j : j + 11])]
        a, b = whole.scan(found), cut.scan(found)
        assert a[0].tolist() == b[0].tolist() and a[1] == b[1]
    # neither the joint text nor the words' hashes alone make a hit
    one = dc.WindowSet([(5, b"ab c")])
    assert one.scan([b"a", b"bc"])[1] == set() and one.scan([b"ab", b"c"])[1] == {5}


def test_empty_tables(spark):
    docs, bench = data()
    d, b = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(bench, "item_id bigint, text string")
    assert dc.report(d.where("false"), b).count() == 0
    assert not any(r.contaminated for r in dc.report(d, b.where("false")).collect())


def test_cleaned(spark):
    b = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id bigint, text string")
    text = "Before: One, two three four five six seven eight nine ten eleven! after"
    d = spark.createDataFrame([(1, text, "en"), (2, "clean", "en"), (3, None, None)], "doc_id bigint, text string, lang string")
    assert sorted(r.doc_id for r in dc.cleaned(d, b).collect()) == [2, 3]
    spans = {r.doc_id: r.text for r in dc.cleaned(d, b, remove="spans").collect()}
    assert spans == {1: "Before: ! after", 2: "clean", 3: None}
    assert dc.cleaned(d, b).columns == d.columns == dc.cleaned(d, b, remove="spans").columns


def test_query_against_sql(spark):
    from pktloom.llm.queries import ORACLE_SQL, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.execute(f"SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM ({ORACLE_SQL['op3_benchmark_decontamination']})").fetchall()
    got = QUERIES["op3_benchmark_decontamination"](spark, sf).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    assert sorted(map(tuple, got)) == sorted(want) and any(r.contaminated for r in got)
