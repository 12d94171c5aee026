import random
import re

import pytest
import xxhash

from pktloom.llm import linededup as ld


def plain_units(text, unit):
    """Lines, paragraphs, or lines cut between words whose hashes say so, word by word."""
    if unit == "paragraph":
        lines, at, gap = [], 0, list(re.finditer(r"\n[^\S\n]*\n\s*", text))
        for m in gap:
            lines.append((at, text[at : m.start()]))
            at = m.end()
        lines.append((at, text[at:]))
    else:
        lines, at = [], 0
        for line in text.split("\n"):
            lines.append((at, line))
            at += len(line) + 1
    out = []
    for at, line in lines:
        words = [(at + m.start(), at + m.end(), m[0].lower()) for m in re.finditer(r"\S+", line)]
        own = []
        for w in words:
            if own and unit == "piece":
                a, b = (xxhash.xxh64_intdigest(x[2].encode()) for x in (own[-1], w))
                pair = ((a * 0x9E3779B97F4A7C15 % 2**64) ^ b) * 0xD6E8FEB86659FD93 % 2**64
                if (pair >> 32) % 8 == 0:
                    out.append(own)
                    own = []
            own.append(w)
        if own:
            out.append(own)
    return [(u[0][0], u[-1][1], " ".join(w for _, _, w in u)) for u in out]


def test_units():
    assert [n for _, _, n in ld.units("a\n\nb c\nd\n \n e", "paragraph")] == ["a", "b c d", "e"]
    assert [n for _, _, n in ld.units(" A  b\n\n c\n", "line")] == ["a b", "c"]
    for unit in ld.UNITS:
        assert ld.units(None, unit) == ld.units("", unit) == ld.units(" \n\t", unit) == [] and ld.units("hi", unit)[0][2] == "hi"
    rnd = random.Random(1)
    for _ in range(200):
        text = "".join(rnd.choices(["a", "Bé", "ccc", "İ", " ", " ", "\t", "\n", "\n\n", "\x85", "."], k=rnd.randint(0, 60)))
        for unit in ld.UNITS:
            assert ld.units(text, unit) == plain_units(text, unit)


def test_pieces_do_not_depend_on_what_stands_around():
    rnd = random.Random(2)
    passage = " ".join("".join(rnd.choices("abcdefgh", k=5)) for _ in range(60))
    found = [{n for _, _, n in ld.units(" ".join(rnd.choices("x y z".split(), k=k)) + " " + passage + " end")} for k in range(1, 20)]
    shared = set.intersection(*found)
    assert sum(len(n.split()) for n in shared) > 30


def slow(rows, unit, min_words):
    table = [(i, r, u, s, e, n) for r, (i, t) in enumerate(rows) for u, (s, e, n) in enumerate(plain_units(t or "", unit))]
    first = {}
    for i, r, u, s, e, n in sorted(table, key=lambda x: (x[0] is None, x[0] or 0, x[1], x[2])):
        first.setdefault(n, (i, r, u, s, e))
    out = []
    for r in range(len(rows)):
        own = [(x, first[x[5]]) for x in table if x[1] == r]
        run = []
        for x, f in [*own, (None, None)]:
            if x is not None and f[1:3] != (x[1], x[2]):
                run.append((x, f))
                continue
            if sum(len(y[5].split()) for y, _ in run) >= min_words:
                out += [(y[0], y[2], y[3], y[4], g[0], g[3], g[4]) for y, g in run]
            run = []
    return out


@pytest.mark.parametrize("unit,min_words", [("piece", 8), ("line", 1), ("line", 8), ("paragraph", 1)])
def test_against_brute_force(spark, unit, min_words):
    rnd = random.Random(9)
    sentences = [" ".join(rnd.choices("a bb ccc Éd ee".split(), k=rnd.randint(1, 9))) + "." for _ in range(40)]
    rows = [(rnd.choice([None, *range(25)]), rnd.choice(["", "\n"]).join(rnd.choices([s + rnd.choice([" ", "\n", "\n\n"]) for s in sentences], k=rnd.randint(0, 12)))) for _ in range(60)]
    rows += [(3, None), (4, ""), rows[5], rows[5], (None, sentences[0]), (70, "word " * 30000), (71, "w" * 1_000_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).selectExpr("*", "1 AS unit", "2 AS h1", "3 AS row_id", "4 AS kept", "5 AS __row_id", "6 AS removed")
    got = [(r.doc_id, r.unit, r.start, r.end, r.kept_doc_id, r.kept_start, r.kept_end) for r in ld.removed_units(df, unit=unit, min_words=min_words).collect()]
    want = slow(rows, unit, min_words)
    assert sorted(got, key=str) == sorted(want, key=str) and got
    assert ld.removed_units(df.where("false"), unit=unit).count() == 0
    spans = {}
    for i, _, s, e, *_ in want:
        spans.setdefault(i, []).append((s, e))
    with pytest.raises(ValueError):
        ld.deduplicated(df)
    out = ld.deduplicated(df, unit=unit, min_words=min_words, removed_col="gone")
    assert out.columns == [*df.columns, "gone"] and out.count() == len(rows)
    assert sorted((r.doc_id, s["start"], s["end"]) for r in out.where("doc_id is not null").collect() for s in r.gone) == sorted((i, s, e) for i, _, s, e, *_ in want if i is not None)


def test_deduplicated_keeps_one_copy(spark):
    passage = "Alpha beta gamma delta epsilon zeta. Eta theta iota kappa lambda mu nu. Xi omicron pi rho sigma tau upsilon. Phi chi psi omega are the last of them."
    rows = [(2, "Second starts like this here.\n" + passage + "\nAnd ends so."), (1, "First has words of its own.\n" + passage), (3, None), (4, "Quite clean it is.")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: r for r in ld.deduplicated(df).collect()}
    assert got[1].text == rows[1][1] and got[3].text is None and got[4].text == rows[3][1] and got[4].removed == []
    assert got[2].text.split() == "Second starts like this here. And ends so.".split()
    assert " ".join(rows[0][1][s["start"] : s["end"]] for s in got[2].removed) == passage


def test_query_against_brute_force(spark):
    from pktloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = [(r.doc_id, r.unit, r.start, r.end, r.kept_doc_id, r.kept_start, r.kept_end) for r in QUERIES["op8_line_dedup"](spark, sf).collect()]
    assert sorted(got) == sorted(slow(rows, "piece", ld.MIN_WORDS)) and got
