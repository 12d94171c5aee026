import hashlib
import random
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pktloom.llm import pii

RX = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def slow(text):
    out = []
    for k, rx in enumerate(RX):
        for m in re.finditer(rx, text):
            digits = re.sub("[^0-9]", "", m[0])
            if k == 1 and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if k == 2:
                if not 13 <= len(digits) <= 19:
                    continue
                n = [int(d) for d in digits][::-1]
                if (sum(n[::2]) + sum(sum(divmod(2 * d, 10)) for d in n[1::2])) % 10:
                    continue
            if k == 3 and not 9 <= len(digits) <= 15:
                continue
            out.append((k, *m.span()))
    return out


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab.@-+%_ 0123456789()é\n", max_size=80))
def test_base_spans(text):
    assert pii.base_spans(text) == slow(text)


def test_base_examples():
    t = "Write a.b+c@mail.example.com. or x@@y.z, 4111 1111 1111 1111; 10.0.0.255 10.0.0.256 +1 (974) 555-3436, 4111111111111112"
    assert pii.base_spans(t) == slow(t) and len(slow(t)) == 4
    rnd = random.Random(3)
    for _ in range(300):
        t = "".join(rnd.choices(["4", "1", "41111111", "@", "a", ".", "b.c", " ", "-", "+", "255", "("], k=rnd.randint(0, 40)))
        assert pii.base_spans(t) == slow(t)


def people(n):
    rnd = random.Random(8)
    rows = [(i, f"Text {rnd.random()} begins. Please write to person{i}@mail.example.com today.") for i in range(n)]
    rows += [(1000 + i, f"Other text. Please write to person{i}@localhost today.") for i in range(2)]
    rows += [(2000, "No context person@localhost here at all"), (2001, "order number 1234567890123 is odd")]
    return rows


def test_bootstrapping(spark):
    rows = people(40) + [(None, None), (3000, ""), (3000, ""), (4000, "w " * 50000 + "+1 (974) 555-3436")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).selectExpr("*", "1 AS base", "2 AS row_id", "'x' AS seen", "3 AS __text")
    got = {r.doc_id: r for r in pii.report(df).collect()}
    assert pii.report(df).count() == len(rows)
    for i, t in rows:
        r, base = got[i], slow(t or "")
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for x, _, _ in base) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(pii.joined(base).split(",")) - {""} <= set(r.spans.split(","))
    t = rows[40][1]
    assert got[1000].spans == f"email:{t.index('person')}:{t.index(' today')}" and got[1000].n_added == 1
    assert got[2000].spans == got[2001].spans == ""
    assert pii.report(df.where("false")).count() == 0


def test_swallowed_identifiers(spark):
    rnd = random.Random(5)

    def card():
        n = "4" + "".join(rnd.choices("0123456789", k=14))
        return next(n + d for d in "0123456789" if pii.luhn(n + d))

    rows = [(i, f"w{i} +1 ({100 + i}) 555-{1000 + i} and {card()} x{i}") for i in range(20)]
    rows += [(100, f"Both +1 (777) 555-1234 {card()} here"), (101, "Odd 4000000000000001 or 999.1.1.1 or 555-1234 number")]
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)).collect()}
    assert got[100].n_phone == got[100].n_card == 0 and got[100].spans == "card:23:39,phone:5:22" and got[101].spans == ""


def test_few_seeds_are_no_pattern(spark):
    df = spark.createDataFrame(people(4), "doc_id bigint, text string").coalesce(1)
    assert all(r.n_added == 0 for r in pii.report(df).collect())


def slow_patterns(edges, confident, support):
    graph = {}
    for k, p, i, s in edges:
        graph.setdefault((k, p), {}).setdefault(i, False)
        graph[k, p][i] |= s
    graph = {x: v for x, v in graph.items() if len(v) >= support}
    known = {(k, i): 1.0 for (k, _), v in graph.items() for i, s in v.items() if s}
    sure, rounds = {}, 0
    while True:
        for (k, p), v in graph.items():
            of = [known[k, i] for i in v if (k, i) in known]
            if (k, p) not in sure and len(of) >= support and sum(of) / (len(v) + 1) >= confident:
                sure[k, p] = sum(of) / (len(v) + 1)
        new = {}
        for (k, p), score in sure.items():
            for i in graph[k, p]:
                if (k, i) not in known:
                    new[k, i] = max(new.get((k, i), 0.0), score)
        if not new:
            return sure, rounds
        known |= new
        rounds += 1


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_graph_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(2), f"p{rnd.randrange(8)}", i := rnd.randrange(60), i % 9 > 1) for _ in range(600)]
    df = spark.createDataFrame(edges, "kind int, pattern string, instance bigint, seed boolean")
    got = {(r.kind, r.pattern): round(r.score, 9) for r in pii.confident_patterns(df, 0.7, 3).collect()}
    want = {x: round(s, 9) for x, s in slow_patterns(edges, 0.7, 3)[0].items()}
    assert got == want and want
    assert pii.confident_patterns(df.where("false")).count() == 0


def test_patterns_enter_through_found_instances(spark):
    """The second pattern has no seed, and the third none that the first found: each rests on what the one before it found."""
    edges = [(0, "a", i, True) for i in range(40)] + [(0, "a", 100 + i, False) for i in range(8)]
    edges += [(0, "b", 100 + i, False) for i in range(8)] + [(0, "b", 200, False)]
    edges += [(0, "c", 300 + i, False) for i in range(8)]
    df = spark.createDataFrame(edges, "kind int, pattern string, instance bigint, seed boolean")
    want, rounds = slow_patterns(edges, 0.6, 5)
    assert set(want) == {(0, "a"), (0, "b")} and rounds == 2
    assert {(r.kind, r.pattern): round(r.score, 9) for r in pii.confident_patterns(df, 0.6, 5).collect()} == {x: round(s, 9) for x, s in want.items()}


def test_bootstrapping_over_texts(spark):
    """Seeds have the context "kindly mail", what these words find has another, which finds an address that has the second only."""
    rows = [(i, f"Kindly mail u{i}@m{i}.example.org soon{i}") for i in range(60)]
    rows += [(100 + i, f"Kindly mail u{i}@local{'x' * i} now. Reach him u{i}@local{'x' * i} z{i}") for i in range(7)]
    rows += [(200, "Reach him other-name@box please")]
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1), confident=0.6).collect()}
    assert got[200].n_added == 1 and got[200].spans == "email:10:24"
    assert all(got[100 + i].n_added == 2 for i in range(7)) and all(got[i].n_added == 0 for i in range(60))


def slow_report(rows, confident, support):
    """Spans and their numbers, by plain reading of the module's rules."""
    edges, seen = [], []
    for r, (_, t) in enumerate(rows):
        t = t or ""
        base = slow(t)
        every = [(*x, True) for x in base] + [(*x, False) for x in pii.candidates(t, base)]
        for k, s, e, seed in every:
            before, after = [w[-64:] for w in t[:s].lower().split()], [w[:64] for w in t[e:].lower().split()]
            form = "".join("9" if c in "0123456789" else c for c in re.sub(r"[^\W\d_]+", "a", t[s:e]))
            own = ["S " + form, *(["L " + " ".join(before[-2:])] if len(before) > 1 else []), *([f"LR {before[-1]} _ {after[0]}"] if before and after else [])]
            name = "".join(c for c in t[s:e].lower() if c.isalnum() or c == "@")
            seen.append((r, k, s, e, seed, own))
            edges += [(k, p, name, seed) for p in own]
    sure = slow_patterns(edges, confident, support)[0]
    out = []
    for r, (i, t) in enumerate(rows):
        new = {(k, s, e) for q, k, s, e, seed, own in seen if q == r and not seed and any((k, p) in sure for p in own)}
        out.append((i, pii.joined(sorted([*slow(t or ""), *new])), len(new)))
    return out


def test_masked(spark):
    rows = [(1, "Mail é a@b.co, call +1 (974) 555-3436.", "en"), (2, None, None), (3, "clean", "en"), (4, "1.2.3.4", "en"), (4, "1.2.3.4", "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(1).selectExpr("*", "1 AS new", "2 AS __new", "3 AS __row_id", "4 AS row_id")
    out = pii.masked(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.text) for r in out.collect()) == [(1, "Mail é [EMAIL], call [PHONE]."), (2, None), (3, "clean"), (4, "[IP]"), (4, "[IP]")]


def test_query_against_brute_force(spark):
    from pktloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op4_pii"](spark, sf).collect()
    assert len(got) == len(texts) and sum(r.n_email for r in got)
    want = {i: (s, n) for i, s, n in slow_report(sorted(texts.items()), pii.CONFIDENT, pii.SUPPORT)}
    for r in got:
        base = slow(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for x, _, _ in base) for k in range(4))
        assert (r.spans, r.n_added) == want[r.doc_id]


def test_long_texts(spark):
    """A row of one long word or number, or of many identifiers, takes seconds and not hours."""
    rows = [(1, "1" * 1_000_000), (2, "1.2.3." + "4" * 1_000_000), (3, "a" * 1_000_000 + "@" + "b" * 1_000_000), (4, "+1" + " 2" * 500_000), (5, "x@y.zz " * 20_000), (6, "@" * 300_000), (7, None), (8, "x@y.zz," * 100_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    began = time.perf_counter()
    got = {r.doc_id: r for r in pii.report(df).collect()}
    assert time.perf_counter() - began < 60 and got[5].n_email == 20_000 and got[8].n_email == 100_000 and got[7].spans == ""
    out = {r.doc_id: r.text for r in pii.masked(df).collect()}
    assert out[5] == "[EMAIL] " * 20_000 and out[7] is None
    assert pii.masked(df.where("false")).count() == 0
