import math
import random
import re
import time
import zlib

import numpy as np
from pyspark.sql import functions as F

from pktloom.llm import toxicity as tx


def corpus(n=600):
    rnd = random.Random(6)
    plain = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        toxic = int(rnd.random() < 0.3)
        words = rnd.choices(plain, k=rnd.randint(5, 60))
        if toxic:
            for _ in range(4):
                words[rnd.randrange(len(words))] = rnd.choice(["you zork", "zorkling", "blarg", "bl4rg"])
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def frames(spark, rows, labels):
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs, lab = frames(spark, rows, labels)
    got = {r.doc_id: r for r in tx.scored(docs, lab).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in rows)
    held = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.95 and len(held) > 50
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def test_held_out_labels_are_not_read(spark):
    rows, labels = corpus(300)
    docs, lab = frames(spark, rows, labels)
    flipped = lab.withColumn("toxic", F.when(tx.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r.doc_id: r.score for r in tx.scored(docs, x).collect()} for x in (lab, flipped))
    assert a == b


def test_edge_cases(spark):
    rows, labels = corpus(200)
    rows += [(900, None), (901, ""), (901, ""), (None, "you zork"), (902, "x " * 60000)]
    labels += [(5000, 1), (None, 1), (3, None), (4, 0), (4, 0)]
    docs, lab = frames(spark, rows, labels)
    docs = docs.selectExpr("*", "1 AS score", "'en' AS `row`", "2 AS id", "3 AS y")
    got = tx.scored(docs, lab).collect()
    assert len(got) == len(rows) and all(r.score is not None for r in got)
    assert {(r.score, r.predicted) for r in tx.scored(docs, lab.where("false")).collect()} == {(0.0, 0)}
    assert tx.without_toxic(docs, lab.where("false")).count() == len(rows)
    assert tx.scored(docs.where("false"), lab).count() == 0
    one = tx.scored(docs, lab.where("toxic = 0")).collect()
    assert all(r.predicted == 0 for r in one)
    kept = tx.without_toxic(docs, lab)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.predicted == 0}


def test_isotonic_and_trees():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(3000, 3))
    y = (x[:, 0] + x[:, 1] * x[:, 2] > 0.3).astype(float)
    m = tx.boosted(x[:2000], y[:2000], np.ones(2000))
    raw = m.raw(x)
    assert ((raw[2000:] > 0) == y[2000:]).mean() > 0.88
    knots, rates = tx.isotonic(raw, y, np.ones(len(y)))
    assert (np.diff(rates) >= -1e-12).all() and (np.diff(knots) > 0).all()
    # pooled rates are the means of their rows
    fitted = np.interp(raw, knots, rates)
    assert abs(fitted.mean() - y.mean()) < 1e-9
    k, r = tx.isotonic(np.array([1.0, 1.0, 2.0]), np.array([1.0, 0.0, 0.0]), np.ones(3))
    assert np.allclose(r, 1 / 3)


def test_query(spark):
    from pktloom.llm.queries import QUERIES

    sf = "/root/testdata/sf0.01"
    got = QUERIES["op1_toxicity"](spark, sf)
    seen = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got.count() == n and sum(r.predicted == r.toxic for r in seen) / len(seen) > 0.9


def test_long_words_and_repeated_ids(spark):
    rnd = random.Random(7)
    odd = "a" * 1_000_000 + " " + "".join(rnd.choices("abé", k=500_000)) + " " + "1" * 500_000 + " b" + "." * 500_000 + " " + "x1" * 200_000
    began = time.perf_counter()
    assert len(tx.features(odd, tx.Lexicon({"aaa": 1.0}))) == tx.N_FEATURES
    assert time.perf_counter() - began < 5
    rows, labels = corpus(200)
    rows += [(900, odd)] + [(rows[0][0], f"{rows[0][1]} {k}") for k in range(500)]
    docs, lab = frames(spark, rows, labels + [(900, 1)] * 3)
    got = tx.scored(docs, lab, sample=50).collect()
    assert len(got) == len(rows)


def test_obfuscated_words():
    plain = re.compile(r"[^\W\d_]+(?:[0-9@$!*_.-]+[^\W\d_]+)+")
    rnd = random.Random(8)
    for _ in range(500):
        t = "".join(rnd.choices("abÉ19@. -_*", k=rnd.randint(0, 30)))
        assert tx._OBFUSCATED.findall(t) == plain.findall(t)


def test_against_plain_trees_and_pools(spark):
    """Scores by a walk down each tree, row by row, and rates by pooling from scratch."""
    rows, labels = corpus(300)
    docs, lab = frames(spark, rows, labels)
    model = tx.fit(docs, lab)
    assert model.trees.feature

    def walk(x):
        raw = model.trees.base
        for f, c, v in zip(model.trees.feature, model.trees.cut, model.trees.value):
            at = 0
            while f[at] >= 0:
                at = 2 * at + (2 if x[f[at]] > c[at] else 1)
            raw += v[at]
        return raw

    got = {r.doc_id: r.score for r in tx.score(docs, model).select("row.doc_id", "score").collect()}
    for i, t in rows:
        raw = walk(tx.features(t, model.lexicon))
        k = next((k for k, x in enumerate(model.knots) if x >= raw), None)
        if k is None:
            rate = model.rates[-1]
        elif k == 0 or model.knots[k] == raw:
            rate = model.rates[k]
        else:
            share = (raw - model.knots[k - 1]) / (model.knots[k] - model.knots[k - 1])
            rate = model.rates[k - 1] + share * (model.rates[k] - model.rates[k - 1])
        assert abs(got[i] - ((1 - tx.ORDERING) * rate + tx.ORDERING / (1 + math.exp(-raw)))) < 1e-9

    rnd = np.random.default_rng(4)
    raw, y, w = rnd.integers(0, 12, 60) / 4, rnd.integers(0, 2, 60).astype(float), rnd.random(60) + 0.1
    knots, rates = tx.isotonic(raw, y, w)
    points = np.unique(raw)
    sums = [((y * w)[raw == p].sum(), w[raw == p].sum()) for p in points]
    for k, p in enumerate(points):  # the largest, over starts, of the least mean up to an end
        best = max(min(sum(a for a, _ in sums[i : j + 1]) / sum(b for _, b in sums[i : j + 1]) for j in range(k, len(points))) for i in range(k + 1))
        assert abs(np.interp(p, knots, rates) - best) < 1e-9
