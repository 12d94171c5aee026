"""Toxicity scores: gradient-boosted trees over dense text features, with isotonic calibration.

Fitting sees a bounded sample of labelled rows (`sample` of each class, least hash of doc_id first). Its words and word
beginnings are counted by label on the executors, and those whose document frequencies differ
significantly are the lexicon. Features of a row come from the lexicon of the other folds, so that trees and
calibration meet lexicon hits as they occur in unseen texts. Scoring reads every whole text once and shuffles nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, slices, text_batches, utf8, written

#: Labelled rows of each class that fitting sees at most.
SAMPLE = 5000
#: Entries of a lexicon at most; it is collected and broadcast.
LEXICON = 2000
FOLDS = 3
#: Standard errors by which an entry's document frequencies differ.
SIGNIFICANT = 4.5
#: Rows that have an entry and the label, at least.
LEAST_ROWS = 4
PREFIXES = (3, 4, 5, 6)
#: Words on either side of a hit in which a second person counts.
NEAR = 5
WINDOW = 20
TREES, DEPTH, BINS, RATE, PENALTY = 80, 3, 32, 0.15, 2.0
#: Share of the score that orders rows which calibration makes equal.
ORDERING = 0.01
REMEMBERED = 150_000
#: Letters beyond which a word is named by its digest.
LONG = 64

SECOND_PERSON = frozenset("you your yours yourself yourselves u ur tu te toi ton ta tes vous votre vos du dich dir dein deine deinen ihr euch euer usted ustedes tú ti tus vosotros vuestro".split())
#: Letters that digits and signs stand for.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", "_": "", "-": "", ".": ""})
_WORD = re.compile(r"[^\W_]+")
#: Letters with digits or signs among them. A match starts where a run of letters does, so each run is tried once.
_OBFUSCATED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[0-9@$!*_.-]++[^\W\d_]++)++")
N_FEATURES = 16


def whole(word: str) -> str:
    """The entry that stands for a word itself; a long one is named by its digest, so that entries are short."""
    return "=" + word if len(word) <= LONG else "#" + xxhash.xxh3_128_hexdigest(word.encode("utf-8", "replace"))


def grams(word: str) -> list[str]:
    """A word's entries: itself, and its beginnings."""
    return [whole(word), *(word[:n] for n in PREFIXES if len(word) > n)]


class Lexicon:
    """Weights of words (their own or the largest of a beginning), remembered for repeated words."""

    def __init__(self, entries: dict[str, float]):
        self.entries = entries
        self.known = _Weights(entries)

    def __reduce__(self):
        return Lexicon, (self.entries,)


class _Weights(dict):
    def __init__(self, entries: dict[str, float]):
        super().__init__()
        self.entries = entries

    def __missing__(self, word: str) -> tuple[float, float]:
        if len(self) >= REMEMBERED:
            self.clear()
        get = self.entries.get
        found = (get(whole(word), 0.0), max([get(word[:n], 0.0) for n in PREFIXES if len(word) > n], default=0.0))
        if len(word) <= LONG:
            self[word] = found
        return found


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The dense features of a whole text."""
    text = text or ""
    words = _WORD.findall(text.lower())
    n = len(words)
    per = 1000.0 / max(1, n)
    weights = np.array(list(map(lexicon.known.__getitem__, words)), np.float64).reshape(n, 2)
    best = weights.max(axis=1) if n else np.zeros(0)
    hit = best > 0
    hits = np.flatnonzero(hit)
    you = np.fromiter((w in SECOND_PERSON for w in words), bool, n)
    near = 0
    if len(hits) and you.any():
        at = np.concatenate(([0], np.cumsum(you)))
        near = int(np.count_nonzero(at[np.minimum(hits + NEAR + 1, n)] > at[np.maximum(hits - NEAR, 0)]))
    densest = 0
    if len(hits):
        at = np.concatenate(([0], np.cumsum(hit)))
        densest = int((at[np.minimum(hits + WINDOW, n)] - at[hits]).max())
    data = np.frombuffer(utf8(text), np.uint8)
    count = np.bincount(data, minlength=256)
    upper = int(count[65:91].sum())
    letters = max(1, upper + int(count[97:123].sum()) + int(count[194:].sum()))
    signs = int(count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum())
    triple = int(np.count_nonzero((data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & (data[2:] >= 65))) if len(data) > 2 else 0
    obfuscated = _OBFUSCATED.findall(text)
    plain = [lexicon.known[w.lower().translate(LEET)] for w in obfuscated]
    return [
        np.count_nonzero(weights[:, 0]) * per if n else 0.0,
        np.count_nonzero(weights[:, 1]) * per if n else 0.0,
        math.log1p(len(hits)),
        float(best.sum()) * per,
        float(best.max()) if n else 0.0,
        float(densest),
        near / max(1, len(hits)),
        near * per,
        int(you.sum()) * per,
        upper / letters,
        int(count[33]) / max(1, signs),
        signs / max(1, len(data)),
        len(obfuscated) * per,
        sum(max(w) > 0 for w in plain) * per,
        triple * per,
        math.log1p(n),
    ]


@dataclass
class Trees:
    """Boosted regression trees on the logistic loss: nodes in heap order, feature -1 for a leaf."""

    base: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                split = f[at] >= 0
                right = x[rows, np.maximum(f[at], 0)] > c[at]
                at = np.where(split, 2 * at + 1 + right, at)
            out += v[at]
        return out


def boosted(x: np.ndarray, y: np.ndarray, w: np.ndarray, trees: int = TREES) -> Trees:
    """Histogram boosting with Newton leaves."""
    rate = float(np.clip(np.average(y, weights=w), 1e-4, 1 - 1e-4)) if len(y) else 0.5
    model = Trees(math.log(rate / (1 - rate)))
    if not len(y) or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, BINS + 1)[1:-1])) for k in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    raw = np.full(len(y), model.base)
    size = 2 ** (DEPTH + 1) - 1
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = w * (y - p), w * p * (1 - p)
        feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
        at = np.zeros(len(y), np.int64)
        for node in range(size):
            own = np.flatnonzero(at == node)
            if not len(own):
                continue
            sg, sh = g[own].sum(), h[own].sum()
            value[node] = RATE * sg / (sh + PENALTY)
            if node >= 2**DEPTH - 1 or len(own) < 8:
                continue
            best = (1e-6, -1, -1)
            for k, c in enumerate(cuts):
                if not len(c):
                    continue
                lg = np.cumsum(np.bincount(binned[own, k], g[own], len(c) + 1))[:-1]
                lh = np.cumsum(np.bincount(binned[own, k], h[own], len(c) + 1))[:-1]
                gain = lg**2 / (lh + PENALTY) + (sg - lg) ** 2 / (sh - lh + PENALTY) - sg**2 / (sh + PENALTY)
                j = int(gain.argmax())
                if gain[j] > best[0]:
                    best = (float(gain[j]), k, j)
            if best[1] >= 0:
                _, k, j = best
                feature[node], cut[node], value[node] = k, cuts[k][j], 0.0
                at[own] = 2 * node + 1 + (binned[own, k] > j)
        raw += value[at]
        model.feature.append(feature)
        model.cut.append(cut)
        model.value.append(value)
    return model


def isotonic(raw: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: knots of raw score and calibrated rate, for linear interpolation."""
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []  # rate, weight, first, last
    for x, t, u in zip(raw[order], y[order], w[order]):
        pools.append([t, u, x, x])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
            rate, u2, _, last = pools.pop()
            rate0, u1, first, _ = pools[-1]
            pools[-1] = [(rate0 * u1 + rate * u2) / (u1 + u2), u1 + u2, first, last]
    knots = [(k, p[0]) for p in pools for k in ([p[2]] if p[2] == p[3] else [p[2], p[3]])]
    return np.array([k for k, _ in knots]), np.array([r for _, r in knots])


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees
    knots: np.ndarray
    rates: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(self.knots):
            return np.zeros(len(x))
        raw = self.trees.raw(x)
        even = 1 / (1 + np.exp(-raw))
        calibrated = np.interp(raw, self.knots, self.rates)
        return np.clip((1 - ORDERING) * calibrated + ORDERING * even, 0.0, 1.0)


def held_out(id_col: str) -> F.Column:
    """Whether a row's label is kept from fitting. A null id has no label and is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _log_odds(t: np.ndarray, c: np.ndarray, nt: float, nc: float) -> tuple[np.ndarray, np.ndarray]:
    p = (t + c) / max(1.0, nt + nc)
    z = (t / max(1.0, nt) - c / max(1.0, nc)) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / max(1.0, nt) + 1 / max(1.0, nc)))
    return z, np.log((t + 0.5) / (nt + 1)) - np.log((c + 0.5) / (nc + 1))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learns from labelled rows that are not held out; without any, nothing is known to be toxic and every score is 0.

    An id with several labels has the larger one, and an id with several texts is learned from by the least of them.
    The driver holds the sample's features and the lexicon, both bounded by parameters.
    """
    spark = docs.sparkSession
    text_batches(spark)
    usable = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y in (0, 1)")
    usable = usable.where(~held_out("id")).groupBy("id").agg(F.max("y").alias("y"))
    totals = {r.y: r.n for r in usable.groupBy("y").agg(F.count("*").alias("n")).collect()}
    classes = [usable.where(F.col("y") == y).orderBy(F.xxhash64("id", F.lit(1)), "id").limit(sample) for y in (0, 1)]
    chosen = classes[0].unionByName(classes[1]).withColumn("fold", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(FOLDS)).cast("int"))
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id", "y", "fold").agg(F.min("text").alias("text"))  # however often an id comes, the sample has it once
    rows = written(rows.select("text", "y", "fold").repartition(2 * spark.sparkContext.defaultParallelism), "sample")

    def tally(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[tuple[str, int]] = Counter()
        for b in slices(batches):
            for text, y, fold in zip(*(c.to_pylist() for c in b.columns)):
                cell = 2 * fold + y
                found.update((g, cell) for g in {g for w in set(_WORD.findall((text or "").lower())) for g in grams(w)})
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in found], pa.string()), pa.array([c for _, c in found], pa.int32()), pa.array(list(found.values()), pa.int64())], names=["gram", "cell", "n"])

    cells = [f"n{k}" for k in range(2 * FOLDS)]
    counts = rows.mapInArrow(tally, "gram string, cell int, n bigint").groupBy("gram").agg(*[F.sum(F.when(F.col("cell") == k, F.col("n")).otherwise(0)).alias(c) for k, c in enumerate(cells)])
    size = dict.fromkeys(range(2 * FOLDS), 0) | {2 * r.fold + r.y: r.n for r in rows.groupBy("fold", "y").agg(F.count("*").alias("n")).collect()}
    nt, nc = (max(1, sum(size[2 * k + y] for k in range(FOLDS))) for y in (1, 0))
    t, c = (sum((F.col(f"n{2 * k + y}") for k in range(1, FOLDS)), F.col(f"n{y}")) for y in (1, 0))
    p = (t + c) / (nt + nc)
    z = (t / nt - c / nc) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / nt + 1 / nc))
    kept = counts.withColumn("z", z).where((t >= LEAST_ROWS) & (F.col("z") >= SIGNIFICANT * 0.8)).orderBy(F.desc("z"), "gram").limit(LEXICON).collect()
    names = [r.gram for r in kept]
    table = np.array([[r[k] for k in cells] for r in kept], np.float64).reshape(len(kept), 2 * FOLDS)

    def lexicon(without: int | None) -> Lexicon:
        folds = [k for k in range(FOLDS) if k != without]
        t, c = (table[:, [2 * k + y for k in folds]].sum(axis=1) for y in (1, 0))
        z, odds = _log_odds(t, c, *(float(sum(size[2 * k + y] for k in folds)) for y in (1, 0)))
        ok = (z >= SIGNIFICANT) & (t >= LEAST_ROWS) & (odds > 1)
        return Lexicon({n: float(o) for n, o, k in zip(names, odds, ok) if k})

    shared = spark.sparkContext.broadcast([lexicon(k) for k in range(FOLDS)])

    def describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for b in slices(batches):
            x = [features(text, of[fold]) for text, fold in zip(b.column("text").to_pylist(), b.column("fold").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("y"), b.column("fold"), pa.array(x, pa.list_(pa.float64()))], names=["y", "fold", "x"])

    got = rows.mapInArrow(describe, "y int, fold int, x array<double>").collect()
    dropped(rows)
    got.sort(key=lambda r: (r.y, r.fold, r.x))
    x = np.array([r.x for r in got], np.float64).reshape(len(got), N_FEATURES)
    y, folds = np.array([r.y for r in got], np.float64), np.array([r.fold for r in got])
    share = {v: totals.get(v, 0) / max(1, int((y == v).sum())) for v in (0, 1)}
    w = np.where(y == 1, share[1], share[0])
    w = w / w.mean() if len(w) else w
    raw = np.zeros(len(y))
    for k in range(FOLDS):
        raw[folds == k] = boosted(x[folds != k], y[folds != k], w[folds != k]).raw(x[folds == k])
    knots, rates = isotonic(raw, y, w) if len(y) else (np.zeros(0), np.zeros(0))
    return Model(lexicon(None), boosted(x, y, w), knots, rates)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs' columns as the struct `row`, with score, for each row."""
    spark = docs.sparkSession
    text_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text_col).alias("text"))

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches):
            x = np.array([features(t, m.lexicon) for t in b.column(1).to_pylist()], np.float64).reshape(b.num_rows, N_FEATURES)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.scores(x))], names=["row", "score"])

    return rows.mapInArrow(scan, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs.

    Null, empty and wordless texts have a score like any other. Repeated rows give repeated rows; a null id is scored and not held out;
    labels of unknown ids, null labels and repeated labels are fine; without usable labels every score is 0 and every
    prediction 0. An empty table gives an empty one.
    """
    rows = docs.select(id_col, text_col)
    model = fit(rows, labels, id_col=id_col, text_col=text_col, **options)
    found = score(rows, model, id_col, text_col).select(F.col("row").getField(id_col).cast("bigint").alias("doc_id"), "score")
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs with a score below the threshold, with all their columns; all of them without usable labels."""
    model = fit(docs.select(id_col, text_col), labels, id_col=id_col, text_col=text_col, **options)
    return score(docs, model, id_col, text_col).where(F.col("score") < threshold).select("row.*")
