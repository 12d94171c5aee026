"""Near copies by SimHash and by the similarity of their word shingles, every one of them verified.

Texts are sets of 5-word shingles, and two are linked if the sets' Jaccard similarity is 0.8 or more. Each set has a SimHash
fingerprint, and those within 3 bits are found by simhash.links: an index of byte positions, a count of the positional bytes that
a pair shares, and a check of the bits. What it connects is a list of candidates. For the rest, which differ in 16 bits and more and which no
index of a fingerprint's parts finds, minima of the shingles under 200 hash functions make 40 keys of 5; a pair of similarity 0.8 has no
key in common with a chance of about 1e-7, and more similar pairs with less. All that meet in a list, of either kind, are compared
shingle by shingle.

Skew: equal sets are one node before keys are dealt, keys under which the same nodes meet are one list, and a list is dealt
in blocks whose pairs are separate groups, each of which returns a spanning forest and never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import slices, sorted_groups, text_batches, utf8, written
from .components import components

SEED = 42
WORDS = 5
#: Least similarity, as a fraction.
SIMILAR = (4, 5)
KEYS, KEY_MINIMA = 40, 5
#: Nodes of a block of a list.
BLOCK = 512
#: Shingles under all hash functions at once.
CHUNK = 2048

_RND = np.random.default_rng(SEED)
_A = _RND.integers(0, 1 << 64, KEYS * KEY_MINIMA, np.uint64) | np.uint64(1)
_B = _RND.integers(0, 1 << 64, KEYS * KEY_MINIMA, np.uint64)


def shingles(text: str | None, width: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles; none without words. Words are those of simhash.fingerprint."""
    words = utf8(text).lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, n = b" ".join(words), max(1, len(words) - width + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends)), np.uint64, n))


def keys(found: np.ndarray) -> list[int]:
    """The keys of a set of shingles, as signed numbers."""
    least = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), CHUNK):
        x = found[at : at + CHUNK, None] * _A + _B
        x ^= x >> np.uint64(32)
        np.minimum(least, x.min(axis=0), out=least)
    rows = least.reshape(KEYS, KEY_MINIMA)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), SEED) for r in rows], np.uint64).view(np.int64).tolist()


def _signatures(rows: DataFrame, text_col: str) -> DataFrame:
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            digests, of, fps = [], [], []
            for text in b.column(1).to_pylist():
                found = shingles(text)
                digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                of.append(keys(found) if len(found) else [])
                fps.append(simhash.of_hashes([found[at : at + CHUNK] for at in range(0, len(found), CHUNK)]))
            h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(of, pa.list_(pa.int64()))], names=["row", "h1", "h2", "fp", "keys"])

    return rows.select(F.col("__row").alias("row"), F.col(text_col).alias("text")).mapInArrow(scan, "row bigint, h1 bigint, h2 bigint, fp bigint, keys array<bigint>")


def _sets(rows: DataFrame, text_col: str) -> DataFrame:
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            held = [shingles(t).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(held, pa.binary())], names=["node", "held"])

    return rows.select(F.col("__row").alias("node"), F.col(text_col).alias("text")).mapInArrow(scan, "node bigint, held binary")


def forest(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links between sets of `left` and of `right` (positions) that connect what all links between them connect."""
    sizes = np.array([len(s) for s in sets], np.int64)
    _, inv = np.unique(np.concatenate(sets), return_inverse=True)
    in_right = np.zeros(len(sets), bool)
    in_right[right] = True
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(inv, kind="stable")
    order = order[in_right[owner[order]]]
    owners = owner[order]
    counts = np.bincount(inv[order], minlength=len(inv) and int(inv.max()) + 1)
    firsts = np.cumsum(counts) - counts
    offsets = np.cumsum(sizes) - sizes
    up = list(range(len(sets)))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    num, den = SIMILAR
    for x in left.tolist():
        mine = inv[offsets[x] : offsets[x] + sizes[x]]
        n = counts[mine]
        at = np.repeat(firsts[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shared = np.bincount(owners[at], minlength=len(sets))
        for y in np.flatnonzero((shared > 0) & ((num + den) * shared >= num * (sizes + sizes[x]))).tolist():
            p, q = root(x), root(y)
            if p != q:
                up[p] = q
                out.append((x, y))
    return out


def lists(nodes: DataFrame) -> DataFrame:
    """(node, k, v): the lists of each node (node, fp, keys), which are those of its keys and, k = -1, of what the SimHash index connects.

    Nodes without words have no keys and no list.
    """
    worded = nodes.where(F.size("keys") > 0)
    member = components(simhash.links(worded.select("fp").distinct())).select(F.col("node").alias("fp"), "root")
    near = worded.join(member, "fp", "left").select("node", F.lit(-1).alias("k"), F.coalesce("root", "fp").alias("v"))
    return near.unionByName(worded.select("node", F.posexplode("keys").alias("k", "v")))


def links(nodes: DataFrame, rows: DataFrame, text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect all nodes (node, fp, keys) whose texts, those of rows by __row, are similar."""
    spark = nodes.sparkSession
    postings = lists(nodes)
    met = postings.groupBy("k", "v").agg(F.count("*").alias("n"), F.min("node").alias("least"), F.max("node").alias("most"), F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.xxhash64("node", F.lit(7)).cast("decimal(38,0)")).alias("s")).where("n > 1")
    met = met.groupBy("n", "least", "most", "x", "s").agg(F.min(F.struct("k", "v")).alias("key")).select("key.k", "key.v", "n")
    members = written(postings.join(met, ["k", "v"]), "members")
    sets = written(_sets(rows.join(members.select(F.col("node").alias("__row")).distinct().hint("merge"), "__row", "left_semi"), text_col), "sets")
    dealt = (
        members.withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("k", "v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node")
        .join(sets, "node")
    )

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["k", "v", "i", "j"]):
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            node, own = t.column("node").to_numpy(), t.column("own").to_numpy()
            found = forest([np.frombuffer(s, np.uint64) for s in t.column("held").to_pylist()], np.flatnonzero(own == i), np.flatnonzero(own == j))
            if found:
                both = [pa.array(node[list(x)]) for x in zip(*found)]
                yield pa.RecordBatch.from_arrays(both, names=["a", "b"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select("k", "v", "i", "j", "own", "node", "held").repartition(parts, "k", "v", "i", "j").sortWithinPartitions("k", "v", "i", "j")
    return dealt.mapInArrow(meet, "a bigint, b bigint")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near copies: that of the least id (nulls last, then the first row).

    A group is what links of similar texts connect. Texts without words are similar to one another only. Rows are numbered once,
    in a table that all passes read.
    """
    text_batches(docs.sparkSession)
    numbered = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    signed = written(_signatures(numbered, text_col), "signatures")
    nodes = written(signed.groupBy("h1", "h2").agg(F.min("row").alias("node"), F.first("fp").alias("fp"), F.first("keys").alias("keys")), "nodes")
    member = components(links(nodes.select("node", "fp", "keys"), numbered, text_col))
    of = nodes.select("h1", "h2", "node").join(member, "node", "left").select("h1", "h2", F.coalesce("root", "node").alias("component"))
    of = written(of, "classes")  # a plain table, so that the join can split a set that many rows have
    found = signed.select("row", "h1", "h2").join(of, ["h1", "h2"]).select(F.col("row").alias("__row"), "component")
    ids = numbered.select("__row", F.col(id_col).alias("__id"))
    rank = F.struct(F.col("__id").isNull().alias("no_id"), "__id", "__row")
    kept = found.join(ids, "__row").groupBy("component").agg(F.min(rank).alias("kept"))
    kept = written(kept.select(F.col("kept.__row").alias("__row")), "kept")
    return numbered.join(kept.hint("merge"), "__row", "left_semi").drop("__row")
