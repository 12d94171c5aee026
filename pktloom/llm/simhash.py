"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most 3 bits agree in at least 5 of their 8 bytes. The index
holds, for sets of byte positions chosen so that every 5 of 8 positions contain one, the fingerprints
with given bytes at those positions; a pair that agrees in 5 positional bytes meets in at least one
posting list. In each list the shared positional bytes of a pair are tallied, pairs with 5 or more
are retained, and their Hamming distance is verified.

Skew: exact copies are one fingerprint before the index is built, and a posting list is dealt in blocks
whose pairs are separate groups, each of which returns a spanning forest and never all pairs. So
no list meets in one task and no link is lost. A list of n distinct fingerprints costs n * n / 512 rows of shuffle, which is
quadratic where very many different texts agree in the same four bytes; hashes of different texts do not.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, sorted_groups, text_batches, utf8, written
from .components import components

SEED = 42
SHINGLE = 3
MAX_BITS = 3
BYTES = 8
#: Positional bytes that a linked pair shares at least.
MIN_SHARED = BYTES - MAX_BITS
#: Bytes of an index key.
WIDTH = 4
#: Fingerprints of a block of a posting list.
BLOCK = 512
#: Shingles hashed at once.
CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text's 3-word shingles, repeats included; 0 without words.

    A-Z are lower-cased and words are what ASCII white space separates, which is what bytes.lower()
    and bytes.split() do to UTF-8. Fewer than 3 words are one shingle.
    """
    words = utf8(text).lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - SHINGLE + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[min(SHINGLE, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return of_hashes([digest(joined[s:e], SEED) for s, e in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])] for at in range(0, n, CHUNK))


def of_hashes(parts: Iterable[Sequence[int]]) -> int:
    """The fingerprint of hashes: a bit is 1 if over half of them have it."""
    counts, n = np.zeros(64, np.int64), 0
    for part in parts:
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp bigint): one row for each row of docs, its fingerprint as a signed 64-bit integer."""
    text_batches(docs.sparkSession)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fp = np.fromiter(map(fingerprint, b.column(1).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, "doc_id bigint, fp bigint")


def position_sets(width: int = WIDTH) -> list[tuple[int, ...]]:
    """Sets of `width` byte positions of which every MIN_SHARED positions contain one (a greedy cover)."""
    left = set(combinations(range(BYTES), MIN_SHARED))
    sets = list(combinations(range(BYTES), width))
    chosen = []
    while left:
        best = max(sets, key=lambda s: sum(set(s) <= set(x) for x in left))
        chosen.append(best)
        left = {x for x in left if not set(best) <= set(x)}
    return chosen


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _forest(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[list[int], list[int]]:
    """Links between a and b that connect what all their links connect."""
    xor = a[:, None] ^ b[None, :]
    shared = np.zeros(xor.shape, np.uint8)
    for k in range(BYTES):
        shared += ((xor >> np.uint64(8 * k)) & np.uint64(255)) == 0
    i, j = np.nonzero(shared >= MIN_SHARED)
    if same:
        i, j = i[i < j], j[i < j]
    near = np.bitwise_count(xor[i, j]) <= MAX_BITS
    i, j = i[near].tolist(), j[near].tolist()
    nodes = [*a.tolist(), *([] if same else b.tolist())]
    up, shift = list(range(len(nodes))), 0 if same else len(a)

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    left, right = [], []
    for x, y in zip(i, j):
        p, q = root(x), root(y + shift)
        if p != q:
            up[p] = q
            left.append(nodes[x])
            right.append(nodes[y + shift])
    return left, right


def links(fps: DataFrame, width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """(a, b): links that connect all fingerprints (fp, distinct) within MAX_BITS of one another."""
    spark = fps.sparkSession
    sets = position_sets(width)
    masks = [_signed(sum(255 << (8 * p) for p in s)) for s in sets]
    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for k, m in enumerate(masks)]))
    postings = fps.select("fp", keys.alias("key")).select("key.k", "key.v", "fp")
    lists = postings.groupBy("k", "v").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    held = (
        postings.join(lists, ["k", "v"])
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("fp", F.lit(7)), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("k", "v", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp")
    )

    def meet(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["k", "v", "i", "j"]):
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            fp = t.column("fp").to_numpy().view(np.uint64)
            own = t.column("own").to_numpy()
            same = i == j
            a = fp if same else fp[own == i]
            b = fp if same else fp[own == j]
            left, right = _forest(a, b, same)
            if left:
                both = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (left, right)]
                yield pa.RecordBatch.from_arrays(both, names=["a", "b"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = held.repartition(parts, "k", "v", "i", "j").sortWithinPartitions("k", "v", "i", "j")
    return dealt.mapInArrow(meet, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): one row for each row of docs.

    component_id is the smallest doc_id that links reach. Null and empty texts and texts without words
    have fingerprint zero and link like any other. A null doc_id is kept and never a
    component_id, unless its component has no other. Repeated rows and ties give repeated rows. Extra columns are not read. An
    empty table gives an empty one.
    """
    fps = written(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    member = components(links(nodes.select("fp"))).withColumnRenamed("node", "fp")
    named = member.join(nodes, "fp")
    least = named.groupBy("root").agg(F.min("least").alias("reached"))
    linked = member.join(least, "root").select("fp", "reached")
    of = nodes.join(linked, "fp", "left").select("fp", F.coalesce("reached", "least").alias("component_id"))
    of = written(of, "classes")  # a plain table, so that the join can split a fingerprint that many rows have
    return fps.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
