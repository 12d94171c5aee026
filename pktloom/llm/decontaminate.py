"""Benchmark decontamination: a broadcast hash set of the items' windows, scanned against every document.

Item words are normalised and cut into windows of `size` words. Documents are scanned with a rolling hash over
their words' hashes; positions whose hash is in the set are verified word by word. Words of verified windows are hit.

The set is flat arrays of about 30 bytes a word, broadcast under a checked bound of words. Long items are cut into pieces that
overlap, so that no window is lost, and a larger benchmark is dealt by piece into blocks of about the bound, each scanned against all documents in
turn: every window meets every document at any size, and the set in memory stays bounded.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FEW_PER_CORE, WordHashes, dropped, slices, text_batches, utf8, written

WINDOW = 10
#: Benchmark words that one broadcast set is made of: about 120 MB in each worker.
MAX_WORDS = 4_000_000
#: Windows of a piece of an item.
PIECE = 10_000
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` over UTF-8: digits, a-z and every byte of a non-ASCII character.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_P = np.uint64(0x9E3779B97F4A7C15)
#: Places of the table that tells words which no item has.
_PLACES = 1 << 24
_HASHES = WordHashes()


def words(text: str | None) -> list[bytes]:
    return WORD.findall(utf8(text).lower())


def _hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))


def _rolled(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n words from each position on."""
    out = np.zeros(len(at), np.uint64)
    for k in range(n):
        out = out * _P + h[at + k]
    return out


class WindowSet:
    """The windows of some pieces of items, by their number of words: sorted hashes with places and items, and the words in one string."""

    def __init__(self, pieces: Iterable[tuple[int, bytes]], size: int = WINDOW):
        said, lengths, hashes, owners, firsts, counts = [], [], [], [], [], []
        total = 0
        for item, text in pieces:
            w = text.split(b" ") if text else []
            said.append(b"".join(w))
            lengths.append(np.fromiter(map(len, w), np.int32, len(w)))
            hashes.append(_hashes(w))
            owners.append(item)
            firsts.append(total)
            counts.append(len(w))
            total += len(w)
        self.said = b"".join(said)
        self.ends = np.cumsum(np.concatenate([*lengths, np.zeros(0, np.int32)]), dtype=np.int64)
        h = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        self.known = np.zeros(_PLACES if total else 1, bool)
        self.known[h & np.uint64(len(self.known) - 1)] = True
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for n in sorted({min(c, size) for c in counts if c}):
            own = [k for k, c in enumerate(counts) if min(c, size) == n]
            of = [counts[k] - n + 1 for k in own]
            places = np.concatenate([np.arange(firsts[k], firsts[k] + m, dtype=np.int32) for k, m in zip(own, of)])
            items = np.repeat(np.array([owners[k] for k in own], np.int64), of)
            rolled = _rolled(h, places, n)
            order = np.argsort(rolled, kind="stable")
            self.by_length[n] = rolled[order], places[order], items[order]

    def words_at(self, place: int, n: int) -> tuple[bytes, list[int]]:
        """n words in one string, and where they end in it."""
        first = int(self.ends[place - 1]) if place else 0
        ends = (self.ends[place : place + n] - first).tolist()
        return self.said[first : first + ends[-1]], ends

    def scan(self, found: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words are inside an occurrence of a window, and the items that have one."""
        hit, items = np.zeros(len(found), bool), set()
        if not self.by_length or not found:
            return hit, items
        h = _hashes(found)
        known = np.concatenate(([0], np.cumsum(self.known[h & np.uint64(len(self.known) - 1)])))
        for n, (rolled, places, owners) in self.by_length.items():
            if len(found) < n:
                continue
            at = np.flatnonzero(known[n:] - known[:-n] == n)  # the others have words that no item has
            if not len(at):
                continue
            own = _rolled(h, at, n)
            first = np.searchsorted(rolled, own, "left")
            met = np.flatnonzero(rolled[np.minimum(first, len(rolled) - 1)] == own)
            last = np.searchsorted(rolled, own[met], "right")
            for i, s, e in zip(at[met].tolist(), first[met].tolist(), last.tolist()):
                text, ends = b"".join(found[i : i + n]), np.cumsum(list(map(len, found[i : i + n]))).tolist()
                same = [k for k in range(s, e) if self.words_at(int(places[k]), n) == (text, ends)]
                if same:
                    hit[i : i + n] = True
                    items.update(owners[same].tolist())
        return hit, items


def pieces(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(item, piece, said, n): the words of items (item, item_text) in overlapping pieces, which have each window of the item once."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for item, text in zip(*(c.to_pylist() for c in b.columns)):
                w = words(text)
                for k, at in enumerate(range(0, max(1, len(w) - size + 1) if w else 0, PIECE)):
                    own = w[at : at + PIECE + size - 1]
                    out.append((item, k, b" ".join(own), len(own)))
            if out:
                cols = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.int64()))], names=["item", "piece", "said", "n"])

    return items.mapInArrow(cut, "item bigint, piece bigint, said binary, n bigint")


def _scanned(rows: DataFrame, windows: WindowSet) -> DataFrame:
    """rows with the hits and items of earlier blocks and of this one."""
    shared = rows.sparkSession.sparkContext.broadcast(windows)

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in slices(batches):
            counts, all_hits, all_items = [], [], []
            for text, hits, items in zip(*(b.column(k).to_pylist() for k in ("text", "hits", "items"))):
                found = words(text)
                hit, new = known.scan(found)
                for s, e in zip(hits[::2], hits[1::2]):
                    hit[s:e] = True
                counts.append(len(found))
                all_hits.append(np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0])))))
                all_items.append(sorted(new.union(items)))
            made = [pa.array(counts, pa.int64()), pa.array(all_hits, pa.list_(pa.int64())), pa.array(all_items, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("text"), *made], names=b.schema.names)

    return rows.mapInArrow(scan, rows.schema)


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, max_words: int = MAX_WORDS, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(row, n_words, hits, items) for each row of docs; row holds all its columns.

    hits: word positions in pairs of start and end (exclusive), in order; items: ids of the items with
    occurring windows. Null and wordless texts have none, as have null and wordless items; an item without id
    counts as item -1. Empty tables, repeated rows and items, and extra columns of any name are fine.
    """
    text_batches(docs.sparkSession)
    items = benchmark.select(F.coalesce(F.col(item_col).cast("bigint"), F.lit(-1)).alias("item"), F.col(item_text_col).alias("item_text"))
    said = written(pieces(items, size), "pieces", FEW_PER_CORE)
    blocks = max(1, -(-(said.agg(F.sum("n")).first()[0] or 0) // max_words))
    names = [F.col(f"`{c}`") for c in docs.columns]
    empty = [F.lit(0).cast("bigint").alias("n_words"), F.array().cast("array<bigint>").alias("hits"), F.array().cast("array<bigint>").alias("items")]
    rows, before = docs.select(F.struct(*names).alias("row"), F.col(text_col).alias("text"), *empty), None
    for k in range(blocks):
        own = said.where(F.pmod(F.xxhash64("item", "piece"), F.lit(blocks)) == k)
        rows = _scanned(rows, WindowSet(((r["item"], bytes(r["said"])) for r in own.toLocalIterator()), size))
        if k + 1 < blocks:
            rows = written(rows, "scanned")
            if before is not None:
                dropped(before)
            before = rows
    dropped(said)
    return rows.drop("text")


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each row of docs."""
    found = scan(docs.select(id_col, text_col), benchmark, text_col=text_col, **options)
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda n, x: x - n)  # ends less starts: there is an even number
    listed = F.array_join(F.sort_array(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        F.col("row").getField(id_col).cast("bigint").alias("doc_id"),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(listed.cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


def without_spans(text: str | None, hits: list[int]) -> str | None:
    """The text without its hit words and what stands between them."""
    if text is None or not hits:
        return text
    data = text.encode("utf-8", "replace")
    at = [m.span() for m in WORD.finditer(data.lower())]
    out, last = [], 0
    for s, e in zip(hits[::2], hits[1::2]):
        out.append(data[last : at[s][0]])
        last = at[e - 1][1]
    return b"".join([*out, data[last:]]).decode("utf-8")


def cleaned(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text", **options) -> DataFrame:
    """docs without contamination, with all their columns.

    remove="documents": rows with a hit go. remove="spans": hit words go from their texts. Rows travel through
    one scan, so nothing is joined or shuffled and repeated rows stay apart.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be documents or spans, not {remove}")
    found = scan(docs, benchmark, text_col=text_col, **options)
    if remove == "documents":
        return found.where(F.size("hits") == 0).select("row.*")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = [without_spans(t, h) for t, h in zip(b.column(0).field(text_col).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["row", "kept"])

    rows = found.select("row", "hits")
    schema = rows.schema["row"].dataType.simpleString()
    out = rows.mapInArrow(cut, f"row {schema}, kept string")
    return out.select(*[F.col("kept").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
