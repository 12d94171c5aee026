"""Substring deduplication by hashing lines, pieces of lines, or paragraphs.

Texts are cut into units, units are normalised (lower case, white space as one space) and digested, equal digests
are grouped over the whole table, the occurrence of the least rank (doc_id, row, position) is kept, and the rest is
removed; every removed unit keeps its offsets in the original text and points at the kept one.

A passage that starts or ends inside a line shares no whole line with its copies. So a line is cut further, into pieces of about
PIECE words: it is cut between two words if the hash of the pair says so, which is the same in every copy, and a passage shares all pieces
but its first and last. Units are removed in runs of neighbours of at least `min_words` words in all, so that pieces which are equal by
chance leave a text alone; min_words=1 removes every repeated unit.

The table of units is written to the shared folder, where its two readers find it whatever happens to an executor.

Skew: a digest's least occurrence is a partial aggregate, and occurrences meet their kept one in a join whose
large partitions can be split. Only one row's own units meet in one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import FEW_PER_CORE, WordHashes, few_files, free_name, slices, text_batches, written

#: Words of a run of repeated units that is removed, at least.
MIN_WORDS = 20
#: Words of a piece of a line, on average.
PIECE = 8
ENDS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[^\S\n]*\n\s*")}
UNITS = ("piece", *ENDS)
_WORD = re.compile(r"\S+")

_UNITS = "row_id bigint, doc_id bigint, unit bigint, start bigint, end bigint, n_words bigint, h1 bigint, h2 bigint"


_HASHES = WordHashes()


def pieces(text: str) -> list[tuple[int, int, str]]:
    """(start, end, normalised) of the pieces of a text's lines."""
    spans = [m.span() for m in _WORD.finditer(text)]
    if not spans:
        return []
    words = text.lower().split()
    n = len(words)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, n)
    with np.errstate(over="ignore"):
        pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ h[1:]) * np.uint64(0xD6E8FEB86659FD93)
    cut = (pair >> np.uint64(32)) % np.uint64(PIECE) == 0
    at = np.array(spans, np.int64)
    if "\n" in text:
        ends = np.array([m.start() for m in ENDS["line"].finditer(text)], np.int64)
        cut |= np.searchsorted(ends, at[1:, 0]) > np.searchsorted(ends, at[:-1, 1])
    firsts = [0, *(np.flatnonzero(cut) + 1).tolist(), n]
    return [(spans[i][0], spans[j - 1][1], " ".join(words[i:j])) for i, j in zip(firsts, firsts[1:])]


def units(text: str | None, unit: str = "piece") -> list[tuple[int, int, str]]:
    """(start, end, normalised) of the units of a text, without outer white space; blank ones are none."""
    text = text or ""
    if unit == "piece":
        return pieces(text)
    out: list[tuple[int, int, str]] = []
    at = 0
    for end in (*(m.end() for m in ENDS[unit].finditer(text)), len(text)):
        part = text[at:end]
        words = part.lower().split()
        if words:
            out.append((at + len(part) - len(part.lstrip()), at + len(part.rstrip()), " ".join(words)))
        at = end
    return out


def unit_table(docs: DataFrame, row_col: str, id_col: str = "doc_id", text_col: str = "text", unit: str = "piece") -> DataFrame:
    """A row for each unit of numbered rows: the row it is in, its place and offsets (code points), its words and 128-bit digest."""
    text_batches(docs.sparkSession)
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit}")

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for b in slices(batches):
            rows, starts, ends, numbers, words, digests = [], [], [], [], [], []
            for k, text in enumerate(b.column(2).to_pylist()):
                for n, (s, e, norm) in enumerate(units(text, unit)):
                    rows.append(k)
                    numbers.append(n)
                    starts.append(s)
                    ends.append(e)
                    words.append(norm.count(" ") + 1)
                    digests.append(digest(norm.encode("utf-8", "replace")))
            if rows:
                h = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                at = pa.array(rows, pa.int64())
                cols = [b.column(0).take(at), b.column(1).take(at), *(pa.array(x, pa.int64()) for x in (numbers, starts, ends, words)), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())]
                yield pa.RecordBatch.from_arrays(cols, names=["row_id", "doc_id", "unit", "start", "end", "n_words", "h1", "h2"])

    rows = docs.select(F.col(row_col).alias("row_id"), F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(scan, _UNITS)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a number for each row, and its column; a scan's partitions and rows come in the same order again, so it stays the same."""
    row = free_name(docs, "row_id")
    return docs.withColumn(row, F.monotonically_increasing_id()), row


def _removed(numbered: DataFrame, row_col: str, id_col: str, text_col: str, unit: str, min_words: int) -> DataFrame:
    found = written(unit_table(numbered, row_col, id_col, text_col, unit), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_id", "unit", "start", "end")
    groups = found.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(rank).alias("kept")).where("n > 1")
    groups = written(groups.select("h1", "h2", "kept"), "repeated", FEW_PER_CORE)
    again = found.join(groups, ["h1", "h2"]).where((F.col("row_id") != F.col("kept.row_id")) | (F.col("unit") != F.col("kept.unit")))
    of_row = Window.partitionBy("row_id")
    run = again.withColumn("run", F.col("unit") - F.row_number().over(of_row.orderBy("unit")))
    run = run.withColumn("run_words", F.sum("n_words").over(Window.partitionBy("row_id", "run")))
    return run.where(F.col("run_words") >= min_words).select(
        "row_id", "doc_id", "unit", "start", "end", "n_words", F.lower(F.concat(F.lpad(F.hex("h2"), 16, "0"), F.lpad(F.hex("h1"), 16, "0"))).alias("digest"),
        F.col("kept.doc_id").alias("kept_doc_id"), F.col("kept.start").alias("kept_start"), F.col("kept.end").alias("kept_end"),
    )


def removed_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "piece", min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each removed unit: (doc_id, unit, start, end, n_words, digest, kept_doc_id, kept_start, kept_end).

    Offsets are code points of the original text, end exclusive. Rows without repeated passages do not appear.
    Null, empty and blank texts have no units. Of repeated rows the first keeps its text and the others lose theirs.
    A null doc_id ranks last. Ties of rank are rows with equal ids, which their order in the table decides.
    """
    return few_files(_removed(*_numbered(docs), id_col, text_col, unit, min_words).drop("row_id"), FEW_PER_CORE)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "piece", min_words: int = MIN_WORDS, removed_col: str = "removed") -> DataFrame:
    """docs with all their columns, their text without removed units, and removed_col: the units' offsets in the original.

    docs must give its rows in the same order each time it is read, as a table does. If docs has a column of the name removed_col
    it is an error of the caller. Nulls, blank texts, ties and repeated rows are as in removed_units.
    """
    if removed_col in docs.columns:
        raise ValueError(f"docs must not have a column {removed_col}")
    numbered, row = _numbered(docs)
    spans = _removed(numbered, row, id_col, text_col, unit, min_words)
    spans = spans.groupBy("row_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(removed_col)).withColumnRenamed("row_id", row)
    joined = numbered.join(spans, row, "left")
    rest = F.aggregate(
        removed_col,
        F.struct(F.lit("").alias("kept"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, s: F.struct(F.concat(acc["kept"], F.substring(F.col(text_col), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))).alias("kept"), s["end"].alias("at")),
        lambda acc: F.concat(acc["kept"], F.substring(F.col(text_col), (acc["at"] + 1).cast("int"), F.length(text_col))),
    )
    text = F.when(F.col(removed_col).isNull(), F.col(text_col)).otherwise(rest)
    return joined.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns], F.coalesce(removed_col, F.array().cast(spans.schema[removed_col].dataType)).alias(removed_col))
