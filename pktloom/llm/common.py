"""Helpers shared by the training-data operators: small Arrow batches, sorted groups, and the shared folder."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from ..storage import FEW_PER_CORE, dropped, few_files, new_path, shared_dir, written

__all__ = ["FEW_PER_CORE", "WordHashes", "dropped", "few_files", "free_name", "new_path", "shared_dir", "slices", "sorted_groups", "text_batches", "utf8", "written"]

#: Rows of an Arrow batch that holds whole texts.
TEXT_ROWS = 500
#: Words that a worker remembers before it starts anew.
REMEMBERED = 200_000
#: Rows that are turned into Python objects at once.
SLICE_ROWS = 64


def text_batches(spark: SparkSession) -> None:
    """Whole texts travel to Python in batches of few rows; Spark's bound in bytes on a batch holds beside it.

    Frames are evaluated after this returns, so the session keeps the setting. A smaller one of the user stays.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > TEXT_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    name = f"__{name}"
    while name.lower() in taken:
        name += "_"
    return name


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class WordHashes(dict):
    """64-bit hashes of words, as bytes or text; those that are missing are made, and short ones remembered."""

    def __missing__(self, word: bytes | str) -> int:
        found = xxhash.xxh64_intdigest(word if isinstance(word, bytes) else word.encode("utf-8", "replace"))
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = found
        return found


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "replace")


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of rows with equal integer keys, from batches sorted by them; a run may span batches."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            changed[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for s, e in zip(starts, starts[1:]):
            key = tuple(c[s] for c in cols)
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(batch.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)
