"""Connected components of a link table by alternating star contraction, distributed throughout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FEW_PER_CORE, dropped, written


def _with_least(rows: DataFrame, m: Column) -> tuple[DataFrame, DataFrame]:
    """rows (a, b) with m, an aggregate of each a, and the table of m: it is written first, so that the join can split a hot a."""
    least = written(rows.groupBy("a").agg(m.alias("m")), "least", FEW_PER_CORE)
    return rows.join(least, "a"), least


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    joined, least = _with_least(both, F.least(F.min("b"), F.col("a")))
    large = written(_clean(joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))), "links", FEW_PER_CORE)
    dropped(least)
    joined, least = _with_least(large, F.min("b"))
    moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    out = written(_clean(moved), "links")
    dropped(large)
    dropped(least)
    return out


def _clean(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, root) of every node with a link; root is the least node that can be reached.

    edges: (a bigint, b bigint), in either direction, repeats and loops allowed; nulls are no links.
    Each round is two grouped minima and two joins of written tables, where a hot node's links are split over tasks, and
    the rounds grow with the logarithm of the longest chain. Links stay on the executors: a round's
    table is written to the shared folder, and the driver sees only a count and a checksum.
    """
    now = written(_clean(edges.select("a", "b").where("a is not null and b is not null")), "links")
    state = _state(now)
    while state[0]:
        after = _round(now)
        dropped(now)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    roots = now.select("b").distinct().select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
