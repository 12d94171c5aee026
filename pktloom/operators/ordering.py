"""Windows over a global order, in two levels, so that no task sees the whole table.

Rows are dealt into blocks that follow the order. A block's aggregate is small, the running aggregate over blocks is a
window over one row a block, and the rest is a window inside each block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1 << 16


def _before(df: DataFrame, block: Column, order: Sequence[Column | str], aggregate, within: Sequence[str] = ()) -> tuple[DataFrame, Column]:
    """df with __block and __outer, the aggregate over earlier blocks, and the window inside a block up to the row."""
    df = df.withColumn("__block", block)
    blocks = df.groupBy(*within, "__block").agg(aggregate(False).alias("__inner"))
    running = Window.partitionBy(*within).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*within, "__block", aggregate(True).over(running).alias("__outer"))
    return df.join(blocks, [*within, "__block"]), Window.partitionBy(*within, "__block").orderBy(*order)


def running_max(df: DataFrame, value: str, order: str, name: str, block: int = BLOCK) -> DataFrame:
    """df with the largest value so far in the order of a number column."""
    out, inside = _before(df, F.floor(F.col(order) / block).cast("bigint"), [order], lambda again: F.max("__inner" if again else value))
    return out.withColumn(name, F.greatest("__outer", F.max(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)))).drop("__block", "__outer")


def row_numbers(df: DataFrame, order: Sequence[Column | str], block: Column, name: str, within: Sequence[str] = ()) -> DataFrame:
    """df with 0-based row numbers in an order; block is a number that does not decrease along it."""
    out, inside = _before(df, block, order, lambda again: F.sum("__inner") if again else F.count(F.lit(1)), within)
    return out.withColumn(name, F.coalesce("__outer", F.lit(0)) + F.row_number().over(inside) - 1).drop("__block", "__outer")


def first_at_or_after(targets: DataFrame, target: str, points: DataFrame, at: str, value: str, name: str, width: int) -> DataFrame:
    """targets with the least value of a point at or after their target, null if there is none.

    Both are dealt by time into buckets of `width`; a target's answer is the least of what its bucket and all later ones say, so points' values
    may go down along their time. Running minima go from the last time to the first: a frame that grows backwards is
    computed anew for every row.
    """
    bucket = lambda c: F.floor(F.col(c) / width).cast("bigint")
    p = points.select(F.col(at).alias("__at"), F.col(value).cast("bigint").alias("__value")).withColumn("__bucket", bucket("__at"))
    firsts = p.groupBy("__bucket").agg(F.min("__value").alias("__first"))
    t = targets.withColumn("__bucket", bucket(target))
    own = t.select("__bucket", F.col(target).alias("__at"), F.lit(0).alias("__point"), F.lit(None).cast("bigint").alias("__value"), F.struct(*targets.columns).alias("__row"))
    both = own.unionByName(p.select("__bucket", "__at", F.lit(1).alias("__point"), "__value", F.lit(None).cast(own.schema["__row"].dataType).alias("__row")))
    after = Window.partitionBy("__bucket").orderBy(F.desc("__at"), F.desc("__point")).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("__own", F.min("__value").over(after)).where("__point = 0")
    # one row for each bucket that has a point or a target from here on
    every = firsts.unionByName(t.select("__bucket", F.lit(None).cast("bigint").alias("__first"))).groupBy("__bucket").agg(F.min("__first").alias("__first"))
    later = F.min("__first").over(Window.orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, -1))
    out = both.join(every.select("__bucket", later.alias("__later")), "__bucket")
    return out.select("__row.*", F.least("__own", "__later").alias(name))
