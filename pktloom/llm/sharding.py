"""Sharding by weighted rendezvous hashing, with DataFrame functions only.

Each record key draws a number for each shard; the shard with the best weighted draw has it. A shard's draws do not
depend on the other shards, so a new shard takes exactly the records whose best draw it has,
and a removed one gives away only its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a shard in which slots are counted; a part is one task's share.
PARTS = 1024


def shard_of(keys: Sequence[Column | str], weights: Sequence[float]) -> Column:
    """The shard of a record key: argmin over s of -ln(u(key, s)) / weights[s], u uniform in (0, 1).

    Shard s gets weights[s] / sum(weights) of the keys. A shard of weight 0 gets none. Rows with a null key share one key.
    """
    if not weights or any(w < 0 for w in weights) or not any(weights):
        raise ValueError("weights must not be negative, and one must be positive")
    shards = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(float(w)).alias("w")) for s, w in enumerate(weights) if w])

    def draw(shard: Column) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(*keys, shard["s"]), 11) + F.lit(0.5)) * F.lit(2.0**-53)
        return F.struct((-F.log(u) / shard["w"]).alias("d"), shard["s"].alias("s"))

    return F.array_min(F.transform(shards, draw)).getField("s")


def assign(df: DataFrame, keys: Sequence[str], weights: Sequence[float], name: str = "shard") -> DataFrame:
    """df with the shard of each row; a projection, without a shuffle."""
    return df.withColumn(name, shard_of([F.col(k) for k in keys], weights))


def slots(rows: DataFrame, parts: int = PARTS) -> DataFrame:
    """rows (with a column shard) with slot: gapless from 0 in each shard.

    Equal rows are counted before the shuffle and given consecutive slots afterwards. A
    shard is dealt by hash into `parts` parts, ordered within each; the parts' offsets are a running sum
    over shards x parts rows, which is the size of what is broadcast.
    """
    columns = rows.columns
    counted = rows.groupBy(*columns).agg(F.count("*").alias("__n")).withColumn("__part", F.pmod(F.xxhash64(*columns), F.lit(parts)).cast("int"))
    sums = counted.groupBy("shard", "__part").agg(F.sum("__n").alias("__sum"))
    before = Window.partitionBy("shard").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("shard", "__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("shard", "__part").orderBy(*[c for c in columns if c != "shard"]).rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("__before", F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    placed = placed.join(F.broadcast(offsets), ["shard", "__part"])
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1))
    return placed.withColumn("__copy", each).select(*columns, (F.col("__offset") + F.col("__before") + F.col("__copy")).alias("slot"))


def placement(docs: DataFrame, weights: Sequence[float], grown_weights: Sequence[float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of docs.

    law is `key`: doc_id and the shards decide. size is the UTF-8 bytes of the text (null: none) plus 1. Texts are
    reduced to size and checksum as they are read. Rows with a null id share one key; repeated rows
    share their shard and have slots of their own; an empty table gives an empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    out = slots(assign(rows, ["doc_id"], weights))
    grown = shard_of([F.col("doc_id")], grown_weights)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"), "slot", grown.cast("int").alias("grown_shard"))
