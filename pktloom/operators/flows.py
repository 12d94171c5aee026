"""Gap sessions of directed flows and their features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import fixed6
from ..schema import KEY

GAP_NS = 120_000_000_000
BATCH_LINES = 5_000_000
#: Rows of the arrival order that one task holds of a flow.
BLOCK = 1 << 20


def sessionize(packets: DataFrame, gap_ns: int = GAP_NS, batch: int | None = None, key: list[str] = KEY, block: int = BLOCK) -> DataFrame:
    """packets with session (from 0 for each flow and batch) and gap_ns, the time since the packet before it in the session.

    A flow is split where a packet comes more than gap_ns after the one before it in arrival order, and, if
    batch is given, where idx enters a new batch of so many lines. Flows are cut into blocks of the arrival
    order, whose last times and split counts are carried over, so a flow of any size is shared by many tasks.
    """
    number = F.floor(F.col("idx") / batch).cast("bigint") if batch else F.lit(0).cast("bigint")
    p = packets.withColumn("batch", number).withColumn("__block", F.floor(F.col("idx") / block).cast("bigint"))
    own = [*key, "batch"]
    inside, across = Window.partitionBy(*own, "__block").orderBy("idx"), Window.partitionBy(*own).orderBy("__block")
    lasts = p.groupBy(*own, "__block").agg(F.max_by("ts_ns", "idx").alias("__last"))
    lasts = lasts.select(*own, "__block", F.lag("__last").over(across).alias("__carried"))
    p = p.join(lasts, [*own, "__block"])
    before = F.coalesce(F.lag("ts_ns").over(inside), "__carried")
    p = p.withColumn("__gap", F.col("ts_ns") - before)
    p = p.withColumn("__new", F.coalesce(F.col("__gap") > gap_ns, F.lit(False)).cast("bigint"))
    splits = p.groupBy(*own, "__block").agg(F.sum("__new").alias("__splits"))
    splits = splits.select(*own, "__block", F.coalesce(F.sum("__splits").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__earlier"))
    p = p.join(splits, [*own, "__block"])
    session = F.col("__earlier") + F.sum("__new").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    gap = F.when(F.col("__new") == 0, F.col("__gap"))
    return p.select(*packets.columns, "batch", session.alias("session"), gap.alias("gap_ns"))


def _std(n: Column, total: Column, squares: Column, unit: float) -> Column:
    """Population standard deviation from whole sums, in units: 0 below two values."""
    spread = n.cast("decimal(38,0)") * squares - total.cast("decimal(19,0)") * total.cast("decimal(19,0)")
    return F.when(n > 1, F.sqrt(F.greatest(spread.cast("double"), F.lit(0.0))) / n / unit).otherwise(0.0)


def flow_features(sessions: DataFrame, key: list[str] = KEY) -> DataFrame:
    """A row for each session: start, rates, lengths, inter-arrival times and label.

    Lengths and gaps are summed as whole numbers, so results do not depend on the order of partial sums. Only gaps
    that are not negative count as inter-arrival times.
    """
    gap = F.when(F.col("gap_ns") >= 0, F.col("gap_ns"))
    length = F.col("ip_len").cast("bigint")
    s = sessions.groupBy(*key, "batch", "session").agg(
        F.min_by("ts_ns", "idx").alias("start_ts"), F.max_by("ts_ns", "idx").alias("end_ts"), F.count("*").alias("n"), F.sum(length).alias("bytes"),
        F.sum((length * length).cast("decimal(20,0)")).alias("bytes2"), F.count(gap).alias("gaps"), F.coalesce(F.sum(gap), F.lit(0)).alias("gap_sum"),
        F.coalesce(F.sum(gap.cast("decimal(19,0)") * gap.cast("decimal(19,0)")), F.lit(0)).alias("gap2"), F.bool_or("label").alias("label"),
    )
    duration = (F.col("end_ts") - F.col("start_ts")) / 1e9
    rate = lambda c: F.when(duration > 1e-6, F.col(c) / duration).otherwise(0.0)
    mean = F.col("bytes") / F.col("n")
    return s.select(
        *key, "batch", "session", "start_ts", rate("bytes").alias("byteps"), rate("n").alias("pps"), duration.alias("duration"), mean.alias("pkt_len_mean"),
        _std(F.col("n"), F.col("bytes"), F.col("bytes2"), 1.0).alias("pkt_len_std"),
        F.when(F.col("gaps") > 0, F.col("gap_sum") / F.col("gaps") / 1e9).otherwise(0.0).alias("iat_mean"),
        _std(F.col("gaps"), F.col("gap_sum"), F.col("gap2"), 1e9).alias("iat_std"),
        F.col("n").alias("fwd_pkts"), F.lit(0).cast("bigint").alias("bwd_pkts"), mean.alias("fwd_segment_size"), F.lit(0.0).alias("bwd_segment_size"), "label",
    )


def csv_rows(features: DataFrame) -> DataFrame:
    """The 18 text columns of a flow CSV.

    A start before 1970 that is no whole second prints as 1970-01-01 00:00:00, and labels as ATTACK or BENIGN.
    """
    ts = F.col("start_ts")
    odd = (ts < 0) & (F.pmod(ts, F.lit(1_000_000_000)) != 0)
    at = F.when(odd, F.lit(0)).otherwise(F.floor(ts / 1_000_000_000).cast("bigint"))
    f6 = lambda c: fixed6(F.col(c)).alias(c)
    return features.select(
        "src_ip", "src_port", "dst_ip", "dst_port", "protocol", F.date_format(F.to_utc_timestamp(F.timestamp_seconds(at), F.current_timezone()), "MM/dd/yyyy HH:mm:ss").alias("timestamp"),
        *map(f6, ["byteps", "pps", "duration", "pkt_len_mean", "pkt_len_std", "iat_mean", "iat_std"]), "fwd_pkts", "bwd_pkts", f6("fwd_segment_size"), f6("bwd_segment_size"),
        F.when(F.col("label"), "ATTACK").otherwise("BENIGN").alias("label"),
    )
