"""Dataset statistics over packets with a boolean class."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schema import CANONICAL

TOP_PROTOCOLS, TOP_PORTS = 10, 20


def class_totals(packets: DataFrame, attack: str = "attack") -> DataFrame:
    return packets.groupBy(F.col(attack).alias("attack")).agg(F.count("*").alias("packets"), F.sum(F.col("ip_len").cast("bigint")).alias("bytes"))


def flow_totals(packets: DataFrame, attack: str = "attack") -> DataFrame:
    """Packets and bytes of each undirected flow in each class."""
    keyed = packets.select(F.col(attack).alias("attack"), *C.canonical_key(), "ip_len")
    return keyed.groupBy("attack", *CANONICAL).agg(F.count("*").alias("packets"), F.sum(F.col("ip_len").cast("bigint")).alias("bytes"))


def distinct_flows(packets: DataFrame, attack: str = "attack") -> DataFrame:
    """Undirected flows of each class; one with packets of both counts in both."""
    keys = packets.select(F.col(attack).alias("attack"), *C.canonical_key()).distinct()
    return keys.groupBy("attack").agg(F.count("*").alias("flows"))


def histogram_top(packets: DataFrame, column: str, n: int, attack: str = "attack") -> DataFrame:
    """The n most frequent values in each class: count descending, value ascending; rank from 1."""
    counts = packets.groupBy(F.col(attack).alias("attack"), F.col(column).alias("value")).agg(F.count("*").alias("n"))
    order = Window.partitionBy("attack").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def dataset_stats(packets: DataFrame, name: str, attack: str = "attack", skipped: int = 0) -> DataFrame:
    """One row: totals of both classes, ratios (0 where there is nothing), averages and top lists."""
    by = lambda c, cond: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    yes, no = F.col("attack"), ~F.col("attack")
    totals = class_totals(packets, attack).agg(
        by("packets", no).alias("benign_packets"), by("packets", yes).alias("attack_packets"), by("bytes", no).alias("benign_bytes"), by("bytes", yes).alias("attack_bytes")
    )
    flows = distinct_flows(packets, attack).agg(by("flows", no).alias("benign_flows"), by("flows", yes).alias("attack_flows"))

    def tops(column: str, n: int, label: str) -> DataFrame:
        top = histogram_top(packets, column, n, attack)
        pick = lambda cond: F.transform(F.sort_array(F.collect_list(F.when(cond, F.struct("rank", "value", "n")))), lambda r: F.struct(r["value"].alias("key"), r["n"].alias("count")))
        return top.agg(pick(no).alias(f"benign_{label}_top"), pick(yes).alias(f"attack_{label}_top"))

    one = totals.crossJoin(flows).crossJoin(tops("protocol", TOP_PROTOCOLS, "proto")).crossJoin(tops("dst_port", TOP_PORTS, "dport"))  # one row each
    c = lambda x: F.col(x).cast("double")
    return one.select(
        F.lit(name).alias("name"), "benign_packets", "attack_packets", "benign_flows", "attack_flows", "benign_bytes", "attack_bytes",
        C.safe_ratio(c("attack_packets"), c("attack_packets") + c("benign_packets")).alias("attack_packet_ratio"),
        C.safe_ratio(c("attack_flows"), c("attack_flows") + c("benign_flows")).alias("attack_flow_ratio"),
        C.safe_ratio(c("benign_packets"), c("benign_flows")).alias("avg_pkts_per_benign_flow"), C.safe_ratio(c("attack_packets"), c("attack_flows")).alias("avg_pkts_per_attack_flow"),
        "benign_proto_top", "attack_proto_top", "benign_dport_top", "attack_dport_top", F.lit(skipped).cast("bigint").alias("skipped"),
    )
