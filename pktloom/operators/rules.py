"""Attack labels from rules: intervals of time in which an address is an attacker."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schema import RULES

BENIGN = "BENIGN"
DIRECTIONS = ("src", "dst", "either")


def rule_rows(rules: Iterable[dict], strict: bool = True) -> list[tuple]:
    """(rule_ord, attacker, start_time, end_time, attack_type, direction) of configured rules, one for each attacker.

    A missing direction is either. strict: attack types are required and directions checked, as labelling wants it;
    else a type defaults to `attack`, and an unknown direction matches nothing.
    """
    out = []
    for k, r in enumerate(rules):
        direction = (r.get("direction") or "either").lower()
        if strict and direction not in DIRECTIONS:
            raise ValueError(f"rule {k}: direction must be one of {DIRECTIONS}, not {direction}")
        kind = r["attack_type"] if strict else r.get("attack_type", "attack")
        out += [(k, a, r["start_time"], r["end_time"], kind, direction) for a in r["attackers"]]
    return out


def load_rules(spark: SparkSession, rules: Iterable[dict], strict: bool = True, offset_hours: int = 0) -> DataFrame:
    """The rule table. A time that can't be read is an error."""
    rows = spark.createDataFrame(rule_rows(rules, strict), "rule_ord int, attacker string, start string, end string, attack_type string, direction string")
    start, end = (C.rule_time_ns(F.col(c), offset_hours) for c in ("start", "end"))
    bad = lambda c: F.raise_error(F.concat(F.lit("not a rule time: "), F.col(c)))
    return rows.select(
        "rule_ord", "attacker", F.coalesce(start, bad("start").cast("bigint")).alias("start_ns"), F.coalesce(end, bad("end").cast("bigint")).alias("end_ns"), "attack_type", "direction"
    )


def rules_file(path: str) -> list[dict]:
    """All rules of a configuration file, in order."""
    with open(path) as f:
        return [r for a in json.load(f)["attacks"] for r in a["rules"]]


def _by_address(rules: DataFrame) -> DataFrame:
    """A row for each attacker address that is one, with its rules in order. Rules are a configuration, so these are few."""
    held = F.sort_array(F.collect_list(F.struct("rule_ord", "start_ns", "end_ns", "attack_type", "direction")))
    return rules.select(C.ip_sort("attacker").alias("ip"), "rule_ord", "start_ns", "end_ns", "attack_type", "direction").where("ip is not null").groupBy("ip").agg(held.alias("held"))


def _matching(held: Column, direction: str) -> Column:
    ts = F.col("ts_ns")
    ok = F.filter(held, lambda r: (ts >= r["start_ns"]) & (ts <= r["end_ns"]) & r["direction"].isin(direction, "either"))
    return F.try_element_at(ok, F.lit(1))


def _joined(packets: DataFrame, rules: DataFrame) -> DataFrame:
    """packets with the rules of their source and destination address; no row is multiplied and no packet is shuffled."""
    of = _by_address(rules)
    src, dst = of.select(F.col("ip").alias("src_sort"), F.col("held").alias("__src")), of.select(F.col("ip").alias("dst_sort"), F.col("held").alias("__dst"))
    return packets.join(src, "src_sort", "left").join(dst, "dst_sort", "left")


def label_first_match(packets: DataFrame, rules: DataFrame, name: str = "attack_type") -> DataFrame:
    """packets with the type of their first rule: by source first, then by destination, in rule order; closed intervals."""
    kind = F.coalesce(_matching(F.col("__src"), "src")["attack_type"], _matching(F.col("__dst"), "dst")["attack_type"], F.lit(BENIGN))
    return _joined(packets, rules).select(*packets.columns, kind.alias(name))


def label_exists(packets: DataFrame, rules: DataFrame, name: str = "attack") -> DataFrame:
    """packets with whether any rule matches them."""
    found = _matching(F.col("__src"), "src").isNotNull() | _matching(F.col("__dst"), "dst").isNotNull()
    return _joined(packets, rules).select(*packets.columns, F.coalesce(found, F.lit(False)).alias(name))


def split_by_class(packets: DataFrame, path: str, name: str = "attack_type") -> None:
    """One folder for each class, as Parquet partitions."""
    packets.write.mode("overwrite").partitionBy(name).parquet(path)
