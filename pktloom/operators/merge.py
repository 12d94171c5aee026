"""Rebasing, looping, sampling and ordered merging of packet streams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schema import CANONICAL, KEY
from ..storage import FEW_PER_CORE, written
from .ordering import row_numbers, running_max

GAP_NS = 1_000_000
#: Nanoseconds of the distinct keys that one task sums, and rows of a stream that one numbers.
BLOCK_NS, ORDER_BLOCK = 1_000_000_000, 1 << 16
TIME_BINS = 30
#: Flows that one task walks when a budget chooses among them.
WALK_ROWS = 200_000


def _floor_us(ts: Column) -> Column:
    return ts - F.pmod(ts, F.lit(1000))


def compact(frames: DataFrame, gap_ns: int = GAP_NS) -> DataFrame:
    """frames with all files on one timeline from 0: a file starts a gap after the end of the one before it.

    A file's ends are its first and last frame by position. Earlier times than the first count as it, and results are whole microseconds.
    """
    ends = frames.groupBy("file_ord").agg(F.min_by("ts_ns", "frame_no").alias("first"), F.max_by("ts_ns", "frame_no").alias("last"))
    step = F.greatest(F.col("last") - F.col("first"), F.lit(0)) + gap_ns
    earlier = Window.orderBy("file_ord").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    files = ends.select("file_ord", "first", F.coalesce(F.sum(step).over(earlier), F.lit(0)).alias("cursor"))
    ts = F.col("cursor") + F.greatest(F.col("ts_ns") - F.col("first"), F.lit(0))
    return frames.join(files, "file_ord").withColumn("ts_ns", _floor_us(ts)).drop("first", "cursor")


@dataclass
class Bounds:
    """A stream's first and last time by position, its latest time, and its last position."""

    first: int
    last: int
    latest: int
    last_idx: int

    @property
    def duration(self) -> int:
        return max(0, self.last - self.first)


def bounds(packets: DataFrame) -> Bounds | None:
    r = packets.agg(F.min_by("ts_ns", "idx"), F.max_by("ts_ns", "idx"), F.max("ts_ns"), F.max("idx")).first()
    return None if r[0] is None else Bounds(*r)


def align_and_loop(benign: DataFrame, of: Bounds, attack: Bounds) -> DataFrame:
    """Benign rows of as many cycles as the attack lasts, with cycle, ord (their order) and aligned_ns.

    Cycle 0 starts a tenth of the benign duration before the attack; each cycle comes duration + 1 ms after the one before it.
    """
    base, step = max(0, attack.first - of.duration // 10), of.duration + GAP_NS
    cycles = max(0, -(-(attack.latest - base) // step))
    looped = benign.withColumn("cycle", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(cycles).cast("bigint"))))
    aligned = F.lit(base) + F.greatest(F.col("ts_ns") - of.first, F.lit(0)) + F.col("cycle") * step
    return looped.withColumn("ord", F.col("cycle") * (of.last_idx + 1) + F.col("idx")).withColumn("aligned_ns", aligned)


def sampled(rate: float, seed: int = 0) -> Column:
    """Whether a packet's undirected flow is in the sample: equal flows decide alike. Packets without a key decide by idx."""
    rate = min(1.0, max(0.0, rate))
    if rate >= 1:
        return F.lit(True)
    own = F.when(F.col("src_ip").isNull(), F.concat_ws("|", F.lit(str(seed)), F.col("idx").cast("string"))).otherwise(C.canonical_text())
    return C.h32(own) < int(rate * 2**32)


def merge_ordered(attack: DataFrame, benign: DataFrame, rate: float = 1.0, seed: int = 0, block_ns: int = BLOCK_NS) -> DataFrame:
    """Both streams in one order: seq, idx, cycle, is_attack, ts_ns (whole microseconds), rel_ns and the other packet columns.

    A two-pointer merge in arrival order, in which an attack packet goes first on ties and the end of the attack ends it, is a sort by
    running maxima: attack rows by theirs, and the benign rows whose running maximum is below the attack's largest. Sampling comes
    after the maxima, since packets that it drops are compared all the same.
    """
    a, b = bounds(attack), bounds(benign)
    if a is None:
        return _no_rows(attack)
    return _merged(attack, a, align_and_loop(benign, b, a) if b is not None else None, sampled(rate, seed), block_ns)


def _merged(attack: DataFrame, a: Bounds, looped: DataFrame | None, keep: Column, block_ns: int) -> DataFrame:
    others = [c for c in attack.columns if c not in ("idx", "ts_ns")]
    both = running_max(attack, "ts_ns", "idx", "key").select(F.lit(0).alias("is_benign"), F.lit(0).cast("bigint").alias("cycle"), F.col("idx").alias("ord"), "idx", "key", F.col("ts_ns").alias("at"), *others)
    if looped is not None:
        ben = running_max(looped, "aligned_ns", "ord", "key").where(F.col("key") < a.latest).where(keep)
        both = both.unionByName(ben.select(F.lit(1).alias("is_benign"), "cycle", "ord", "idx", "key", F.col("aligned_ns").alias("at"), *others))
    numbered = _interleaved(both, block_ns)
    at = _floor_us(F.col("at"))
    first = both.agg(F.min_by("at", F.struct("key", "is_benign", "ord")).alias("first")).select(_floor_us(F.col("first")).alias("start"))
    return numbered.crossJoin(first).select("seq", "idx", "cycle", (F.col("is_benign") == 0).alias("is_attack"), at.alias("ts_ns"), (at - F.col("start")).alias("rel_ns"), *others)  # one row


def _interleaved(both: DataFrame, block_ns: int) -> DataFrame:
    """Rows of both streams with seq, their 0-based place by key, is_benign and ord.

    A row's place is its own in its stream plus the number of rows of the other stream that go before it. The former is counted in blocks of the
    stream's order, and the latter by running sums over distinct keys, so that rows which share a running maximum, as all do after one
    late clock, do not meet in one task.
    """
    numbered = row_numbers(both, ["ord"], F.floor(F.col("ord") / ORDER_BLOCK).cast("bigint"), "__n", ["is_benign"])
    attack = F.count_if(F.col("is_benign") == 0)
    keys = both.groupBy("key").agg(attack.alias("a"), (F.count("*") - attack).alias("b")).withColumn("__block", F.floor(F.col("key") / block_ns).cast("bigint"))
    earlier = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    blocks = keys.groupBy("__block").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    blocks = blocks.select("__block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_outer") for c in "ab"])
    inside = Window.partitionBy("__block").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.col(f"{c}_outer") + F.coalesce(F.sum(c).over(inside), F.lit(0))
    places = keys.join(blocks, "__block").select("key", (before("a") + F.col("a")).alias("__attacks"), before("b").alias("__benign"))
    ahead = F.when(F.col("is_benign") == 0, F.col("__benign")).otherwise(F.col("__attacks"))  # attack rows go first on ties
    return numbered.join(places, "key").withColumn("seq", F.col("__n") + ahead).drop("__n", "__attacks", "__benign")


def _no_rows(attack: DataFrame) -> DataFrame:
    others = [c for c in attack.columns if c not in ("idx", "ts_ns")]
    zero = F.lit(0).cast("bigint")
    return attack.where("false").select(zero.alias("seq"), "idx", zero.alias("cycle"), F.lit(True).alias("is_attack"), "ts_ns", zero.alias("rel_ns"), *others)


def flow_stats(packets: DataFrame, bidirectional: bool = False) -> DataFrame:
    """pkts, first_ts and last_ts of each flow; packets without a key are in none."""
    key = C.canonical_key() if bidirectional else [F.col(c) for c in KEY]
    p = packets.where("src_ip is not null").select(*key, "ts_ns")
    return p.groupBy(*(CANONICAL if bidirectional else KEY)).agg(F.count("*").alias("pkts"), F.min("ts_ns").alias("first_ts"), F.max("ts_ns").alias("last_ts"))


def weight(pkts: Column, attack: bool) -> Column:
    """How much a flow is wanted: heavy attack flows more, heavy benign flows less."""
    return F.log(pkts.cast("double") + 1) if attack else 1 / F.greatest(F.sqrt(pkts.cast("double")), F.lit(1.0))


def time_bin(first_ts: Column, min_ts: int, max_ts: int, bins: int = TIME_BINS) -> Column:
    """The flow's share of the time span, as one of `bins`, in whole arithmetic."""
    bins, span = max(1, bins), max(1, max_ts - min_ts)
    rel = F.greatest(first_ts - min_ts, F.lit(0)).cast("decimal(20,0)")
    return F.least(F.call_function("div", rel * bins, F.lit(span).cast("decimal(20,0)")).cast("int"), F.lit(bins - 1))


def sampling_key(key: list[str], pkts: Column, attack: bool, seed: int, salt: str) -> Column:
    """-ln(u) / weight with u in (0, 1) from the flow's hash: the order of weighted sampling without replacement."""
    u = (C.h32(F.concat_ws("|", F.lit(f"{seed}|{salt}"), *[F.col(c).cast("string") for c in key])) + 0.5) / 2.0**32
    return -F.log(u) / F.greatest(weight(pkts, attack), F.lit(1e-12))


def _walked(flows: DataFrame, group: str) -> DataFrame:
    """Rows that fit, group by group in order: each within what its group has left (__left). A task holds one row's state."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, used = None, 0
        for b in batches:
            keep = []
            for g, p, left in zip(*(b.column(c).to_pylist() for c in (group, "pkts", "__left"))):
                if g != own:
                    own, used = g, 0
                keep.append(used + p <= left)
                used += p if keep[-1] else 0
            yield b.filter(pa.array(keep, pa.bool_()))

    return flows.mapInArrow(scan, flows.schema)


def _greedy(flows: DataFrame, group: str, order: list[str], quota: int, rows: int = WALK_ROWS) -> DataFrame:
    """Rows that a greedy walk in order takes, in each group on its own: each row that fits into what is left of the quota.

    No more than `rows` flows are walked as they are. More are dealt into blocks of about so many in the order. From the blocks' sums follows how many blocks of a group fit as a whole, which are
    taken without a walk; the block after them is walked by one task; and flows larger than what is then left drop out of the blocks
    after it, before their sums are taken again. The driver holds a row for each group and block.
    """
    spark = flows.sparkSession
    table = written(flows, "flows", FEW_PER_CORE)
    parts = -(-table.count() // rows)
    if parts <= 1:
        return _walked(table.withColumn("__left", F.lit(quota).cast("bigint")).repartition(group).sortWithinPartitions(group, *order), group).select(*flows.columns)
    table = written(table.repartitionByRange(parts, group, *order).withColumn("__block", F.spark_partition_id()), "flows")
    kind = table.schema[group].dataType.simpleString()
    small = lambda rows, columns: F.broadcast(spark.createDataFrame(rows, f"{group} {kind}, {columns}"))
    state = {r[0]: (0, quota) for r in table.select(group).distinct().collect()}  # next block, and what is left
    whole, walked = [], []
    while state:
        open_ = table.join(small([(g, at, left) for g, (at, left) in state.items()], "__at int, __left bigint"), group).where("__block >= __at and pkts <= __left")
        sums: dict = {}
        for r in open_.groupBy(group, "__block").agg(F.sum("pkts").alias("n")).orderBy(group, "__block").collect():
            sums.setdefault(r[0], []).append((r[1], r.n))
        edge = []
        for g, blocks in sums.items():
            at, left = state[g]
            rest = left
            for block, n in blocks:
                if n > rest:
                    edge.append((g, block, left, rest))
                    break
                rest -= n
            whole.append((g, at, edge[-1][1] if edge and edge[-1][0] == g else parts, left))
        if not edge:
            break
        one = table.join(small([(g, block, rest) for g, block, _, rest in edge], "__at int, __left bigint"), group).where("__block = __at and pkts <= __left")
        one = written(_walked(one.repartition(len(edge), group).sortWithinPartitions(group, *order), group).select(*flows.columns), "walked")
        walked.append(one)
        used = {r[0]: r.n for r in one.groupBy(group).agg(F.sum("pkts").alias("n")).collect()}
        state = {g: (block + 1, rest - used.get(g, 0)) for g, block, _, rest in edge if block + 1 < parts and rest > used.get(g, 0)}
    out = table.join(small(whole, "__from int, __to int, __most bigint"), group).where("__block >= __from and __block < __to and pkts <= __most").select(*flows.columns)
    for one in walked:
        out = out.unionByName(one)
    return out


def select_by_budget(stats: DataFrame, key: list[str], min_ts: int, max_ts: int, budget: int, bins: int = TIME_BINS, attack: bool = False, seed: int = 0, walk_rows: int = WALK_ROWS) -> DataFrame:
    """The flows of stats that a budget of packets takes.

    Each time bin takes flows in weighted random order while its share of the budget lasts, skipping those that do not fit;
    what is left goes to the other flows in the same way. Bins are independent if the budget has a packet for each; else a bin's share is one packet, and
    the first bins that have a flow of one packet take one each.
    """
    if budget <= 0:
        return stats.where("false")
    bins = max(1, bins)
    pkts = F.col("pkts")
    quota = max(1, budget // bins)
    f = stats.withColumn("__bin", time_bin(F.col("first_ts"), min_ts, max_ts, bins)).withColumn("__key", sampling_key(key, pkts, attack, seed, "bin"))
    f = f.where(pkts <= quota)
    if budget >= bins:
        first = _greedy(f, "__bin", ["__key", *key], quota, walk_rows)
    else:
        least = F.min(F.struct("__key", *key, F.struct(*[F.col(c) for c in stats.columns]).alias("row"))).alias("least")
        first = f.groupBy("__bin").agg(least).orderBy("__bin").limit(budget).select("least.row.*")
    first = written(first.select(*stats.columns), "chosen")
    left = budget - (first.agg(F.sum("pkts")).first()[0] or 0)
    if left <= 0:
        return first
    rest = stats.join(first.select(*key), key, "left_anti").where(pkts <= left)
    rest = rest.withColumn("__key", sampling_key(key, pkts, attack, seed, "rest")).withColumn("__bin", F.lit(0))
    return first.unionByName(_greedy(rest, "__bin", ["__key", *key], left, walk_rows).select(*stats.columns))


def merge_by_budget(attack: DataFrame, benign: DataFrame, total: int, attack_ratio: float, bins: int = TIME_BINS, bidirectional: bool = False, seed: int = 0) -> DataFrame:
    """merge_ordered of the packets of selected flows, at most `total` of them, of which a share are attack packets.

    Time bins span both raw streams. Without a selected benign flow there are no benign rows.
    """
    n_attack = int(total * min(1.0, max(0.0, attack_ratio)))
    key = CANONICAL if bidirectional else KEY
    span = attack.select("ts_ns").unionByName(benign.select("ts_ns")).agg(F.min("ts_ns"), F.max("ts_ns")).first()
    if span[0] is None:
        return merge_ordered(attack, benign)

    def chosen(packets: DataFrame, budget: int, is_attack: bool) -> DataFrame:
        flows = select_by_budget(flow_stats(packets, bidirectional), key, span[0], span[1], budget, bins, is_attack, seed)
        keyed = packets.select("*", *[c.alias(f"__{n}") for n, c in zip(CANONICAL, C.canonical_key())]) if bidirectional else packets.select("*", *[F.col(c).alias(f"__{c}") for c in KEY])
        return keyed.join(flows.select(*[F.col(c).alias(f"__{c}") for c in key]), [f"__{c}" for c in key], "left_semi").select(*packets.columns)

    atk = chosen(attack, n_attack, True)
    atk = row_numbers(atk, ["idx"], F.floor(F.col("idx") / ORDER_BLOCK).cast("bigint"), "__n").where(F.col("__n") < n_attack).drop("__n")
    atk = written(atk, "attack", FEW_PER_CORE)  # no more than the budget, and read several times
    a, b = bounds(atk), bounds(benign)
    if a is None or b is None:
        return merge_ordered(atk, benign.where("false"))
    ben = chosen(benign, total - n_attack, False)
    looped = align_and_loop(ben, b, a)
    looped = row_numbers(looped, ["ord"], F.floor(F.col("ord") / ORDER_BLOCK).cast("bigint"), "__n").where(F.col("__n") < total - n_attack).drop("__n")
    looped = written(looped, "benign", FEW_PER_CORE)
    return _merged(atk, a, looped, F.lit(True), BLOCK_NS)
