"""Flow segments: bounded stretches of an undirected flow, as a sequential pass would close them.

Packets are numbered 0..N-1 in arrival order (idx). A segment closes with its packet_cutoff-th packet, at the
first periodic check at which it is as old as the timeout, or with the input. A segment opened by packet j
would close at check flush(j), which joins in by time; so a flow's segments follow from its own packets alone.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schema import CANONICAL
from ..storage import written
from .ordering import first_at_or_after, row_numbers

CUTOFF = 20
TIMEOUT_NS = 60_000_000_000
INTERVAL = 256
EMIT_BLOCK = 1 << 16
EMIT_RANGE = 1 << 10
#: Numbers of the arrival order in a block of a flow.
BLOCK = 1 << 18
#: An idx that no packet has.
NEVER = (1 << 63) - 1


def validate(cutoff: int, timeout_ns: int, interval: int, graph_tokens: int = 5) -> None:
    if not 1 <= cutoff <= 20:
        raise ValueError("packet_cutoff must be between 1 and 20")
    if graph_tokens != 5:
        raise ValueError("there are 5 graph tokens")
    if interval < 1:
        raise ValueError("the check interval must be positive")
    if timeout_ns <= 0:
        raise ValueError("the timeout must be positive")


def check_table(packets: DataFrame, policy: str, interval: int = INTERVAL) -> DataFrame:
    """(idx, ts_ns) of the packets before which timeouts are checked."""
    if policy not in ("pretrain", "finetune"):
        raise ValueError(f"policy must be pretrain or finetune, not {policy}")
    at = F.col("idx") if policy == "pretrain" else F.col("idx") + 1
    return packets.where(at % interval == 0).select("idx", "ts_ns")


def numbered(packets: DataFrame) -> DataFrame:
    """packets with idx made dense from 0, in its order."""
    out = row_numbers(packets.withColumnRenamed("idx", "__idx"), ["__idx"], F.floor(F.col("__idx") / EMIT_BLOCK).cast("bigint"), "idx")
    return out.select(*packets.columns)


def _whole_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole groups of rows sorted by __key and __blk, with the number of each row's group."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        new = np.zeros(batch.num_rows, bool)
        for c in ("__key", "__blk"):
            x = batch.column(c)
            new[1:] |= pc.not_equal(x.slice(1), x.slice(0, len(x) - 1)).to_numpy(zero_copy_only=False)
        at = int(np.flatnonzero(new)[-1]) if new.any() else 0
        if at:
            yield batch.slice(0, at), np.cumsum(new[:at])
        held = batch.slice(at)
    if held is not None:
        yield held, np.zeros(held.num_rows, np.int64)


class _Steps:
    """For each row, the place of the first row of the next segment of its group, if it were the first of one."""

    def __init__(self, batch: pa.RecordBatch, group: np.ndarray, cutoff: int, block: int):
        self.idx, blk = (batch.column(c).to_numpy() for c in ("__idx", "__blk"))
        first = blk * block
        self.due = pc.fill_null(batch.column("__flush"), NEVER).to_numpy()
        here, width = group * (block + 1), block + 1
        at = np.arange(len(group))
        self.starts = np.flatnonzero(np.diff(group, prepend=-1))
        self.end = np.repeat(np.append(self.starts[1:], len(group)), np.diff(np.append(self.starts, len(group))))
        checked = np.searchsorted(here + self.idx - first, here + np.minimum(self.due - first, width - 1))
        self.next = np.minimum(np.minimum(at + cutoff, np.maximum(checked, at + 1)), self.end)


def _maps(dealt: DataFrame, cutoff: int, block: int) -> DataFrame:
    """What each block of a flow makes of a segment that begins at one of its first packets: the state of the last segment in it.

    A row for each block of a flow: its packets, its first `cutoff` idx, and for each of these the last segment's packets, check and start.
    """

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, group in _whole_groups(batches):
            s = _Steps(batch, group, cutoff, block)
            sizes = s.end[s.starts] - s.starts
            tries = np.minimum(sizes, cutoff)
            ends = np.concatenate(([0], np.cumsum(tries)))
            entry = np.arange(ends[-1]) - np.repeat(ends[:-1], tries) + np.repeat(s.starts, tries)
            last, go = entry.copy(), np.arange(len(entry))
            while len(go):
                step = s.next[last[go]]
                on = step < s.end[entry[go]]
                last[go[on]] = step[on]
                go = go[on]
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (s.idx[entry], s.end[entry] - last, s.due[last], s.idx[last])]
            one = batch.take(pa.array(s.starts))
            yield pa.RecordBatch.from_arrays([one.column("__key"), one.column("__blk"), pa.array(sizes, pa.int64()), *lists], names=["__key", "__blk", "m", "firsts", "n", "due", "start"])

    return dealt.mapInArrow(scan, "__key string, __blk bigint, m bigint, firsts array<bigint>, n array<bigint>, due array<bigint>, start array<bigint>")


def _entries(maps: DataFrame, cutoff: int) -> DataFrame:
    """(__key, __blk, entry, open): how many packets of a block belong to the segment that is open before it, and that segment's start."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, due, start = None, cutoff, NEVER, -1
        for batch in batches:
            out = []
            for k, m, firsts, ns, dues, starts in zip(*(batch.column(c).to_pylist() for c in ("__key", "m", "firsts", "n", "due", "start"))):
                if k != key:
                    key, n, due, start = k, cutoff, NEVER, -1
                entry = min(bisect_left(firsts, due), cutoff - n)
                out.append((entry, start))
                if entry < m:
                    n, due, start = ns[entry], dues[entry], starts[entry]
                else:
                    n += m
            yield pa.RecordBatch.from_arrays([batch.column("__key"), batch.column("__blk"), *(pa.array([r[j] for r in out], pa.int64()) for j in (0, 1))], names=["__key", "__blk", "entry", "open"])

    return maps.mapInArrow(scan, "__key string, __blk bigint, entry bigint, open bigint")


def _starts(dealt: DataFrame, cutoff: int, block: int) -> DataFrame:
    """(idx, flush, seg_start) of rows that know their block's entry."""

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, group in _whole_groups(batches):
            s = _Steps(batch, group, cutoff, block)
            begins = np.zeros(len(group), bool)
            entry = s.starts + pc.fill_null(batch.column("entry"), 0).to_numpy()[s.starts]
            at = entry[entry < s.end[s.starts]]
            while len(at):
                begins[at] = True
                step = s.next[at]
                at = step[step < s.end[at]]
            last = np.maximum.accumulate(np.where(begins, np.arange(len(group)), -1))
            before = last < s.starts[group - group[0]]  # of a segment that an earlier block began
            start = np.where(before, pc.fill_null(batch.column("open"), -1).to_numpy(), s.idx[np.maximum(last, 0)])
            yield pa.RecordBatch.from_arrays([batch.column("__idx"), batch.column("__flush"), pa.array(start, pa.int64())], names=["idx", "flush", "seg_start"])

    return dealt.mapInArrow(scan, "idx bigint, flush bigint, seg_start bigint")


def member_packets(packets: DataFrame, policy: str = "pretrain", cutoff: int = CUTOFF, timeout_ns: int = TIMEOUT_NS, interval: int = INTERVAL, keys: DataFrame | None = None, block: int = BLOCK) -> DataFrame:
    """packets with their canonical key, seg_start (idx of their segment's first packet) and flush (null: never).

    keys: flows that form segments, all if None. A flow is cut into blocks of `block` idx, so that no task sees a whole one. Since a segment holds at most `cutoff` packets,
    the first one that begins in a block begins at one of its first packets; a block's outcome is found for each of these, the
    outcomes are carried over a flow's blocks, one row each, and then each block marks its segments. All this sees three numbers a
    packet, which join the packets by idx.
    """
    validate(cutoff, timeout_ns, interval)
    checks = check_table(packets, policy, interval)
    p = packets.select("*", *[c.alias(f"k_{n}") for n, c in zip(CANONICAL, C.canonical_key())])
    own = [f"k_{n}" for n in CANONICAL]
    if keys is not None:
        p = p.join(keys.select(*[F.col(n).alias(f"k_{n}") for n in CANONICAL]), own, "left_semi")
    order = p.select(F.concat_ws("|", *own).alias("__key"), F.floor(F.col("idx") / block).cast("bigint").alias("__blk"), F.col("idx").alias("__idx"), (F.col("ts_ns") + timeout_ns).alias("__due"))
    order = first_at_or_after(order, "__due", checks, "ts_ns", "idx", "__flush", timeout_ns).drop("__due")
    parts = int(packets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda df: df.repartition(parts, "__key", "__blk").sortWithinPartitions("__key", "__blk", "__idx")
    last = packets.agg(F.max("idx")).first()[0]
    if last is not None and last >= block:
        order = written(order, "order")
        several = written(order.groupBy("__key").agg(F.min("__blk").alias("a"), F.max("__blk").alias("b")).where("a < b").select("__key"), "several")
        maps = _maps(dealt(order.join(several, "__key", "left_semi")), cutoff, block)
        carried = maps.repartition(parts, "__key").sortWithinPartitions("__key", "__blk")
        order = order.join(written(_entries(carried, cutoff), "entries"), ["__key", "__blk"], "left")
    else:  # each flow is in one block
        order = order.withColumn("entry", F.lit(0).cast("bigint")).withColumn("open", F.lit(-1).cast("bigint"))
    return p.join(_starts(dealt(order), cutoff, block), "idx")


def segments(packets: DataFrame, policy: str = "pretrain", cutoff: int = CUTOFF, timeout_ns: int = TIMEOUT_NS, interval: int = INTERVAL, keys: DataFrame | None = None, max_packets: int = 0, max_flows: int = 0, block: int = BLOCK) -> DataFrame:
    """A row for each segment: key, start_idx, n, first_ts, last_ts, last_idx, reason, emit_idx, emit_seq, segment_id, any_label, packets.

    emit_idx is the packet after which the window describes the segment; emit_seq numbers segments as they are emitted (by
    that, then those at their cutoff before those timed out, the earlier opened first) and segment_id numbers them in their flow.
    max_packets and max_flows limit the input and the output, 0 for none. Segments are written to the shared folder once, before they are numbered.
    """
    packets = packets.where(F.col("idx") < max_packets) if max_packets else packets
    p = member_packets(packets, policy, cutoff, timeout_ns, interval, keys, block)
    own = [f"k_{n}" for n in CANONICAL]
    one = F.struct("idx", "ts_ns", "src_ip", "dst_ip", "src_port", "dst_port", "protocol", "packet_code", "ip_len", "label")
    s = p.groupBy(*own, "seg_start").agg(
        F.count("*").alias("n"), F.min_by("ts_ns", "idx").alias("first_ts"), F.max_by("ts_ns", "idx").alias("last_ts"), F.max("idx").alias("last_idx"),
        F.min_by("flush", "idx").alias("flush"), F.bool_or("label").alias("any_label"), F.sort_array(F.collect_list(one)).alias("packets"),  # at most 20
    )
    last = packets.agg(F.max("idx").alias("__last"))
    s = s.crossJoin(last)  # one row
    full = F.col("n") >= cutoff
    reason = F.when(full, "cutoff").when(F.col("flush").isNotNull(), "timeout").otherwise("end")
    emit = F.when(full, F.col("last_idx")).when(F.col("flush").isNotNull(), F.col("flush") - 1).otherwise(F.col("__last"))
    phase = F.when(full, 0).when(F.col("flush").isNotNull(), 1).otherwise(2)
    s = written(s.withColumn("reason", reason).withColumn("emit_idx", emit).withColumn("__phase", phase), "segments")
    few = F.floor(F.col("emit_idx") / EMIT_RANGE).cast("bigint")  # a check may close very many at once
    s = row_numbers(s, ["emit_idx", "__phase", "seg_start"], few, "emit_seq")
    s = row_numbers(s, ["seg_start"], F.floor(F.col("seg_start") / EMIT_BLOCK).cast("bigint"), "segment_id", own)
    s = s.where(F.col("emit_seq") < max_flows) if max_flows else s
    return s.select(*[F.col(f"k_{n}").alias(n) for n in CANONICAL], F.col("seg_start").alias("start_idx"), "n", "first_ts", "last_ts", "last_idx", "reason", "emit_idx", "emit_seq", "segment_id", "any_label", "packets")


def attack_keys(packets: DataFrame) -> DataFrame:
    """Flows that carried an attack packet."""
    return packets.where("label").select(*C.canonical_key()).distinct()


def normal_sample(packets: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """n flows without attack packets, by the least seeded hash; all of them if there are no more."""
    normal = packets.select(*C.canonical_key()).distinct().join(attack_keys(packets), CANONICAL, "left_anti")
    h = C.h32(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in CANONICAL]))
    return normal.withColumn("h", h).orderBy("h", *CANONICAL).limit(n)


def selected_keys(packets: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """The flows of the attack-centred mode: all with attacks, and a sample of the others."""
    return attack_keys(packets).unionByName(normal_sample(packets, n, seed).select(*CANONICAL)).distinct()


def label_segments(segments: DataFrame, policy: str, attacked: DataFrame | None = None) -> DataFrame:
    """segments with label: any attack packet in it (segment_only), or ever in its flow (flow_contaminated)."""
    if policy == "segment_only":
        return segments.withColumn("label", F.col("any_label").cast("int"))
    if policy != "flow_contaminated" or attacked is None:
        raise ValueError("policy must be segment_only, or flow_contaminated with the attacked flows")
    known = attacked.select(*CANONICAL, F.lit(True).alias("__hit"))
    return segments.join(known, CANONICAL, "left").withColumn("label", (F.col("any_label") | F.coalesce("__hit", F.lit(False))).cast("int")).drop("__hit")


def shard_counts(segments: DataFrame, shard_flows: int, label: str = "label") -> DataFrame:
    """Segments of each label in each shard of so many, and in all (shard_id null), by one rollup."""
    shard = F.floor(F.col("emit_seq") / shard_flows).cast("bigint")
    s = segments.select(shard.alias("shard_id"), F.col(label).alias("label"))
    return s.cube("shard_id", "label").agg(F.count("*").alias("n"), F.grouping_id().alias("g")).where("g in (0, 2)").drop("g")
