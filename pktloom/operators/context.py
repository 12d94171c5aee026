"""What a sliding window of packets says about a segment's endpoints, service, edge and surroundings.

The window after packet k is a range of idx: the last packet_limit packets, from the first that is no older than duration_ns. Where times do not
decrease, its content up to a segment's last packet is a range, too; a window with a time that goes back is looked through packet by packet.

Packets and segments are dealt into blocks of idx, each with the packets that windows of its segments reach back to, so a packet is in two blocks
and is shuffled twice, however many segments look at it. In a block, an entity's packets are sorted once: their number, bytes and last time
in a window are differences of running sums, and its flows are the packets whose predecessor in their flow lies before the
window. Only the busiest edges, which no running sum gives, look at a window's packets, as arrays in memory. Equal windows are looked at once,
and a block whose windows are very many is dealt in parts.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..storage import written
from .ordering import first_at_or_after

DURATION_NS = 300_000_000_000
LIMIT = 2000
TOP_EDGES = 5
#: Packets of a block at least; windows that hold more make larger blocks.
BLOCK = 1 << 14
#: Segments of a part of a block, more or less.
SEGMENTS = 1 << 16

_STATE = [("packets", pa.int64()), ("bytes", pa.int64()), ("flows", pa.int64()), ("last_seen", pa.int64())]
_STATE_SQL = "packets:bigint,bytes:bigint,flows:bigint,last_seen:bigint"
_TYPES = {"endpoints": f"array<struct<{_STATE_SQL}>>", "service": f"struct<{_STATE_SQL}>", "edge": f"struct<{_STATE_SQL}>", "graph": f"array<struct<edge:string,{_STATE_SQL}>>"}
PARTS = tuple(_TYPES)


def window_bounds(segments: DataFrame, packets: DataFrame, duration_ns: int = DURATION_NS, limit: int = LIMIT) -> DataFrame:
    """segments with lo and hi, the idx range of the window after packet emit_idx; written to the shared folder, as states read it.

    Bounds are found once for each emit_idx, on rows of two numbers.
    """
    times = packets.select(F.col("idx").alias("emit_idx"), (F.col("ts_ns") - duration_ns).alias("__oldest"))
    after = segments.select("emit_idx").distinct().join(times, "emit_idx")
    after = first_at_or_after(after, "__oldest", packets, "ts_ns", "idx", "__young", duration_ns)
    lo = F.greatest(F.col("emit_idx") - limit + 1, F.col("__young"), F.lit(0))
    return written(segments.join(after.select("emit_idx", lo.alias("lo"), F.col("emit_idx").alias("hi")), "emit_idx"), "bounded")


def _edge(src: str, dst: str) -> Column:
    """An undirected pair of addresses as text, in text order, which is as good as any for equality."""
    return F.concat_ws("|", F.least(src, dst), F.greatest(src, dst))


def _codes(*columns: pa.ChunkedArray) -> tuple[list[np.ndarray], np.ndarray]:
    """Each column as places of its values in their sorted order, and those values."""
    values, codes = np.unique(np.concatenate([c.to_numpy(zero_copy_only=False) for c in columns]), return_inverse=True)
    ends = np.cumsum([len(c) for c in columns])
    return np.split(codes, ends[:-1]), values


class Block:
    """The packets of a block in order, and the windows of its segments as ranges of their places."""

    def __init__(self, packets: pa.Table, segments: pa.Table):
        self.p, self.s = packets.sort_by("idx"), segments
        of = lambda t, c: t.column(c).to_numpy(zero_copy_only=False)
        idx, self.ts, self.size, flow = (of(self.p, c) for c in ("idx", "ts_ns", "ip_len", "flow"))
        self.n, self.flow, self.until = len(idx), flow, of(segments, "last_ts")
        self.first, self.stop = np.searchsorted(idx, of(segments, "lo"), "left"), np.searchsorted(idx, of(segments, "hi"), "right")
        back = np.flatnonzero(np.diff(self.ts) < 0) + 1  # places whose time is less than the one before
        self.torn = np.searchsorted(back, self.first, "right") < np.searchsorted(back, self.stop, "left")
        run, (ts, until) = np.searchsorted(back, np.arange(self.n + 1), "right"), np.split(np.unique(np.concatenate([self.ts, self.until]), return_inverse=True)[1], [self.n])
        width = self.n + len(self.until)
        end = np.searchsorted(run[: self.n] * width + ts, run[self.first] * width + until, "right")
        self.end = np.maximum(np.minimum(end, self.stop), self.first)
        order = np.lexsort((np.arange(self.n), flow))
        again = np.flatnonzero(flow[order][1:] == flow[order][:-1])
        self.before = np.full(self.n, -1)  # the place of the flow's packet before each
        self.before[order[again + 1]] = order[again]

    def _state(self, places: np.ndarray, codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Four numbers for each segment: of the packets at `places`, those that have its wanted code and are in its window."""
        order = np.lexsort((places, codes))
        places, width = places[order], self.n + 1
        key = codes[order] * width + places
        end = np.where(self.torn, self.stop, self.end)
        asked, of = _distinct(wanted, self.first, end, self.until * self.torn)
        wanted, first, end, until, torn = wanted[asked], self.first[asked], end[asked], self.until[asked], self.torn[asked]
        s, e = np.searchsorted(key, wanted * width + first), np.searchsorted(key, wanted * width + end)
        sums, before = np.concatenate(([0], np.cumsum(self.size[places], dtype=np.int64))), self.before[places]
        out = np.zeros((len(wanted), 4), np.int64)
        out[:, 0], out[:, 1] = e - s, sums[e] - sums[s]
        out[:, 2] = [np.count_nonzero(before[i:j] < w) for i, j, w in zip(s.tolist(), e.tolist(), first.tolist())]
        seen = e > s
        out[seen, 3] = self.ts[places[e[seen] - 1]]
        for x in np.flatnonzero(torn).tolist():
            at = places[s[x] : e[x]]
            at = at[self.ts[at] <= until[x]]
            out[x] = len(at), self.size[at].sum(), len(np.unique(self.flow[at])), self.ts[at].max(initial=0)
        return out[of]

    def endpoints(self) -> pa.Array:
        (src, dst, a, b), _ = _codes(*(self.p.column(c) for c in ("src_ip", "dst_ip")), *(self.s.column(c) for c in ("a_ip", "b_ip")))
        other = np.flatnonzero(src != dst)  # a packet to itself counts once
        places, codes = np.concatenate([np.arange(self.n), other]), np.concatenate([src, dst[other]])
        both = [self._state(places, codes, x) for x in (a, b)]
        rows = np.stack(both, axis=1).reshape(-1, 4)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(rows) + 1, 2, dtype=np.int32)), _structs(rows))

    def service(self) -> pa.Array:
        p, q = (t.column("protocol").to_numpy(zero_copy_only=False).astype(np.int64) for t in (self.p, self.s))
        sp, dp, port = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (self.p.column("src_port"), self.p.column("dst_port"), self.s.column("service_port")))
        other = np.flatnonzero(sp != dp)
        places, codes = np.concatenate([np.arange(self.n), other]), np.concatenate([p << 16 | sp, p[other] << 16 | dp[other]])
        return _structs(self._state(places, codes, q << 16 | port))

    def edge(self) -> pa.Array:
        (own, wanted), _ = _codes(self.p.column("pair"), self.s.column("pair"))
        return _structs(self._state(np.arange(self.n), own, wanted))

    def graph(self, k: int = TOP_EDGES) -> pa.Array:
        (codes,), names = _codes(self.p.column("pair"))
        end = np.where(self.torn, self.stop, self.end)
        asked, of = _distinct(self.first, end, self.until * self.torn)
        found, rows, sizes = [], [], np.zeros(len(asked), np.int64)
        for x, (s, e, until, torn) in enumerate(zip(*(c[asked].tolist() for c in (self.first, end, self.until, self.torn)))):
            place = np.arange(s, e)
            if torn:
                place = place[self.ts[s:e] <= until]
            if not len(place):
                continue
            own = codes[place]
            if len(names) > 4 * len(place):
                named, own = np.unique(own, return_inverse=True)
            else:
                named = None
            packets = np.bincount(own)
            kth = np.partition(packets, -k)[-k] if len(packets) > k else 1
            at = np.flatnonzero(packets >= max(1, kth))
            size = np.bincount(own, self.size[place]).astype(np.int64)[at]
            if torn:
                last = np.zeros(len(packets), np.int64)
                np.maximum.at(last, own, self.ts[place])
                seen = last[at]
                order = np.lexsort((self.flow[place], own))
                o, f = own[order], self.flow[place][order]
                flows = np.bincount(o[np.concatenate(([True], (o[1:] != o[:-1]) | (f[1:] != f[:-1])))], minlength=len(packets))[at]
            else:
                last = np.zeros(len(packets), np.int64)
                last[own] = place  # the last of equals stays
                seen = self.ts[last[at]]
                flows = np.bincount(own[self.before[s:e] < s], minlength=len(packets))[at]
            best = np.lexsort((at, -flows, -seen, -size, -packets[at]))[:k]  # codes are in the order of names
            rows.append(np.stack([packets[at], size, flows, seen], axis=1)[best])
            found.append(at[best] if named is None else named[at[best]])
            sizes[x] = len(best)
        rows = np.concatenate(rows) if rows else np.zeros((0, 4), np.int64)
        pairs = names[np.concatenate(found)].tolist() if found else []
        states = pa.StructArray.from_arrays([pa.array(pairs, pa.string()), *_numbers(rows)], names=["edge", *(n for n, _ in _STATE)])
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), states).take(pa.array(of))


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of rows that stand for all, and for each row the number of the one that stands for it."""
    order = np.lexsort(columns)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of


def _numbers(rows: np.ndarray) -> list[pa.Array]:
    return [pa.array(rows[:, k].copy(), t) for k, (_, t) in enumerate(_STATE)]


def _structs(rows: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays(_numbers(rows), names=[n for n, _ in _STATE])


def states(bounded: DataFrame, packets: DataFrame, limit: int = LIMIT, of: Sequence[str] = PARTS, k: int = TOP_EDGES, block: int = BLOCK) -> DataFrame:
    """(start_idx, *of): for each segment, what its window says of endpoints (two states), service, edge, and graph (up to k edges, busiest first).

    A state has packets, bytes, flows and last_seen, and zeros for an entity without packets in the window. Edges are ranked by packets, bytes, last
    seen and flows, all descending, then by name. A task holds the packets of a block and of the `limit` before it, for some SEGMENTS windows.
    """
    width = max(limit, block)
    number = lambda x: F.floor(x / width).cast("bigint")
    p = packets.select(
        F.explode(F.sequence(number(F.col("idx")), number(F.col("idx") + limit - 1))).alias("blk"), "idx", "ts_ns", F.col("ip_len").cast("bigint").alias("ip_len"), "src_ip", "dst_ip",
        "src_port", "dst_port", "protocol", _edge("src_ip", "dst_ip").alias("pair"), F.xxhash64(*C.canonical_key()).alias("flow"),
    )
    s = bounded.select(number(F.col("hi")).alias("blk"), "start_idx", "lo", "hi", "last_ts", "a_ip", "b_ip", "protocol", C.service_port("a_port", "b_port").alias("service_port"), _edge("a_ip", "b_ip").alias("pair"))

    parts = s.groupBy("blk").agg(F.ceil(F.count("*") / SEGMENTS).cast("int").alias("parts"))
    window = F.pmod(F.xxhash64("lo", "hi", "last_ts"), F.col("parts")).cast("int")
    s = s.join(parts, "blk").withColumn("part", window).drop("parts")
    p = p.join(parts, "blk").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def look(p: pa.Table, s: pa.Table) -> pa.Table:
        if not s.num_rows:
            return pa.table({"start_idx": pa.array([], pa.int64())} | {c: pa.array([], empty[c]) for c in of})
        b = Block(p, s)
        return pa.table({"start_idx": s.column("start_idx")} | {c: b.graph(k) if c == "graph" else getattr(b, c)() for c in of})

    state = pa.struct(_STATE)
    empty = {"endpoints": pa.list_(state), "service": state, "edge": state, "graph": pa.list_(pa.struct([("edge", pa.string()), *_STATE]))}
    schema = "start_idx bigint, " + ", ".join(f"{c} {_TYPES[c]}" for c in of)
    return p.groupBy("blk", "part").cogroup(s.groupBy("blk", "part")).applyInArrow(look, schema)


def endpoint_state(bounded: DataFrame, packets: DataFrame, limit: int = LIMIT, **options) -> DataFrame:
    """(start_idx, side, ip, packets, bytes, flows, last_seen) for both endpoints of each segment; a packet to itself counts once."""
    own = bounded.select("start_idx", F.array("a_ip", "b_ip").alias("ips")).join(states(bounded, packets, limit, ("endpoints",), **options), "start_idx")
    return own.select("start_idx", "ips", F.posexplode("endpoints").alias("side", "s")).select("start_idx", "side", F.element_at("ips", F.col("side") + 1).alias("ip"), "s.*")


def service_state(bounded: DataFrame, packets: DataFrame, limit: int = LIMIT, **options) -> DataFrame:
    """The same for packets of the segment's protocol from or to its service port (each once)."""
    own = bounded.select("start_idx", C.service_bucket("protocol", C.service_port("a_port", "b_port")).alias("service_bucket"))
    return own.join(states(bounded, packets, limit, ("service",), **options), "start_idx").select("start_idx", "service_bucket", "service.*")


def edge_state(bounded: DataFrame, packets: DataFrame, limit: int = LIMIT, **options) -> DataFrame:
    """The same for packets between the segment's two addresses, in either direction."""
    return states(bounded, packets, limit, ("edge",), **options).select("start_idx", "edge.*")


def graph_top(bounded: DataFrame, packets: DataFrame, limit: int = LIMIT, k: int = TOP_EDGES, **options) -> DataFrame:
    """The k busiest edges of each segment's window, ranked from 1 by packets, bytes, last seen and flows, all descending, then by name."""
    rows = states(bounded, packets, limit, ("graph",), k, **options).select("start_idx", F.posexplode("graph").alias("rank", "s"))
    return rows.select("start_idx", "s.*", (F.col("rank") + 1).alias("rank"))


def with_context(segments: DataFrame, packets: DataFrame, duration_ns: int = DURATION_NS, limit: int = LIMIT) -> DataFrame:
    """segments with endpoints (two states), service, edge and graph (up to five states) as structs."""
    b = window_bounds(segments, packets, duration_ns, limit)
    found = written(states(b, packets, limit), "context")
    return b.drop("lo", "hi").join(found.withColumn("graph", F.transform("graph", lambda s: s.dropFields("edge"))), "start_idx")
