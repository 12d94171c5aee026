"""Flow sessions and segments over a stream of packets, one state for each flow."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import columns as C
from ..operators.flows import GAP_NS
from ..schema import CANONICAL, KEY

#: Event time for which a flow's number is kept after its last session or segment.
RETENTION_NS = 86_400_000_000_000

_SESSION = "src_ip string, dst_ip string, src_port int, dst_port int, protocol int, session bigint, start_ts bigint, end_ts bigint, n bigint, bytes bigint, label boolean"
_SEGMENT = "a_ip string, a_port int, b_ip string, b_port int, protocol int, segment_id bigint, start_idx bigint, n bigint, first_ts bigint, last_ts bigint, any_label boolean, reason string"


def _event_time(packets: DataFrame, delay: str) -> DataFrame:
    """packets with event_time from ts_ns, under a watermark."""
    return packets.withColumn("event_time", F.timestamp_micros(F.floor(F.col("ts_ns") / 1000).cast("bigint"))).withWatermark("event_time", delay)


def stream_sessions(packets: DataFrame, gap_ns: int = GAP_NS, delay: str = "10 seconds", retention_ns: int = RETENTION_NS) -> DataFrame:
    """A row for each directed session when it is over: a packet of its flow comes after the gap, or the watermark passes it.

    Packets of a batch are taken in the order of idx. A flow's state is six numbers, whatever its size. It is kept for retention_ns after its
    last session, so that a session that comes within it has the next number, and then removed: numbers start anew, and flows that are
    over hold no state.
    """

    def update(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out = []
        held = list(state.get) if state.exists else [0, 0, 0, 0, 0, False]

        def close() -> None:
            out.append((*key, *held))
            held[:] = [held[0] + 1, 0, held[2], 0, 0, False]

        if state.hasTimedOut and not held[3]:
            state.remove()
        else:
            if state.hasTimedOut:
                close()
            else:
                rows = pd.concat(list(chunks)).sort_values("idx")
                for ts, size, label in zip(rows["ts_ns"].tolist(), rows["ip_len"].tolist(), rows["label"].tolist()):
                    if held[3] and ts - held[2] > gap_ns:
                        close()
                    if not held[3]:
                        held[1] = ts
                    held[2], held[3], held[4], held[5] = ts, held[3] + 1, held[4] + size, held[5] or bool(label)
            state.update(tuple(held))
            wait = gap_ns if held[3] else gap_ns + retention_ns
            state.setTimeoutTimestamp(max((held[2] + wait) // 1_000_000 + 1, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=[f.split()[0] for f in _SESSION.split(", ")])

    return _event_time(packets, delay).groupBy(*KEY).applyInPandasWithState(
        update, _SESSION, "session bigint, start_ts bigint, end_ts bigint, n bigint, bytes bigint, label boolean", "append", GroupStateTimeout.EventTimeTimeout
    )


def stream_segments(packets: DataFrame, cutoff: int = 20, timeout_ns: int = 60_000_000_000, delay: str = "10 seconds", retention_ns: int = RETENTION_NS) -> DataFrame:
    """A row for each segment of an undirected flow when it closes: at its cutoff, or at its greatest age.

    The age is looked at with each packet of the flow and with the watermark, which stand for the periodic checks of the batch form. A flow
    without an open segment keeps its number for retention_ns, and then its state is removed.
    """
    keyed = packets.select("idx", "ts_ns", "label", *C.canonical_key())

    def update(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        out = []
        held = list(state.get) if state.exists else [0, -1, 0, 0, 0, False]

        def keep() -> None:
            state.update(tuple(held))
            due = held[3] + timeout_ns if held[2] else held[4] + timeout_ns + retention_ns
            state.setTimeoutTimestamp(max(due // 1_000_000 + 1, state.getCurrentWatermarkMs() + 1))

        def close(reason: str) -> None:
            out.append((*key, *held, reason))
            held[:] = [held[0] + 1, -1, 0, 0, held[4], False]

        if state.hasTimedOut and not held[2]:
            state.remove()
        elif state.hasTimedOut:
            close("timeout")
            keep()
        else:
            rows = pd.concat(list(chunks)).sort_values("idx")
            for idx, ts, label in zip(rows["idx"].tolist(), rows["ts_ns"].tolist(), rows["label"].tolist()):
                if held[2] and ts - held[3] >= timeout_ns:
                    close("timeout")
                if not held[2]:
                    held[1], held[3] = idx, ts
                held[2], held[4], held[5] = held[2] + 1, ts, held[5] or bool(label)
                if held[2] >= cutoff:
                    close("cutoff")
            keep()
        yield pd.DataFrame(out, columns=[f.split()[0] for f in _SEGMENT.split(", ")])

    return _event_time(keyed, delay).groupBy(*CANONICAL).applyInPandasWithState(
        update, _SEGMENT, "segment_id bigint, start_idx bigint, n bigint, first_ts bigint, last_ts bigint, any_label boolean", "append", GroupStateTimeout.EventTimeTimeout
    )
