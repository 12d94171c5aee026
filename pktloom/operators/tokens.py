"""Fixed-shape number arrays of segments, for model training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

PACKETS, PACKET_WIDTH, FLOW_WIDTH, ENDPOINT_WIDTH, SERVICE_WIDTH, EDGE_WIDTH, GRAPH_ROWS, GRAPH_WIDTH = 20, 16, 12, 12, 10, 8, 5, 16


def _d(x: Column) -> Column:
    return x.cast("double")


def _zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def _iat(p: Column, before: Column) -> Column:
    return F.greatest(p["ts_ns"] - before["ts_ns"], F.lit(0).cast("bigint"))


def _back(p: Column) -> Column:
    return F.when(p["src_ip"] == F.col("a_ip"), 0.0).otherwise(1.0)


def packet_tokens() -> Column:
    """20 rows: protocol, length, ports, time since the packet before, direction, ten code bits; zeros beyond the segment."""
    before = F.concat(F.slice("packets", F.lit(1), F.lit(1)), F.slice("packets", F.lit(1), F.greatest(F.size("packets") - 1, F.lit(0))))

    def row(p: Column, q: Column) -> Column:
        bits = [_d(C.code_bit(p["packet_code"], b)) for b in range(10)]
        return F.array(_d(p["protocol"]) / 255, C.log1p(p["ip_len"]), _d(p["src_port"]) / 65535, _d(p["dst_port"]) / 65535, C.log1p(_iat(p, q)), _back(p), *bits)

    return F.slice(F.concat(F.zip_with("packets", before, row), F.array_repeat(_zeros(PACKET_WIDTH), PACKETS)), 1, PACKETS)


def packet_masks() -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(PACKETS - 1)), lambda k: F.when(k < F.col("n").cast("int"), 1).otherwise(0))


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)


def flow_tokens() -> Column:
    """Twelve numbers of a segment; those about neighbouring packets are 0 for a single one."""
    p, n = F.col("packets"), _d(F.col("n"))
    mean = lambda f: _total(F.transform(p, f)) / n
    bit = lambda b: mean(lambda x: _d(C.code_bit(x["packet_code"], b)))
    size = F.aggregate(p, F.lit(0).cast("bigint"), lambda a, x: a + x["ip_len"])
    duration = F.greatest(F.col("last_ts") - F.col("first_ts"), F.lit(0).cast("bigint"))
    pairs = F.zip_with(F.slice("packets", F.lit(1), F.greatest(F.size("packets") - 1, F.lit(0))), F.slice("packets", F.lit(2), F.size("packets")), lambda a, b: F.struct(_d(_iat(b, a)).alias("iat"), F.when(_back(a) != _back(b), 1.0).otherwise(0.0).alias("turn")))
    gaps, gap_total = n - 1, _total(F.transform(pairs, lambda x: x["iat"]))
    many = F.col("n") > 1
    iat_mean = gap_total / F.greatest(gaps, F.lit(1.0))
    spread = _total(F.transform(pairs, lambda x: (x["iat"] - iat_mean) * (x["iat"] - iat_mean))) / F.greatest(gaps, F.lit(1.0))
    when = lambda x: F.when(many, x).otherwise(0.0)
    return F.array(
        mean(lambda x: _d(x["protocol"])) / 255, C.log1p(size), C.log1p(F.col("n")), C.log1p(duration), _d(F.col("a_port")) / 65535, _d(F.col("b_port")) / 65535,
        bit(4), bit(5), mean(lambda x: _d(F.greatest(C.code_bit(x["packet_code"], 6), C.code_bit(x["packet_code"], 7)))),
        when(F.log(iat_mean + 1)), when(F.log(F.sqrt(spread) / (iat_mean + 1) + 1)), when(_total(F.transform(pairs, lambda x: x["turn"])) / F.greatest(gaps, F.lit(1.0))),
    )


def _age(last_seen: Column) -> Column:
    """Time since an entity was last seen; 0 if that was at time 0 or before, or never."""
    return F.when(last_seen > 0, C.log1p(F.greatest(F.col("last_ts") - last_seen, F.lit(0).cast("bigint")))).otherwise(0.0)


def _six(s: Column) -> list[Column]:
    p, b, f = _d(s["packets"]), _d(s["bytes"]), _d(s["flows"])
    return [C.log1p(p), C.log1p(b), C.log1p(f), _age(s["last_seen"]), F.log(C.safe_ratio(b, p) + 1), F.log(C.safe_ratio(p, f) + 1)]


def endpoint_tokens() -> Column:
    return F.transform("endpoints", lambda s: F.concat(F.array(*_six(s)), _zeros(ENDPOINT_WIDTH - 6)))


def service_tokens() -> Column:
    s, port = F.col("service"), C.service_port("a_port", "b_port")
    return F.array(*_six(s), C.safe_ratio(_d(s["flows"]), _d(s["packets"])), C.port_group(port), C.protocol_group(F.col("protocol")), F.lit(0.0))


def edge_tokens() -> Column:
    s = F.col("edge")
    back = F.exists("packets", lambda p: p["src_ip"] != F.col("a_ip"))
    return F.array(*_six(s), C.safe_ratio(_d(F.col("n")), _d(s["packets"])), F.when(back, 1.0).otherwise(0.0))


def graph_tokens() -> Column:
    """Five rows of the busiest edges, zeros where there are fewer."""
    row = lambda s: F.concat(F.array(C.log1p(s["packets"]), C.log1p(s["bytes"]), C.log1p(s["flows"]), _age(s["last_seen"])), _zeros(GRAPH_WIDTH - 4))
    rows = F.transform(F.coalesce("graph", F.array().cast("array<struct<packets:bigint,bytes:bigint,flows:bigint,last_seen:bigint>>")), row)
    return F.slice(F.concat(rows, F.array_repeat(_zeros(GRAPH_WIDTH), GRAPH_ROWS)), 1, GRAPH_ROWS)


def encode(contexted: DataFrame, source_id: int | None = None, source_name: str | None = None) -> DataFrame:
    """The training row of each segment with context: arrays of 32-bit floats and scalars, with emit_seq.

    With source_id rows carry it, else they carry their segment_id; source_name salts the flow hash.
    """
    one, two = "array<float>", "array<array<float>>"
    total = F.aggregate("packets", F.lit(0).cast("bigint"), lambda a, x: a + x["ip_len"])
    port = C.service_port("a_port", "b_port")
    label = F.col("label") if "label" in contexted.columns else F.lit(0)
    own = F.lit(source_id).cast("smallint").alias("source_id") if source_id is not None else F.col("segment_id").cast("int").alias("segment_id")
    return contexted.select(
        "emit_seq", packet_tokens().cast(two).alias("packet_tokens"), flow_tokens().cast(one).alias("flow_tokens"), endpoint_tokens().cast(two).alias("endpoint_tokens"),
        service_tokens().cast(one).alias("service_tokens"), edge_tokens().cast(one).alias("edge_tokens"), graph_tokens().cast(two).alias("graph_tokens"),
        packet_masks().cast("array<smallint>").alias("packet_masks"), label.cast("int").alias("labels"), F.col("any_label").cast("int").alias("segment_labels"),
        C.flow_hash(["a_ip", "b_ip", "a_port", "b_port", "protocol"], source_name).alias("flow_key_hashes"), F.col("last_ts").alias("cutoff_timestamp_ns"),
        F.col("n").cast("smallint").alias("prefix_lens"), F.col("protocol").cast("smallint").alias("protocols"), port.cast("int").alias("dst_ports"),
        C.length_bucket(total).cast("smallint").alias("length_buckets"), C.service_bucket("protocol", port).alias("service_buckets"), own,
    )
