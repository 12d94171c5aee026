"""The four jobs: labelled datasets from captures, statistics, and training caches."""

from __future__ import annotations

import json
import logging
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import context, decode, flows, merge, rules, segments, stats, tokens
from ..operators.ordering import row_numbers
from ..schema import CANONICAL
from ..sources import capture, sinks, text
from ..sources.config import Config, load_config, load_stats_config
from ..storage import dropped, written

log = logging.getLogger(__name__)

#: Environment variables that switch merging to a budget of packets.
BUDGET_TOTAL, BUDGET_RATIO, BUDGET_BINS, BUDGET_BIDIRECTIONAL = "PCAP_MERGE_TOTAL_PKTS", "PCAP_MERGE_ATTACK_RATIO", "PCAP_MERGE_TIME_BINS", "PCAP_MERGE_BIDIR_FLOW"


def read_frames(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    return capture.frames(capture.read_captures(spark, files))


def compacted(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of a folder as Ethernet frames on one timeline."""
    return merge.compact(decode.wrap_ethernet(read_frames(spark, capture.directory(folder))))


def stream(frames: DataFrame) -> DataFrame:
    """Frames as a stream to merge: in order (idx), with the key that sampling goes by."""
    keyed = decode.lax_flow_key(frames)
    return written(capture.ordered(keyed).drop("file_ord", "frame_no"), "stream")


def merged(attack: DataFrame, benign: DataFrame, rate: float, environment: dict | None = None, seed: int = 0) -> DataFrame:
    """Both streams in order; the environment's budget, if it names a total and a ratio, takes the place of sampling."""
    env = os.environ if environment is None else environment
    if BUDGET_TOTAL in env and BUDGET_RATIO in env:
        bidirectional = env.get(BUDGET_BIDIRECTIONAL, "false").lower() in ("1", "true")
        return merge.merge_by_budget(attack, benign, int(env[BUDGET_TOTAL]), float(env[BUDGET_RATIO]), int(env.get(BUDGET_BINS, merge.TIME_BINS)), bidirectional, seed)
    return merge.merge_ordered(attack, benign, rate, seed)


def dataset_rows(rows: DataFrame) -> DataFrame:
    """The packets of a merge that decode, numbered again, with label."""
    plain = rows.select(F.lit(0).alias("file_ord"), F.col("seq").alias("frame_no"), "ts_ns", "linktype", F.length("data").alias("caplen"), "data", F.col("is_attack").alias("label"))
    decoded = decode.decode_frames(plain)
    return row_numbers(decoded, ["frame_no"], F.floor(F.col("frame_no") / 65536).cast("bigint"), "idx").drop("file_ord", "frame_no", "linktype", "caplen", "data")


def scenario(attack: DataFrame, benign: DataFrame, prefix: str, rate: float, mixed: bool, environment: dict | None = None) -> dict:
    """One dataset: prefix.data, prefix.label, prefix.csv and, if wanted, captures under prefix_mixed; returns packet and row counts."""
    rows = written(merged(attack, benign, rate, environment), "merged")
    total = rows.count()
    if mixed and total:
        capture.write_capture(decode.wrap_ethernet(rows), f"{prefix}_mixed", "seq")
    data = written(dataset_rows(rows), "dataset")
    text.write_data(data, prefix)
    sinks.write_flow_csv(flows.flow_features(flows.sessionize(data, batch=flows.BATCH_LINES)), f"{prefix}.csv")
    found = {"packets": total, "rows": data.count()}
    dropped(rows)
    dropped(data)
    return found


def benign_source(spark: SparkSession, config: Config) -> DataFrame:
    """The shared capture, or captures of a glob pattern, which must exist, else the compacted folder."""
    if config.shared_neg_pcap:
        return read_frames(spark, capture.pattern(config.shared_neg_pcap))
    if not config.neg_glob:
        raise ValueError("folder mode needs neg_glob or shared_neg_pcap")
    return compacted(spark, config.neg_glob)


def pretrain_source(spark: SparkSession, config: Config) -> DataFrame | None:
    if config.shared_pretrain_neg_pcap:
        return read_frames(spark, capture.pattern(config.shared_pretrain_neg_pcap))
    return compacted(spark, config.pretrain_neg_glob) if config.pretrain_neg_glob else None


def positives(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Scenarios of a folder: each capture, and each sub-folder as one; or a single capture. Named by file stem."""
    if os.path.isfile(path):
        return {os.path.splitext(os.path.basename(path))[0]: read_frames(spark, [path])}
    found = {os.path.splitext(os.path.basename(p))[0]: read_frames(spark, [p]) for p in capture.directory(path)}
    for name in sorted(os.listdir(path), key=capture.natural):
        if os.path.isdir(os.path.join(path, name)) and capture.directory(os.path.join(path, name)):
            found[name] = compacted(spark, os.path.join(path, name))
    return found


def process(spark: SparkSession, config_path: str, environment: dict | None = None) -> dict[str, dict]:
    """Datasets of a configuration; a scenario that fails is logged and does not stop the others."""
    config = load_config(config_path)
    os.makedirs(config.output_dir, exist_ok=True)
    out: dict[str, dict] = {}
    before = pretrain_source(spark, config)
    if before is not None:
        plain = dataset_rows(capture.ordered(before, "seq").withColumn("is_attack", F.lit(False)))
        text.write_data(plain, os.path.join(config.output_dir, "pretrain_benign"), labels=False)
    scenarios: dict[str, DataFrame] = {}
    if config.mode == "rules":
        if not config.raw_pcap or not os.path.exists(config.raw_pcap):
            raise FileNotFoundError(f"raw_pcap: {config.raw_pcap}")
        files = capture.directory(config.raw_pcap) if os.path.isdir(config.raw_pcap) else [config.raw_pcap]
        table = rules.load_rules(spark, [r for a in config.attacks for r in a.rules])
        labelled = rules.label_first_match(decode.decode_frames(read_frames(spark, files)), table)
        path = os.path.join(config.output_dir, "classes")
        rules.split_by_class(labelled.select("file_ord", "frame_no", "ts_ns", "linktype", "caplen", "data", "attack_type"), path)
        classes = spark.read.parquet(path)
        known = {r.attack_type for r in classes.select("attack_type").distinct().collect()}
        of = lambda kind: classes.where(F.col("attack_type") == kind).drop("attack_type")
        benign = of(rules.BENIGN)
        for a in config.attacks:
            if a.rules and a.rules[0]["attack_type"] in known:
                scenarios[a.name] = of(a.rules[0]["attack_type"])
            else:
                log.warning("scenario %s has no rules or no packets", a.name)
    elif config.mode == "folder":
        if not config.pos_glob:
            raise ValueError("folder mode needs pos_glob")
        benign, scenarios = benign_source(spark, config), positives(spark, config.pos_glob)
    else:
        log.warning("unknown mode %s", config.mode)
        return out
    benign = stream(benign)
    for name, attack in scenarios.items():
        try:
            out[name] = scenario(stream(attack), benign, os.path.join(config.output_dir, name), config.neg_sampling_rate, config.write_mixed_pcap, environment)
        except Exception:  # one scenario's failure is its own
            log.exception("scenario %s failed", name)
    return out


def dataset_statistics(spark: SparkSession, config_path: str, output: str) -> list[dict]:
    """Statistics of each dataset, written as one JSON array."""
    out = []
    for d in load_stats_config(config_path):
        captured = written(capture.read_captures(spark, [f for s in d.sources for f in capture.dispatch(s)]), "captured")
        total, unreadable = captured.agg(F.count("data"), F.count("error")).first()
        table = rules.load_rules(spark, rules.rules_file(d.rules) if d.rules else [], strict=False, offset_hours=d.timezone_offset)
        packets = rules.label_exists(decode.decode_frames(capture.frames(captured)), table)
        row = stats.dataset_stats(packets, d.name).first().asDict(recursive=True)
        decoded = row["benign_packets"] + row["attack_packets"]
        row["skipped"] = total - decoded + unreadable
        out.append({k: [[x["key"], x["count"]] for x in v] if isinstance(v, list) else v for k, v in row.items()})
        dropped(captured)
    with open(output, "w") as f:
        json.dump(out, f, indent=2)
    return out


def _cache(spark: SparkSession, packets: DataFrame, segs: DataFrame, out_dir: str, window_s: int, limit: int, shard_flows: int, digits: int, **encoding) -> list[dict]:
    sinks.emptied(out_dir)
    segs = written(segs, "segments")
    contexted = context.with_context(segs, packets, window_s * 1_000_000_000, limit)
    label = segs.select("start_idx", "label") if "label" in segs.columns else None
    contexted = contexted if label is None or "label" in contexted.columns else contexted.join(label, "start_idx")
    return sinks.write_shards(tokens.encode(contexted, **encoding), out_dir, shard_flows, digits)


def _schema(mode: str, cutoff: int, timeout_s: int, window_s: int, limit: int, dims: dict) -> dict:
    return {
        "version": "flow_v2.0", "context_mode": mode, "packet_cutoff": cutoff, "graph_token_count": 5, "flow_timeout_s": timeout_s, "window_duration_s": window_s,
        "window_packet_limit": limit, "timestamp_unit": "ns", "timeout_policy": "segment_max_age", "time_feature_transform": "log1p_delta_ns",
        "packet_code_encoding": "packet_bits_v1", "derived_feature_set": "flow_v2_derived.2", "dims": dims,
    }


def _totals(shards: list[dict], counts: str = "label_counts") -> dict[str, int]:
    out: dict[str, int] = {}
    for s in shards:
        for k, n in s[counts].items():
            out[k] = out.get(k, 0) + n
    return out


def pretrain_cache(spark: SparkSession, data: str, out_dir: str, source_name: str = "", source_id: int = 0, packet_cutoff: int = 20, flow_timeout_s: int = 60, window_duration_s: int = 300, window_packet_limit: int = 2000, shard_flows: int = 50000, max_packets: int = 0, max_flows: int = 0, timeout_check_interval: int = 256, graph_token_count: int = 5, timestamp_unit: str = "ns", field7_mode: str = "protocol") -> dict:
    """Token shards of benign traffic and their metadata."""
    segments.validate(packet_cutoff, flow_timeout_s * 1_000_000_000, timeout_check_interval, graph_token_count)
    packets = written(text.read_data(spark, data, None, "pretrain", timestamp_unit, field7_mode), "packets")
    segs = segments.segments(packets, "pretrain", packet_cutoff, flow_timeout_s * 1_000_000_000, timeout_check_interval, max_packets=max_packets, max_flows=max_flows)
    shards = _cache(spark, packets, segs, out_dir, window_duration_s, window_packet_limit, shard_flows, 6, source_id=source_id)
    total = packets.count() if not max_packets else min(max_packets, packets.count())
    if max_flows and (last := segs.orderBy(F.desc("emit_seq")).select("reason", "emit_idx").first()):
        stopped = sum(_totals(shards).values()) == max_flows
        total = (last.emit_idx if last.reason == "cutoff" else last.emit_idx + 1) if stopped and last.reason != "end" else total
    name = source_name or os.path.splitext(os.path.basename(data.rstrip("/")))[0]
    n = sum(_totals(shards).values())
    dims = {"packet_token": 16, "flow_token": 12, "endpoint_token": 12, "service_token": 10, "edge_token": 8, "graph_token": 16}
    metadata = {
        "cache_schema_version": "flow_v2_cache.2", "data_path": data, "source_names": [name], "source_name_to_id": {name: source_id}, "source_flow_counts": _totals(shards, "source_counts"),
        "source_mode": "normal_only_data_file", "pretrain_data": data, "total_packets": total, "normal_packets": total, "attack_packets": 0, "event_count": n, "label_counts": _totals(shards),
        "shards": shards, "schema": _schema("oracle_normal_context", packet_cutoff, flow_timeout_s, window_duration_s, window_packet_limit, dims), "total_flows": n, "packet_cutoff": packet_cutoff,
        "graph_token_count": 5, "dims": dims, "normal_only": True, "max_events": max_flows or None, "timestamp_unit": "ns", "raw_timestamp_unit": timestamp_unit, "raw_field7_mode": field7_mode,
        "timeout_policy": "segment_max_age", "time_feature_transform": "log1p_delta_ns", "packet_code_encoding": "packet_bits_v1", "derived_feature_set": "flow_v2_derived.2",
        "label_policy": "segment_max", "segment_label_policy": "segment_max", "sampling_unit": "detection_event_segment", "cache_builder": "pktloom_pretrain_cache",
        "metadata_fields": ["flow_key_hashes", "cutoff_timestamp_ns", "segment_labels", "prefix_lens", "protocols", "dst_ports", "length_buckets", "service_buckets", "source_ids"],
    }
    dropped(packets)
    sinks.write_metadata(out_dir, metadata)
    return metadata


def finetune_cache(spark: SparkSession, data: str, labels: str, out_dir: str, source_name: str, packet_cutoff: int = 20, flow_timeout_s: int = 60, window_duration_s: int = 300, window_packet_limit: int = 100000, shard_flows: int = 4096, max_packets: int = 0, timeout_check_interval: int = 256, graph_token_count: int = 5, timestamp_unit: str = "ns", field7_mode: str = "protocol", attack_centered: bool = False, label_policy: str = "flow_contaminated", normal_flow_sample_size: int = 20000, seed: int = 42) -> dict:
    """Labelled token shards and their metadata; the cutoff must be 20."""
    if packet_cutoff != 20:
        raise ValueError("packet_cutoff must be 20")
    if label_policy not in ("segment_only", "flow_contaminated"):
        raise ValueError("label_policy must be segment_only or flow_contaminated")
    segments.validate(packet_cutoff, flow_timeout_s * 1_000_000_000, timeout_check_interval, graph_token_count)
    packets = text.read_data(spark, data, labels, "finetune", timestamp_unit, field7_mode)
    packets = written(packets.where(F.col("idx") < max_packets) if max_packets else packets, "packets")
    attacked = written(segments.attack_keys(packets), "attacked")
    sample = written(segments.normal_sample(packets, normal_flow_sample_size, seed).select(*CANONICAL), "sample") if attack_centered else None
    keys = attacked if sample is None else written(attacked.unionByName(sample).distinct(), "keys")
    segs = segments.segments(packets, "finetune", packet_cutoff, flow_timeout_s * 1_000_000_000, timeout_check_interval, keys=keys if attack_centered else None)
    segs = segments.label_segments(segs, label_policy, attacked)
    shards = _cache(spark, packets, segs, out_dir, window_duration_s, window_packet_limit, shard_flows, 5, source_name=source_name)
    total, attack = packets.agg(F.count("*"), F.count_if("label")).first()
    n = sum(_totals(shards).values())
    dims = {"packet_tokens": 16, "flow_token": 12, "endpoint_token": 12, "service_token": 10, "edge_token": 8, "graph_token": 16}
    metadata = {
        "cache_schema_version": "flow_v2_cache.2", "data_path": data, "label_path": labels, "source_names": [source_name], "source_mode": "data_label_pairs", "pretrain_data": None, "total_packets": total,
        "normal_packets": total - attack, "attack_packets": attack, "event_count": n, "label_counts": _totals(shards), "shards": shards,
        "schema": _schema("mixed_causal_context", packet_cutoff, flow_timeout_s, window_duration_s, window_packet_limit, dims), "total_flows": n, "packet_cutoff": packet_cutoff, "graph_token_count": 5,
        "dims": dims, "normal_only": False, "max_events": None, "attack_flow_keys": attacked.count(), "sampled_normal_flow_keys": 0 if sample is None else sample.count(),
        "selected_flow_keys": keys.count(), "attack_centered": attack_centered, "normal_flow_sample_size": normal_flow_sample_size, "seed": seed, "timestamp_unit": "ns", "raw_timestamp_unit": timestamp_unit,
        "raw_field7_mode": field7_mode, "timeout_policy": "segment_max_age", "time_feature_transform": "log1p_delta_ns", "packet_code_encoding": "packet_bits_v1",
        "derived_feature_set": "flow_v2_derived.2", "label_policy": label_policy, "segment_label_policy": "segment_max", "sampling_unit": "detection_event_segment", "cache_builder": "pktloom_finetune_cache",
        "metadata_fields": ["flow_key_hashes", "segment_ids", "cutoff_timestamp_ns", "segment_labels", "prefix_lens", "protocols", "dst_ports", "length_buckets", "service_buckets"],
    }
    dropped(packets)
    sinks.write_metadata(out_dir, metadata)
    return metadata
