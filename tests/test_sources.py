import io
import json
import struct
import zipfile

import numpy as np
import pytest

from pktloom import cli
from pktloom.plans import jobs
from pktloom.sources import capture, config, sinks, text

from .test_decode import G3

S = 1_000_000_000


def pcap(rows, order="<", nano=False, link=1):
    out = struct.pack(order + "IHHiIII", capture.MAGIC_NS if nano else capture.MAGIC_US, 2, 4, 0, 0, 65535, link)
    for ts, data in rows:
        out += struct.pack(order + "IIII", ts // S, ts % S // (1 if nano else 1000), len(data), len(data)) + data
    return out


def pcapng(rows, order="<"):
    block = lambda kind, body: struct.pack(order + "II", kind, len(body) + 12) + body + struct.pack(order + "I", len(body) + 12)
    out = block(0x0A0D0D0A, struct.pack(order + "IHHq", 0x1A2B3C4D, 1, 0, -1)) + block(1, struct.pack(order + "HHI", 1, 0, 0) + struct.pack(order + "HHB3xHH", 9, 1, 9, 0, 0))
    for ts, data in rows:
        out += block(6, struct.pack(order + "IIIII", 0, ts >> 32, ts & 0xFFFFFFFF, len(data), len(data)) + data + bytes(-len(data) % 4))
    return out


def tcp(src, dst, sport, dport, n=40):
    ip = bytes.fromhex("4500") + struct.pack(">H", n) + bytes.fromhex("0000400040060000") + bytes([10, 0, 0, src, 10, 0, 0, dst])
    return G3[:14] + ip + struct.pack(">HHIIBBHHH", sport, dport, 0, 0, 0x50, 0x10, 0, 0, 0)


@pytest.mark.parametrize("order", "<>")
def test_formats(order):
    rows = [(1_000_007_000, b"abc"), (2 * S + 123_456_000, b""), (3 * S, b"x" * 70)]
    for data in (pcap(rows, order), pcap(rows, order, nano=True), pcapng(rows, order)):
        assert list(capture.frames_of(io.BytesIO(data))) == [(t, 1, d) for t, d in rows]
        assert list(capture.frames_of(io.BytesIO(data[:-9])))[:2] == [(t, 1, d) for t, d in rows[:2]]
        if data[:4] == b"\n\r\r\n":  # a file may have several sections
            assert list(capture.frames_of(io.BytesIO(data + pcapng(rows, ">")))) == [(t, 1, d) for t, d in rows * 2]
    assert next(capture.frames_of(io.BytesIO(pcap(rows, order, link=101))))[1] == 12
    for bad in (b"", b"x" * 50):
        with pytest.raises(ValueError):
            list(capture.frames_of(io.BytesIO(bad)))


def test_listing(tmp_path):
    for n in ("a10.pcap", "a9.pcap", "b.PCAP", "c.pcapng", "d.zip", "e.txt"):
        (tmp_path / n).write_bytes(b"")
    (tmp_path / "sub").mkdir()
    names = lambda x: [p.rsplit("/", 1)[1] for p in x]
    assert names(capture.directory(str(tmp_path))) == ["a9.pcap", "a10.pcap"]
    assert names(capture.pattern(f"{tmp_path}/a*.pcap")) == ["a10.pcap", "a9.pcap"]
    assert names(capture.dispatch(str(tmp_path))) == ["a9.pcap", "a10.pcap", "b.PCAP", "c.pcapng", "d.zip"]
    with pytest.raises(FileNotFoundError):
        capture.pattern(f"{tmp_path}/none*")


def test_reading(spark, tmp_path):
    (tmp_path / "1.pcap").write_bytes(pcap([(S, G3), (2 * S, G3)]))
    (tmp_path / "2.pcap").write_bytes(b"junk, and more of it than a header has")
    with zipfile.ZipFile(tmp_path / "3.zip", "w") as z:
        z.writestr("x.pcap", pcap([(5 * S, G3)]))
        z.writestr("y.txt", "no")
    got = capture.read_captures(spark, capture.dispatch(str(tmp_path))).collect()
    assert sorted((r.file_ord, r.frame_no, r.ts_ns, r.error is None) for r in got if r.ts_ns) == [(0, 0, S, True), (0, 1, 2 * S, True), (2, 0, 5 * S, True)]
    assert [r.file_ord for r in got if r.error] == [1]
    assert capture.read_captures(spark, []).count() == 0


def test_writing_captures(spark, tmp_path):
    rows = [(i, i * 1_500_000, bytearray(tcp(1, 2, i, 80))) for i in range(40)]
    df = spark.createDataFrame(rows, "seq bigint, ts_ns bigint, data binary")
    files = capture.write_capture(df, str(tmp_path / "m"), "seq").orderBy("part").collect()
    back = capture.ordered(capture.read_captures(spark, [f.file for f in files])).orderBy("idx").collect()
    assert [(r.ts_ns, bytes(r.data)) for r in back] == [(t, bytes(d)) for _, t, d in rows] and sum(f.packets for f in files) == 40


def test_text(spark, tmp_path):
    (tmp_path / "x.data").write_text("4 10.0.0.1 10.0.0.2 1 80 5 6 18 60\n\n4 10.0.0.1 bad 1 80 5 6 18 60\n  6\t::1  ::2 7 53 -9 17 256 70  \n4 1.1.1.1 2.2.2.2 1 2 3 6 4 5\n")
    (tmp_path / "x.label").write_text("1 0\n01x")
    p = text.read_data(spark, f"{tmp_path}/x.data", f"{tmp_path}/x.label").orderBy("idx").collect()
    assert [(r.idx, r.src_ip, r.ts_ns, r.protocol, r.label) for r in p] == [(0, "10.0.0.1", 5, 6, True), (1, "::1", -9, 17, True)]
    df = text.read_data(spark, f"{tmp_path}/x.data")
    assert df.count() == 3
    text.write_data(df, f"{tmp_path}/out")
    lines = "".join(f.read_text() for f in sorted((tmp_path / "out.data").glob("part-*")))
    assert lines.splitlines()[0] == "4 10.0.0.1 10.0.0.2 1 80 0 6 18 60" and lines.splitlines()[1].split()[5] == "-14"
    assert "".join(f.read_text() for f in sorted((tmp_path / "out.label").glob("part-*"))).split() == ["0", "0", "0"]


def test_labels_in_ranges(spark, tmp_path):
    said = "".join("10x\n"[i * 7 % 4] for i in range(1000))
    (tmp_path / "l").write_text(said)
    got = [(r.line_no, r.label) for r in text.read_labels(spark, f"{tmp_path}/l", chunk_bytes=37).orderBy("line_no").collect()]
    assert got == list(enumerate(c == "1" for c in said if c in "01"))


def test_parts_in_name_order(spark, tmp_path):
    """Uneven parts, the largest of them in the middle, read by many small ranges."""
    line = lambda k: f"4 10.0.0.1 10.0.0.2 {1 + k} 80 {k} 6 18 60"
    sizes, at = [2, 5, 0, 900, 1, 40], 0
    for kind in ("d", "l"):
        (tmp_path / kind).mkdir()
        (tmp_path / kind / "_SUCCESS").write_text("1")
        (tmp_path / kind / ".part-00000.crc").write_text("1")
    for k, n in enumerate(sizes):
        (tmp_path / f"d/part-{k:05}").write_text("".join(line(i) + "\n" for i in range(at, at + n)))
        (tmp_path / f"l/part-{k:05}").write_text("".join(f"{i % 3 // 2}\n" for i in range(at, at + n)))
        at += n
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        got = text.read_data(spark, f"{tmp_path}/d", f"{tmp_path}/l").orderBy("idx").collect()
        assert [(r.idx, r.src_port, r.label) for r in got] == [(i, 1 + i, i % 3 == 2) for i in range(at)]
        assert [r.line_no for r in text.read_labels(spark, f"{tmp_path}/l", 7).orderBy("line_no").collect()] == list(range(at))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_process_feeds_both_caches(spark, tmp_path):
    attack, benign = attack_and_benign()
    (tmp_path / "raw.pcap").write_bytes(pcap(sorted(attack + benign, key=lambda r: r[0])))
    (tmp_path / "neg").mkdir()
    (tmp_path / "neg/1.pcap").write_bytes(pcap(benign))
    rule = {"attackers": ["10.0.0.1"], "start_time": "1970-01-01 00:01:00", "end_time": "1970-01-01 01:00", "attack_type": "scan"}
    g = {"mode": "rules", "output_dir": f"{tmp_path}/out", "raw_pcap": f"{tmp_path}/raw.pcap", "pretrain_neg_glob": f"{tmp_path}/neg", "neg_sampling_rate": 1.0, "write_mixed_pcap": False}
    (tmp_path / "c.json").write_text(json.dumps({"global": g, "attacks": [{"name": "one", "rules": [rule]}]}))
    rows = jobs.process(spark, str(tmp_path / "c.json"))["one"]["rows"]
    back = text.read_data(spark, f"{tmp_path}/out/one.data", f"{tmp_path}/out/one.label", "finetune").orderBy("idx").collect()
    assert len(back) == rows and back[0].ts_ns == 0 and sum(r.label for r in back) == 10
    assert all(r.label == (r.src_ip == "10.0.0.1") for r in back) and [r.ts_ns for r in back] == sorted(r.ts_ns for r in back)
    m = jobs.finetune_cache(spark, f"{tmp_path}/out/one.data", f"{tmp_path}/out/one.label", f"{tmp_path}/fine", "one")
    assert (m["total_packets"], m["attack_packets"], m["attack_flow_keys"]) == (rows, 10, 1)
    m = jobs.pretrain_cache(spark, f"{tmp_path}/out/pretrain_benign.data", f"{tmp_path}/pre")
    assert m["total_packets"] == 40 and m["source_names"] == ["pretrain_benign"] and m["total_flows"] == 3


def test_config(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(json.dumps({"global": {"mode": "folder", "output_dir": "o", "neg_sampling_rate": 1}, "attacks": []}))
    c = config.load_config(str(path))
    assert c.shared_neg_pcap is None and c.write_mixed_pcap is True
    path.write_text(json.dumps({"global": {"mode": "folder"}, "attacks": []}))
    with pytest.raises(ValueError):
        config.load_config(str(path))


def test_golden_cache(spark, tmp_path):
    (tmp_path / "family.data").write_text("4 10.0.0.1 10.0.0.2 12345 443 0 6 60\n4 10.0.0.1 10.0.0.2 12345 443 1 6 60\n")
    m = jobs.pretrain_cache(spark, f"{tmp_path}/family.data", f"{tmp_path}/out", "family_a", 7, packet_cutoff=1, timestamp_unit="us")
    z = dict(sinks.read_shard(f"{tmp_path}/out/shard_000000.npz"))
    assert m["total_flows"] == 2 and m["cache_schema_version"] == "flow_v2_cache.2" and m["label_policy"] == "segment_max" and m["raw_timestamp_unit"] == "us"
    assert m["source_names"] == ["family_a"] and m["source_name_to_id"] == {"family_a": 7} and m["source_flow_counts"] == {"7": 2} and m["event_count"] == 2
    assert m["label_counts"] == {"0": 2} and m["raw_field7_mode"] == "protocol" and m["pretrain_data"] == m["data_path"] == f"{tmp_path}/family.data" and m["max_events"] is None
    assert m["shards"] == [{"name": "shard_000000.npz", "label_counts": {"0": 2}, "source_counts": {"7": 2}}] and (tmp_path / "out" / m["shards"][0]["name"]).exists()
    dims = {"packet_token": 16, "flow_token": 12, "endpoint_token": 12, "service_token": 10, "edge_token": 8, "graph_token": 16}
    same = {"packet_cutoff": 1, "graph_token_count": 5, "timestamp_unit": "ns", "timeout_policy": "segment_max_age", "time_feature_transform": "log1p_delta_ns", "derived_feature_set": "flow_v2_derived.2", "dims": dims}
    assert same.items() <= m.items() and same.items() <= m["schema"].items()
    own = {"version": "flow_v2.0", "context_mode": "oracle_normal_context", "flow_timeout_s": 60, "window_duration_s": 300, "window_packet_limit": 2000}
    assert own.items() <= m["schema"].items() and set(m["schema"]) == {*same, *own, "packet_code_encoding"}
    assert (m["source_mode"], m["normal_only"], m["total_packets"], m["normal_packets"], m["attack_packets"]) == ("normal_only_data_file", True, 2, 2, 0)
    assert m["segment_label_policy"] == "segment_max" and m["sampling_unit"] == "detection_event_segment" and m["metadata_fields"][-1] == "source_ids"
    assert z["labels"].tolist() == [0, 0] and z["source_ids"].tolist() == [7, 7] and z["cutoff_timestamp_ns"].tolist() == [0, 1000]
    assert z["packet_tokens"].shape == (2, 20, 16) and z["endpoint_tokens"].shape == (2, 2, 12) and z["graph_tokens"].shape == (2, 5, 16) and z["packet_tokens"].dtype == np.float32
    assert z["dst_ports"].tolist() == [443, 443] and z["service_buckets"].tolist() == [393659] * 2 and z["length_buckets"].tolist() == [5, 5]
    assert z["packet_tokens"][0, 0, 6:16].tolist() == [1, 0, 0, 0, 0, 1, 0, 0, 0, 0] and z["endpoint_tokens"][0, 0, 3] == 0
    assert np.allclose(z["edge_tokens"][1, :2], np.log([3, 121]), rtol=1e-5) and json.loads((tmp_path / "out/meta.json").read_text()) == json.loads((tmp_path / "out/metadata.json").read_text())
    with pytest.raises(ValueError):
        jobs.pretrain_cache(spark, f"{tmp_path}/family.data", f"{tmp_path}/out", timestamp_unit="ms")


def test_finetune_cache(spark, tmp_path):
    lines = [f"4 10.0.0.{1 + i % 3} 10.0.0.9 {1000 + i % 3} 80 {i * S} 6 32 {60 + i}" for i in range(90)]
    (tmp_path / "d.data").write_text("\n".join(lines) + "\n")
    (tmp_path / "d.label").write_text("".join("1" if i == 60 else "0" for i in range(90)))
    args = dict(data=f"{tmp_path}/d.data", labels=f"{tmp_path}/d.label", out_dir=f"{tmp_path}/o", source_name="s", timeout_check_interval=4, shard_flows=3)
    m = jobs.finetune_cache(spark, **args)
    assert m["attack_packets"] == 1 and sum(m["label_counts"].values()) == m["total_flows"] == m["event_count"] and len(m["shards"]) > 1
    assert all(set(s) == {"name", "label_counts"} for s in m["shards"]) and sum(n for s in m["shards"] for n in s["label_counts"].values()) == m["total_flows"]
    assert (m["attack_flow_keys"], m["sampled_normal_flow_keys"], m["selected_flow_keys"], m["max_events"], m["pretrain_data"]) == (1, 0, 1, None, None)
    assert m["schema"]["context_mode"] == "mixed_causal_context" and m["dims"]["packet_tokens"] == 16 and m["source_mode"] == "data_label_pairs" and not m["normal_only"]
    assert m["metadata_fields"][:2] == ["flow_key_hashes", "segment_ids"] and m["total_packets"] == 90 and m["normal_packets"] == 89 and m["source_names"] == ["s"]
    z = dict(sinks.read_shard(f"{tmp_path}/o/shard_00000.npz"))
    assert "segment_ids" in z and set(z["labels"]) == {0, 1}
    only = jobs.finetune_cache(spark, **args, label_policy="segment_only")
    assert only["label_counts"]["1"] == 1
    centred = jobs.finetune_cache(spark, **args, attack_centered=True, normal_flow_sample_size=0)
    assert centred["total_flows"] < m["total_flows"] and set(centred["label_counts"]) == {"1"}
    two = jobs.finetune_cache(spark, **args, attack_centered=True, normal_flow_sample_size=1)
    assert (two["attack_flow_keys"], two["sampled_normal_flow_keys"], two["selected_flow_keys"]) == (1, 1, 2)
    first = jobs.finetune_cache(spark, **args, max_packets=50)
    assert (first["total_packets"], first["attack_packets"], first["attack_flow_keys"]) == (50, 0, 0)
    for bad in ({"packet_cutoff": 5}, {"label_policy": "x"}, {"graph_token_count": 4}):
        with pytest.raises(ValueError):
            jobs.finetune_cache(spark, **args, **bad)


def attack_and_benign():
    attack = [(100 * S + i * S, tcp(1, 9, 1000, 80, 40 + i)) for i in range(10)]
    benign = [(100 * S + i * S // 2, tcp(2 + i % 3, 9, 2000 + i % 3, 443, 100 + i)) for i in range(40)]
    return attack, benign


def test_process_by_rules(spark, tmp_path):
    attack, benign = attack_and_benign()
    (tmp_path / "raw.pcap").write_bytes(pcap(sorted(attack + benign, key=lambda r: r[0])))
    rule = {"attackers": ["10.0.0.1"], "start_time": "1970-01-01 00:01:00", "end_time": "1970-01-01 01:00", "attack_type": "scan"}
    cfg = {"global": {"mode": "rules", "output_dir": f"{tmp_path}/out", "raw_pcap": f"{tmp_path}/raw.pcap", "neg_sampling_rate": 1.0}, "attacks": [{"name": "one", "rules": [rule]}, {"name": "none", "rules": []}]}
    (tmp_path / "c.json").write_text(json.dumps(cfg))
    got = jobs.process(spark, str(tmp_path / "c.json"))
    assert set(got) == {"one"} and got["one"]["packets"] == got["one"]["rows"] > 10
    labels = "".join(f.read_text() for f in sorted((tmp_path / "out/one.label").glob("part-*"))).split()
    assert labels.count("1") == 10 and labels.count("0") == got["one"]["rows"] - 10
    lines = "".join(f.read_text() for f in sorted((tmp_path / "out/one.data").glob("part-*"))).splitlines()
    assert lines[0].split()[5] == "0" and len(lines) == got["one"]["rows"]
    assert list((tmp_path / "out/one_mixed").glob("*.pcap")) and list((tmp_path / "out/one.csv").glob("part-*"))
    budget = jobs.process(spark, str(tmp_path / "c.json"), {"PCAP_MERGE_TOTAL_PKTS": "12", "PCAP_MERGE_ATTACK_RATIO": "1.0", "PCAP_MERGE_TIME_BINS": "1"})
    assert budget["one"]["packets"] == 10


def test_process_by_folders(spark, tmp_path):
    attack, benign = attack_and_benign()
    for name, rows in (("pos/a.pcap", attack), ("pos/many/1.pcap", attack[:5]), ("pos/many/2.pcap", attack[5:]), ("neg/1.pcap", benign[:20]), ("neg/2.pcap", benign[20:])):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(pcap(rows))
    g = {"mode": "folder", "output_dir": f"{tmp_path}/out", "pos_glob": f"{tmp_path}/pos", "neg_glob": f"{tmp_path}/neg", "pretrain_neg_glob": f"{tmp_path}/neg", "neg_sampling_rate": 0.0, "write_mixed_pcap": False}
    (tmp_path / "c.json").write_text(json.dumps({"global": g, "attacks": []}))
    got = jobs.process(spark, str(tmp_path / "c.json"))
    assert got == {"a": {"packets": 10, "rows": 10}, "many": {"packets": 10, "rows": 10}}
    assert sum(len(f.read_text().splitlines()) for f in (tmp_path / "out/pretrain_benign.data").glob("part-*")) == 40
    assert not (tmp_path / "out/pretrain_benign.label").exists() and not (tmp_path / "out/a_mixed").exists()
    (tmp_path / "c.json").write_text(json.dumps({"global": dict(g, pos_glob=f"{tmp_path}/pos/a.pcap", neg_glob=None, shared_neg_pcap=f"{tmp_path}/neg/*.pcap", neg_sampling_rate=1.0, pretrain_neg_glob=None, output_dir=f"{tmp_path}/two"), "attacks": []}))
    two = jobs.process(spark, str(tmp_path / "c.json"))
    assert set(two) == {"a"} and two["a"]["rows"] > 10
    (tmp_path / "c.json").write_text(json.dumps({"global": dict(g, mode="other"), "attacks": []}))
    assert jobs.process(spark, str(tmp_path / "c.json")) == {}
    (tmp_path / "c.json").write_text(json.dumps({"global": dict(g, shared_neg_pcap="/none"), "attacks": []}))
    with pytest.raises(FileNotFoundError):
        jobs.process(spark, str(tmp_path / "c.json"))


def test_statistics(spark, tmp_path):
    attack, benign = attack_and_benign()
    (tmp_path / "s").mkdir()
    (tmp_path / "s/a.pcap").write_bytes(pcap(attack + [(S, b"short")]))
    (tmp_path / "s/bad.pcap").write_bytes(b"x" * 30)
    with zipfile.ZipFile(tmp_path / "s/b.zip", "w") as z:
        z.writestr("b.pcap", pcap(benign))
    (tmp_path / "r.json").write_text(json.dumps({"attacks": [{"rules": [{"attackers": ["10.0.0.1"], "start_time": "1970-01-01 01:00", "end_time": "1970-01-01 02:00"}]}]}))
    (tmp_path / "c.json").write_text(json.dumps([{"name": "d", "sources": [f"{tmp_path}/s"], "rules": f"{tmp_path}/r.json", "timezone_offset": -1}, {"name": "e", "sources": []}]))
    got = jobs.dataset_statistics(spark, str(tmp_path / "c.json"), str(tmp_path / "o.json"))
    assert got == json.loads((tmp_path / "o.json").read_text())
    d, e = got
    assert (d["attack_packets"], d["benign_packets"], d["skipped"], d["attack_flows"], d["benign_flows"]) == (10, 40, 2, 1, 3)
    assert d["benign_dport_top"] == [[443, 40]] and e["benign_packets"] == 0 == e["skipped"]


def test_command_line():
    o = cli.parser().parse_args(["finetune-cache", "--data", "d", "--labels", "l", "--out-dir", "o", "--source-name", "s", "--attack-centered"])
    assert o.window_packet_limit == 100000 and o.shard_flows == 4096 and o.attack_centered and o.seed == 42 and o.label_policy == "flow_contaminated"
    o = cli.parser().parse_args(["pretrain-cache", "--data", "d", "--out-dir", "o"])
    assert (o.packet_cutoff, o.window_packet_limit, o.shard_flows, o.timeout_check_interval) == (20, 2000, 50000, 256)
    assert cli.parser().parse_args(["stats", "-c", "x", "-o", "y"]).output == "y"
