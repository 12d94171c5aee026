import struct

import pytest

from pktloom.operators import decode

G3 = bytes.fromhex("ffffffffffff0200000000010800" "4500002800004000400600000a0000010a000002" "3039005000000000000000005002200000000000")
IP = G3[14:]


def frames(spark, rows):
    """rows: (linktype, bytes)"""
    return spark.createDataFrame([(0, i, i * 1000, l, len(d), bytearray(d)) for i, (l, d) in enumerate(rows)], "file_ord int, frame_no bigint, ts_ns bigint, linktype int, caplen int, data binary")


def v6(next_header, payload, size=None):
    return struct.pack(">IHBB", 6 << 28, len(payload) if size is None else size, next_header, 64) + bytes(15) + b"\1" + bytes.fromhex("20010db8") + bytes(11) + b"\2" + payload


def test_golden_frame(spark):
    r = decode.decode_frames(frames(spark, [(1, G3)])).first()
    assert (r.ip_version, r.src_ip, r.src_port, r.dst_ip, r.dst_port, r.protocol, r.ip_len, r.packet_code) == (4, "10.0.0.1", 12345, "10.0.0.2", 80, 6, 40, 17)


def test_links_and_drops(spark):
    udp = struct.pack(">HHHH", 53, 5353, 8, 0)
    icmp4 = IP[:9] + b"\x01" + IP[10:20]
    cases = [
        (12, IP, 17), (113, bytes(14) + b"\x08\x00" + IP, 17), (1, G3[:12] + bytes.fromhex("81000005") + G3[12:], 17), (1, G3[:-1], None), (1, G3[:34], 513), (1, G3[:33], None), (7, G3, None), (1, b"", None),
        (12, v6(17, udp), 2 | 256), (12, v6(58, b"x"), 2 | 512), (12, v6(6, udp), None), (12, v6(17, b""), 2 | 512), (12, icmp4 + b"x", 1 | 4), (12, IP[:9] + b"\x02" + IP[10:20] + b"x", 1 | 8), (1, G3[:12] + b"\x81\x00\x00\x05", None), (12, b"\x00" * 40, None),
    ]
    got = {r.frame_no: r for r in decode.decode_frames(frames(spark, [c[:2] for c in cases])).collect()}
    assert {i: got[i].packet_code for i in got} == {i: c[2] for i, c in enumerate(cases) if c[2] is not None}
    r = got[8]
    assert (r.src_ip, r.dst_ip, r.src_port, r.ip_len, r.src_sort) == ("::1", "2001:db8::2", 53, 48, b"\x06" + bytes(15) + b"\1")


def test_payload_length_wraps(spark):
    assert decode.decode_frames(frames(spark, [(12, v6(59, b"x", 65530))])).first().ip_len == (65530 + 40) % 65536


def test_lax_key(spark):
    rows = [(1, G3), (1, G3[:40]), (1, G3[:36]), (1, G3[:14] + b"\x65" + G3[15:]), (12, v6(6, b"")), (1, b"")]
    got = [(r.src_ip, r.src_port) for r in decode.lax_flow_key(frames(spark, rows)).orderBy("frame_no").collect()]
    assert got == [("10.0.0.1", 12345), ("10.0.0.1", 12345), (None, None), (None, None), ("::1", 0), (None, None)]


def test_wrap(spark):
    rows = [(1, G3), (1, b""), (12, IP), (113, bytes(14) + b"\x08\x00" + IP), (12, b"\x00"), (9, IP), (1, b"x")]
    got = {r.frame_no: bytes(r.data) for r in decode.wrap_ethernet(frames(spark, rows)).collect()}
    assert got == {0: G3, 2: G3[:12] + b"\x08\x00" + IP, 3: G3[:12] + b"\x08\x00" + IP, 6: b"x"}


def test_timestamp(spark):
    assert spark.range(1).select(decode.timestamp_ns(*[__import__("pyspark").sql.functions.lit(x).cast("bigint") for x in (3, 7)])).first()[0] == 3_000_007_000


@pytest.mark.parametrize("kind", ["decode_frames", "lax_flow_key", "wrap_ethernet"])
def test_empty(spark, kind):
    assert getattr(decode, kind)(frames(spark, [(1, G3)]).where("false")).count() == 0
