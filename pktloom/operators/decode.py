"""Binary decoding of captured frames with column expressions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C

ETHERNET, RAW, SLL = 1, 12, 113
IPV4, IPV6, VLAN = 0x0800, 0x86DD, 0x8100


def number(data: Column, at: Column | int, n: int) -> Column:
    """n big-endian bytes at a 0-based offset; null beyond the end."""
    at = F.lit(at) if isinstance(at, int) else at
    part = F.substring(data, at + 1, F.lit(n))
    return F.when(F.length(part) == n, F.conv(F.hex(part), 16, 10).cast("int"))


def l2() -> tuple[Column, Column]:
    """(offset, ethertype) of the network header by link type; null where the frame is too short or the type unknown."""
    data, link, size = F.col("data"), F.col("linktype"), F.length("data")
    outer = number(data, 12, 2)
    tagged = outer == VLAN
    version = F.shiftright(number(data, 0, 1), 4)
    offset = (
        F.when((link == ETHERNET) & (size >= 14), F.when(~tagged, 14).when(size >= 18, 18))
        .when((link == SLL) & (size >= 16), 16)
        .when((link == RAW) & version.isin(4, 6), 0)
    )
    kind = (
        F.when(link == ETHERNET, F.when(tagged, number(data, 16, 2)).otherwise(outer))
        .when(link == SLL, number(data, 14, 2))
        .when(link == RAW, F.when(version == 4, IPV4).when(version == 6, IPV6))
    )
    return offset, kind


def _headers(frames: DataFrame) -> DataFrame:
    """frames with their network headers: o, ip_version, version_nibble, l4, protocol, ip_len, src and dst (bytes), rest (bytes after l4)."""
    offset, kind = l2()
    f = C.bound(frames, o=offset, kind=kind)
    data, size, o = F.col("data"), F.length("data"), F.col("o")
    four, six = (F.col("kind") == IPV4) & (size >= o + 20), (F.col("kind") == IPV6) & (size >= o + 40)
    f = C.bound(f, ip_version=F.when(four, 4).when(six, 6))
    is4 = F.col("ip_version") == 4
    f = C.bound(
        f.where("ip_version is not null"),
        version_nibble=F.shiftright(number(data, o, 1), 4),
        l4=o + F.when(is4, number(data, o, 1).bitwiseAND(15) * 4).otherwise(40),
        protocol=F.when(is4, number(data, o + 9, 1)).otherwise(number(data, o + 6, 1)),
        ip_len=F.when(is4, number(data, o + 2, 2)).otherwise((number(data, o + 4, 2) + 40) % 65536),
        src=F.when(is4, F.substring(data, o + 13, F.lit(4))).otherwise(F.substring(data, o + 9, F.lit(16))),
        dst=F.when(is4, F.substring(data, o + 17, F.lit(4))).otherwise(F.substring(data, o + 25, F.lit(16))),
    )
    return f.withColumn("rest", F.length("data") - F.col("l4"))


def _address(raw: str) -> tuple[Column, Column]:
    is4 = F.col("ip_version") == 4
    text = F.when(is4, C.ipv4_text(F.col(raw))).otherwise(C.ipv6_text(F.col(raw)))
    return text, F.concat(F.when(is4, F.lit(b"\x04")).otherwise(F.lit(b"\x06")), F.col(raw))


def decode_frames(frames: DataFrame) -> DataFrame:
    """frames with the packet columns; frames that are no whole IP packet go.

    TCP needs 20 bytes and UDP 8 after the network header, else the row goes; other protocols need none.
    """
    rest, protocol = F.col("rest"), F.col("protocol")
    tcp, udp = protocol == C.TCP, protocol == C.UDP
    f = _headers(frames).where((rest >= 0) & ((rest == 0) | ~tcp | (rest >= 20)) & ((rest == 0) | ~udp | (rest >= 8)))
    ported = (tcp | udp) & (rest > 0)
    port = lambda at: F.when(ported, number(F.col("data"), F.col("l4") + at, 2)).otherwise(0)
    flags = number(F.col("data"), F.col("l4") + 13, 1)
    seen = lambda mask, bit: F.when(flags.bitwiseAND(mask) != 0, 1 << bit).otherwise(0)
    of_tcp = seen(0x02, 4).bitwiseOR(seen(0x10, 5)).bitwiseOR(seen(0x01, 6)).bitwiseOR(seen(0x04, 7))
    of_l4 = (
        F.when(rest <= 0, 1 << 9).when(tcp, of_tcp).when(udp, 1 << 8).when(protocol == C.ICMP, 1 << 2).when(protocol == C.IGMP, 1 << 3).otherwise(1 << 9)
    )
    (src_ip, src_sort), (dst_ip, dst_sort) = _address("src"), _address("dst")
    return f.select(
        *frames.columns, "ip_version", src_ip.alias("src_ip"), dst_ip.alias("dst_ip"), src_sort.alias("src_sort"), dst_sort.alias("dst_sort"),
        port(0).alias("src_port"), port(2).alias("dst_port"), "protocol", F.when(F.col("ip_version") == 4, 1).otherwise(2).bitwiseOR(of_l4).alias("packet_code"), "ip_len",
    )


def lax_flow_key(frames: DataFrame) -> DataFrame:
    """frames with a flow key that short transport headers leave with ports 0; null where there is none."""
    rest = F.col("rest")
    f = _headers(frames).where("version_nibble = ip_version").where((F.col("ip_version") == 6) | (rest >= 4))
    ported = F.col("protocol").isin(C.TCP, C.UDP) & (rest >= 4)
    port = lambda at: F.when(ported, number(F.col("data"), F.col("l4") + at, 2)).otherwise(0)
    (src_ip, src_sort), (dst_ip, dst_sort) = _address("src"), _address("dst")
    keyed = f.select("file_ord", "frame_no", src_ip.alias("src_ip"), dst_ip.alias("dst_ip"), src_sort.alias("src_sort"), dst_sort.alias("dst_sort"), port(0).alias("src_port"), port(2).alias("dst_port"), "protocol")
    return frames.join(keyed, ["file_ord", "frame_no"], "left")


def wrap_ethernet(frames: DataFrame) -> DataFrame:
    """frames as Ethernet frames; those of other links get a made-up header, and empty or undecodable ones go."""
    offset, kind = l2()
    data = F.col("data")
    header = F.concat(F.lit(bytes.fromhex("ffffffffffff020000000001")), F.unhex(F.lpad(F.hex(kind), 4, "0")))
    own = F.col("linktype") == ETHERNET
    f = C.bound(frames, wrapped=F.when(own & (F.length(data) > 0), data).when(~own & offset.isNotNull() & kind.isNotNull(), F.concat(header, F.substring(data, offset + 1, F.length(data)))))
    out = f.where("wrapped is not null").withColumn("data", F.col("wrapped")).drop("wrapped")
    return out.withColumn("linktype", F.lit(ETHERNET)).withColumn("caplen", F.length("data"))


def timestamp_ns(sec: Column, usec: Column) -> Column:
    return sec * 1_000_000_000 + usec * 1000
