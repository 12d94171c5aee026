"""Schemas of the tables that operators exchange."""

from __future__ import annotations

FRAMES = "file_ord int, frame_no bigint, ts_ns bigint, linktype int, caplen int, data binary"

#: idx is the arrival order, on which all stateful operators depend. *_sort order addresses by family, then numerically.
PACKETS = (
    "idx bigint, ip_version int, src_ip string, dst_ip string, src_sort binary, dst_sort binary, src_port int, dst_port int, "
    "protocol int, packet_code int, ip_len int, ts_ns bigint, label boolean"
)

KEY = ["src_ip", "dst_ip", "src_port", "dst_port", "protocol"]

#: Undirected flow key, as canonical_key() names its parts.
CANONICAL = ["a_ip", "a_port", "b_ip", "b_port", "protocol"]

RULES = "rule_ord int, attacker string, start_ns bigint, end_ns bigint, attack_type string, direction string"

#: Bits of packet_code.
BITS = {"ipv4": 0, "ipv6": 1, "icmp": 2, "igmp": 3, "syn": 4, "ack": 5, "fin": 6, "rst": 7, "udp": 8, "unknown": 9}
