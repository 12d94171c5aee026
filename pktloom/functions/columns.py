"""Keys, bit masks, dialects and scalings of packet columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TCP, UDP, ICMP, IGMP, ICMPV6 = 6, 17, 1, 2, 58
TCP_BITS = 0b11110000

#: Field-7 numbers that mode auto takes for protocols.
AUTO_PROTOCOLS = (0, 1, 2, 6, 17, 58)


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ipv4_number(ip: Column | str) -> Column:
    """An IPv4 text as a number; null for other texts."""
    p = F.split(_c(ip), r"\.")
    part = [F.try_element_at(p, F.lit(k + 1)).try_cast("bigint") for k in range(4)]
    ok = _c(ip).rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")
    fits = part[0].between(0, 255) & part[1].between(0, 255) & part[2].between(0, 255) & part[3].between(0, 255)
    return F.when(ok & fits, part[0] * 16777216 + part[1] * 65536 + part[2] * 256 + part[3])


def ipv4_sort(ip: Column | str) -> Column:
    """Sort key of an IPv4 text: family 4, then its bytes."""
    return F.unhex(F.concat(F.lit("04"), F.lpad(F.hex(ipv4_number(ip)), 8, "0")))


_HEX = r"[0-9a-f]{1,4}"
_IPV6 = rf"^(({_HEX}:){{7}}{_HEX}|(({_HEX}:)*{_HEX})?::(({_HEX}:)*{_HEX})?)$"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, where writing it out again and again would blow the expression up."""
    return F.element_at(F.transform(F.array(value), body), 1)


def bound(df: DataFrame, **columns: Column) -> DataFrame:
    """df with columns that later filters and projections refer to and do not repeat: the optimizer moves nothing across a generator."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _groups(six: Column) -> Column:
    """The eight hex groups of an IPv6 text without dots; others give another number of them."""

    def filled(halves: Column) -> Column:
        left, right = (F.filter(F.split(F.coalesce(F.try_element_at(halves, F.lit(k)), F.lit("")), ":"), lambda g: g != "") for k in (1, 2))
        missing = F.lit(8) - F.size(left) - F.size(right)
        return F.when(F.size(halves) == 2, F.concat(left, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), right)).otherwise(left)

    return let(F.split(six, "::"), filled)


def ip_sort(ip: Column | str) -> Column:
    """Sort key of an IPv4 or IPv6 text: family, then bytes; null for texts that are no address."""

    def undotted(text: Column) -> Column:
        tail = ipv4_number(F.substring_index(text, ":", -1))
        hexed = let(tail, lambda n: F.concat(F.regexp_replace(text, r"[^:]*$", ""), F.lower(F.hex(F.shiftright(n, 16))), F.lit(":"), F.lower(F.hex(n.bitwiseAND(F.lit(65535))))))
        return F.when(text.contains("."), hexed).otherwise(text)

    def packed(six: Column) -> Column:
        digits = F.array_join(F.transform(_groups(six), lambda g: F.lpad(g, 4, "0")), "")
        return F.when(six.rlike(_IPV6), let(digits, lambda d: F.when(F.length(d) == 32, F.unhex(F.concat(F.lit("06"), d)))))

    six = let(F.lower(_c(ip)), lambda text: let(undotted(text), packed))
    return F.when(_c(ip).contains(":"), six).otherwise(ipv4_sort(ip))


def ipv4_text(data: Column) -> Column:
    """Four bytes as dotted text."""
    return F.concat_ws(".", *[F.conv(F.hex(F.substring(data, k, 1)), 16, 10) for k in range(1, 5)])


def ipv6_text(data: Column) -> Column:
    """Sixteen bytes as text: the first longest run of zero groups is shortened, mapped IPv4 is dotted."""

    def shortened(full: Column) -> Column:
        out = F.regexp_replace(full, "^:|:$", "")
        for n in range(2, 9):
            run = ":0" * n + ":"
            at = F.locate(run, full)
            cut = F.concat(F.substring(full, F.lit(2), F.greatest(at - 2, F.lit(0))), F.lit("::"), F.regexp_replace(F.substring(full, at + len(run), F.length(full)), ":$", ""))
            out = F.when(at > 0, cut).otherwise(out)
        return out

    def said(h: Column) -> Column:
        groups = [F.regexp_replace(F.substring(h, 4 * k + 1, 4), "^0{1,3}", "") for k in range(8)]
        full = F.concat(F.lit(":"), F.concat_ws(":", *groups), F.lit(":"))
        return F.when(h.startswith("00000000000000000000ffff"), F.concat(F.lit("::ffff:"), ipv4_text(F.unhex(F.substring(h, 25, 8))))).otherwise(let(full, shortened))

    return let(F.lower(F.hex(data)), said)


def swapped() -> Column:
    """Whether the canonical key turns a packet's direction round."""
    return F.struct("src_sort", "src_port") > F.struct("dst_sort", "dst_port")


def canonical_key() -> list[Column]:
    """The undirected key: the lesser endpoint (address, then port) first."""
    s = swapped()
    return [
        F.when(s, F.col("dst_ip")).otherwise(F.col("src_ip")).alias("a_ip"),
        F.when(s, F.col("dst_port")).otherwise(F.col("src_port")).alias("a_port"),
        F.when(s, F.col("src_ip")).otherwise(F.col("dst_ip")).alias("b_ip"),
        F.when(s, F.col("src_port")).otherwise(F.col("dst_port")).alias("b_port"),
        F.col("protocol"),
    ]


def canonical_text() -> Column:
    """The undirected key as one text, its parts in the order of canonical_key()."""
    one = lambda a, b: F.concat_ws("|", *[F.col(c).cast("string") for c in (f"{a}_ip", f"{a}_port", f"{b}_ip", f"{b}_port", "protocol")])
    return F.when(swapped(), one("dst", "src")).otherwise(one("src", "dst"))


def edge_key() -> list[Column]:
    """The pair of addresses, the lesser first."""
    s = F.col("src_sort") > F.col("dst_sort")
    return [F.when(s, F.col("dst_ip")).otherwise(F.col("src_ip")).alias("ip_lo"), F.when(s, F.col("src_ip")).otherwise(F.col("dst_ip")).alias("ip_hi")]


def key_text(columns: list[str]) -> Column:
    return F.concat_ws("|", *[F.col(c).cast("string") for c in columns])


def h32(x: Column) -> Column:
    """A portable hash in [0, 2^32): the first 8 hex digits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("bigint")


def flow_hash(columns: list[str], source: str | None = None) -> Column:
    """An opaque 64-bit name of a flow, salted by a source name where one is given."""
    return F.xxhash64(*([F.lit(source)] if source is not None else []), *columns)


def service_port(a: Column | str = "src_port", b: Column | str = "dst_port") -> Column:
    """The smallest port that is not 0, else 0."""
    a, b = F.nullif(_c(a), F.lit(0)), F.nullif(_c(b), F.lit(0))
    return F.coalesce(F.least(a, b), F.lit(0))


def service_bucket(protocol: Column | str = "protocol", port: Column | None = None) -> Column:
    return F.shiftleft(_c(protocol).cast("bigint"), 16).bitwiseOR((service_port() if port is None else port).cast("bigint"))


def port_group(port: Column) -> Column:
    return F.when(port == 0, 0.0).when(port <= 1023, 1 / 3).when(port <= 49151, 2 / 3).otherwise(1.0)


def protocol_group(protocol: Column) -> Column:
    return F.when(protocol == TCP, 0.25).when(protocol == UDP, 0.5).when(protocol.isin(ICMP, ICMPV6), 0.75).otherwise(1.0)


def code_bit(code: Column, bit: int) -> Column:
    return F.getbit(code, F.lit(bit)).cast("int")


def safe_ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def log1p(x: Column) -> Column:
    return F.log(x.cast("double") + 1)


def length_bucket(n: Column) -> Column:
    """floor(log2(max(n, 1))), at most 16: the number of binary digits, less one."""
    return F.least(F.length(F.bin(F.greatest(n.cast("bigint"), F.lit(1)))) - 1, F.lit(16))


def _any(code: Column, mask: int) -> Column:
    return code.bitwiseAND(mask) != 0


def code_to_protocol(code: Column, dialect: str) -> Column:
    """The protocol that a packet code says, in one of the three dialects, which disagree."""
    if dialect == "flow":
        return F.when(_any(code, TCP_BITS), TCP).when(_any(code, 1 << 8), UDP).when(_any(code, 1 << 2), ICMP).otherwise(0)
    if dialect == "pretrain":
        return F.when(_any(code, 1 << 8), UDP).when(_any(code, TCP_BITS), TCP).when(_any(code, 1 << 2), ICMP).when(_any(code, 1 << 3), IGMP).otherwise(0)
    if dialect == "finetune":
        return F.when(_any(code, TCP_BITS), TCP).when(_any(code, 1 << 8), UDP).when(_any(code, 1 << 2), ICMP).when(_any(code, 1 << 3), IGMP).otherwise(0)
    raise ValueError(f"no dialect {dialect}")


def protocol_to_code(version: Column, protocol: Column, dialect: str) -> Column:
    """The packet code that a protocol implies."""
    ip = F.when(version == 4, 1).when(version == 6, 2).otherwise(0)
    if dialect == "pretrain":
        rest = F.when(protocol.isin(ICMP, ICMPV6), 1 << 2).when(protocol == IGMP, 1 << 3).when(protocol == TCP, 1 << 5).when(protocol == UDP, 1 << 8).otherwise(1 << 9)
    elif dialect == "finetune":
        rest = F.when(protocol == UDP, 1 << 8).when(protocol == ICMP, 1 << 2).when(protocol == IGMP, 1 << 3).when(protocol.isin(0, TCP), 0).otherwise(1 << 9)
    else:
        raise ValueError(f"no dialect {dialect}")
    return ip.bitwiseOR(rest)


def field7(version: Column, field: Column, mode: str, dialect: str) -> tuple[Column, Column]:
    """(protocol, packet_code) of the seventh field of an 8-field line."""
    low = field.bitwiseAND(255)
    as_protocol = (low, protocol_to_code(version, low, dialect))
    as_code = (code_to_protocol(field, dialect), field)
    if mode == "protocol":
        return as_protocol
    if mode == "packet_code":
        return as_code
    if mode == "auto":
        known = field.isin(*AUTO_PROTOCOLS)
        return tuple(F.when(known, p).otherwise(c) for p, c in zip(as_protocol, as_code))
    raise ValueError(f"field7 mode must be protocol, packet_code or auto, not {mode}")


def to_ns(value: Column, unit: str) -> Column:
    if unit == "ns":
        return value
    if unit == "us":
        return value * 1000
    raise ValueError(f"timestamp unit must be ns or us, not {unit}")


def wall_micros(at: Column) -> Column:
    """Microseconds of a timestamp's wall clock, read as UTC whatever the session's time zone."""
    return F.unix_micros(F.from_utc_timestamp(at.cast("timestamp"), F.current_timezone()))


def rule_time_ns(text: Column, offset_hours: int = 0) -> Column:
    """Nanoseconds of a naive UTC time of minute or second resolution, shifted by hours; null for other texts."""
    at = F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")))
    return (wall_micros(at) + offset_hours * 3_600_000_000) * 1000


def fixed6(x: Column) -> Column:
    """A number with six decimals, rounded from its exact binary value, ties to even.

    The JVM's own formatting rounds the shortest decimal that reads back as the number, which differs where that ends in a five. Here
    x * 10^6 is a product p and its exact error. From 9e9 on, where a double has few decimals left, the JVM formats.
    """
    million, splitter = F.lit(1e6), F.lit(134217729.0)

    def of(a: Column) -> Column:
        high = a * splitter - (a * splitter - a)
        p = a * million
        error = (high * million - p) + (a - high) * million
        below = F.floor(p)
        rest = (p - below) + error
        up = (rest > 0.5) | ((rest == 0.5) & (below % 2 == 1))
        n = below + F.when(up, 1).otherwise(0)
        return F.concat(F.call_function("div", n, F.lit(1_000_000)).cast("string"), F.lit("."), F.lpad((n % 1_000_000).cast("string"), 6, "0"))

    size = F.abs(x)
    return F.when(size < 9e9, F.concat(F.when(x < 0, "-").otherwise(""), let(size, of))).otherwise(F.format_string("%.6f", x))
