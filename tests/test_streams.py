"""Sessions, merging, budgets, segments and windows against sequential versions written from their definitions."""

import math
import random
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from pktloom.functions import columns as C
from pktloom.operators import context, flows, merge, ordering, rules, segments, stats
from pktloom.schema import CANONICAL, KEY

S = 1_000_000_000


def table(spark, rows):
    """rows: (src, dst, sport, dport, protocol, ts, len[, label]); addresses are last octets."""
    data = [(i, 4, f"10.0.0.{r[0]}", f"10.0.0.{r[1]}", r[2], r[3], r[4], 1 | 32, r[6], r[5], bool(r[7]) if len(r) > 7 else False) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "idx bigint, ip_version int, src_ip string, dst_ip string, src_port int, dst_port int, protocol int, packet_code int, ip_len int, ts_ns bigint, label boolean")
    return df.withColumn("src_sort", C.ip_sort("src_ip")).withColumn("dst_sort", C.ip_sort("dst_ip"))


def random_rows(seed, n=400, step=3 * S, hosts=5, ordered=True):
    rnd, t, out = random.Random(seed), 0, []
    for _ in range(n):
        t += rnd.choice([0, 1, rnd.randrange(step)])
        out.append((rnd.randrange(1, hosts), rnd.randrange(1, hosts), rnd.choice([1, 2]), rnd.choice([80, 53]), rnd.choice([6, 17]), t if ordered else t + rnd.randrange(-step, step), rnd.randrange(40, 1500), rnd.random() < 0.1))
    return out


def canon(r):
    a, b = (r[0], r[2]), (r[1], r[3])
    return (*min(a, b), *max(a, b), r[4])


def test_sessions_golden(spark):
    rows = [(1, 2, 5, 80, 6, 0, 60), (1, 2, 5, 80, 6, 120 * S, 60), (1, 2, 5, 80, 6, 240 * S + 1, 60), (2, 1, 80, 5, 6, 240 * S + 2, 60)]
    got = flows.flow_features(flows.sessionize(table(spark, rows)))
    assert sorted((r.src_ip, r.session, r.fwd_pkts, r.bwd_pkts) for r in got.collect()) == [("10.0.0.1", 0, 2, 0), ("10.0.0.1", 1, 1, 0), ("10.0.0.2", 0, 1, 0)]
    rows = [(1, 2, 5, 80, 6, 0, 100), (1, 2, 5, 80, 6, S, 200), (1, 2, 5, 80, 6, 3 * S, 300), (3, 4, 1, 1, 6, 7, 50)]
    r = {x.src_ip: x for x in flows.flow_features(flows.sessionize(table(spark, rows))).collect()}
    a, b = r["10.0.0.1"], r["10.0.0.3"]
    assert (a.duration, a.byteps, a.pps, a.pkt_len_mean, round(a.pkt_len_std, 6), a.iat_mean, a.iat_std) == (3, 200, 1, 200, 81.649658, 1.5, 0.5)
    assert (b.duration, b.byteps, b.pps, b.pkt_len_std, b.iat_mean, b.iat_std) == (0,) * 6


@pytest.mark.parametrize("block", [7, 1 << 20])
@pytest.mark.parametrize("batch", [None, 90])
def test_sessions_in_blocks(spark, block, batch):
    rows = random_rows(3, ordered=False, step=100 * S)
    want, last, number = {}, {}, {}
    for i, r in enumerate(rows):
        k = (*r[:5], i // batch if batch else 0)
        if k in last and r[5] - last[k] > 120 * S:
            number[k] += 1
        number.setdefault(k, 0)
        last[k] = r[5]
        want[i] = number[k]
    assert {r.idx: r.session for r in flows.sessionize(table(spark, rows), batch=batch, block=block).collect()} == want


def test_csv(spark):
    rows = [(1, 2, 5, 80, 6, -1, 60, True), (3, 4, 5, 80, 6, -S, 60), (5, 6, 5, 80, 6, 1_700_000_000 * S + 5, 60)]
    got = {r.src_ip: r for r in flows.csv_rows(flows.flow_features(flows.sessionize(table(spark, rows)))).collect()}
    assert [got[f"10.0.0.{k}"].timestamp for k in (1, 3, 5)] == ["01/01/1970 00:00:00", "12/31/1969 23:59:59", "11/14/2023 22:13:20"]
    assert got["10.0.0.1"].label == "ATTACK" and got["10.0.0.3"].byteps == "0.000000" and len(got["10.0.0.1"]) == 18


def slow_merge(attack, benign):
    """attack, benign: lists of (idx, ts); two cursors."""
    if not attack:
        return []
    b_first = benign[0][1] if benign else 0
    dur = max(0, benign[-1][1] - b_first) if benign else 0
    base, out, i, j, loop = max(0, attack[0][1] - dur // 10), [], 0, 0, 0
    while i < len(attack):
        at = base + max(0, benign[j][1] - b_first) + loop * (dur + 1_000_000) if benign else math.inf
        if attack[i][1] <= at:
            out.append((True, attack[i][0], attack[i][1] // 1000 * 1000))
            i += 1
        else:
            out.append((False, benign[j][0], at // 1000 * 1000))
            j += 1
            if j == len(benign):
                j, loop = 0, loop + 1
    return out


@pytest.mark.parametrize("seed", range(4))
def test_merge_against_two_cursors(spark, seed):
    rnd = random.Random(seed)
    a = [(1, 2, 1, 80, 6, 10**9 + rnd.randrange(10**8), 60) for _ in range(rnd.randrange(1, 60))]
    b = [(3, 4, 1, 80, 6, rnd.randrange(5 * 10**7), 60) for _ in range(rnd.randrange(0, 40))]
    got = merge.merge_ordered(table(spark, a), table(spark, b), block_ns=10**7).orderBy("seq").collect()
    assert [(r.is_attack, r.idx, r.ts_ns) for r in got] == slow_merge([(i, r[5]) for i, r in enumerate(a)], [(i, r[5]) for i, r in enumerate(b)])
    assert [r.seq for r in got] == list(range(len(got))) and got[0].rel_ns == 0


def test_merge_edges(spark):
    one = table(spark, [(1, 2, 1, 80, 6, S, 60)])
    assert [(r.is_attack, r.rel_ns) for r in merge.merge_ordered(one, one).collect()] == [(True, 0)]
    assert merge.merge_ordered(one.where("false"), one).count() == 0
    assert merge.merge_ordered(one, one.where("false")).count() == 1


def test_sampling_keeps_whole_flows(spark):
    rows = random_rows(5, 600, hosts=30)
    p = table(spark, rows)
    kept = {r.idx for r in p.where(merge.sampled(0.4)).collect()}
    by = {}
    for i, r in enumerate(rows):
        by.setdefault(canon(r), set()).add(i in kept)
    assert all(len(v) == 1 for v in by.values()) and 0.2 < sum(v == {True} for v in by.values()) / len(by) < 0.6
    assert p.where(merge.sampled(0.0)).count() == 0 and p.where(merge.sampled(1.5)).count() == 600


def test_compact(spark):
    rows = [(0, 0, 10 * S), (0, 1, 10 * S + S // 2), (1, 0, 3 * S), (1, 1, 3 * S + S // 5), (1, 2, 2 * S)]
    df = spark.createDataFrame(rows, "file_ord int, frame_no bigint, ts_ns bigint")
    assert [r.ts_ns for r in merge.compact(df).orderBy("file_ord", "frame_no").collect()][:4] == [0, S // 2, 501_000_000, 701_000_000]


def h32(text):
    return int(md5(text.encode()).hexdigest()[:8], 16)


def slow_budget(rows, lo, hi, budget, bins, attack, seed):
    """rows: (key tuple, pkts, first_ts)"""
    def order(k, n, salt):
        w = math.log(1 + n) if attack else 1 / max(1, math.sqrt(n))
        return -math.log((h32("|".join([f"{seed}|{salt}", *map(str, k)])) + 0.5) / 2**32) / w

    chosen, left, per = set(), budget, max(1, budget // bins)
    for b in range(bins):
        used = 0
        for k, n, _ in sorted((r for r in rows if min((r[2] - lo) * bins // max(1, hi - lo), bins - 1) == b), key=lambda r: order(r[0], r[1], "bin")):
            if used + n <= per and n <= left:
                chosen.add(k)
                used, left = used + n, left - n
    for k, n, _ in sorted((r for r in rows if r[0] not in chosen), key=lambda r: order(r[0], r[1], "rest")):
        if n <= left:
            chosen.add(k)
            left -= n
    return chosen


@pytest.mark.parametrize("budget, bins, walk_rows", [(200, 8, 200_000), (200, 8, 9), (5, 8, 9), (0, 8, 9), (10000, 3, 9), (60, 1, 4), (3, 40, 9), (333, 2, 200_000)])
def test_budget_against_greedy(spark, budget, bins, walk_rows):
    rnd = random.Random(budget)
    rows = [((f"10.0.0.{i}", "10.0.1.1", i, 80, 6), rnd.randrange(1, 30), rnd.randrange(1000)) for i in range(60)]
    df = spark.createDataFrame([(*k, n, t, t) for k, n, t in rows], "src_ip string, dst_ip string, src_port int, dst_port int, protocol int, pkts bigint, first_ts bigint, last_ts bigint")
    for attack in (True, False):
        got = {tuple(r[c] for c in KEY) for r in merge.select_by_budget(df, KEY, 0, 1000, budget, bins, attack, 3, walk_rows).collect()}
        assert got == slow_budget(rows, 0, 1000, budget, bins, attack, 3)


def test_budget_merge(spark):
    a, b = table(spark, random_rows(1, 200)), table(spark, random_rows(2, 200, hosts=9))
    got = merge.merge_by_budget(a, b, 100, 0.3, bins=4).collect()
    assert 0 < sum(r.is_attack for r in got) <= 30 and sum(not r.is_attack for r in got) <= 70
    assert merge.merge_by_budget(a, b, 100, 0.0).count() == 0
    only = merge.merge_by_budget(a, b, 50, 1.0, bidirectional=True).collect()
    assert only and all(r.is_attack for r in only)
    assert merge.merge_by_budget(a, b.where("false"), 50, 0.5).count() <= 25


def slow_segments(rows, policy, cutoff, timeout, interval):
    open_, out = {}, []

    def emit(k, at, reason):
        s = open_.pop(k)
        out.append((s[0], len(s), reason, at))

    for i, r in enumerate(rows):
        if (i if policy == "pretrain" else i + 1) % interval == 0:
            for k in sorted((k for k, s in open_.items() if r[5] - rows[s[0]][5] >= timeout), key=lambda k: open_[k][0]):
                emit(k, i - 1, "timeout")
        k = canon(r)
        open_.setdefault(k, []).append(i)
        if len(open_[k]) >= cutoff:
            emit(k, i, "cutoff")
    for k in sorted(open_, key=lambda k: open_[k][0]):
        emit(k, len(rows) - 1, "end")
    return out


@pytest.mark.parametrize("block", [1 << 18, 16, 5])
@pytest.mark.parametrize("policy", ["pretrain", "finetune"])
@pytest.mark.parametrize("seed, cutoff, timeout, interval", [(1, 5, 20 * S, 7), (2, 1, S, 1), (3, 20, 100 * S, 64), (4, 3, 5 * S, 3)])
def test_segments_against_state_machine(spark, policy, seed, cutoff, timeout, interval, block):
    rows = random_rows(seed)
    got = segments.segments(table(spark, rows), policy, cutoff, timeout, interval, block=block).orderBy("emit_seq").collect()
    assert [(r.start_idx, r.n, r.reason, r.emit_idx) for r in got] == slow_segments(rows, policy, cutoff, timeout, interval)
    by = {}
    for r in got:
        by.setdefault(tuple(r[c] for c in CANONICAL), []).append(r.segment_id)
    assert all(v == list(range(len(v))) for v in by.values())


def test_segments_of_a_hot_flow(spark):
    """Four fifths of the packets are of one flow, in many blocks; no task of the flow's blocks has more than a block of rows."""
    rnd = random.Random(9)
    rows = [(1, 2, 1, 80, 6, t * S // 50, 60) if rnd.random() < 0.8 else (rnd.randrange(3, 9), 2, 1, 80, 6, t * S // 50, 60) for t in range(3000)]
    got = segments.segments(table(spark, rows), "finetune", 7, 20 * S, 64, block=100).orderBy("emit_seq").collect()
    assert [(r.start_idx, r.n, r.reason, r.emit_idx) for r in got] == slow_segments(rows, "finetune", 7, 20 * S, 64)


def test_merge_after_a_late_clock(spark):
    """One late clock makes all later rows of both streams share a running maximum."""
    a = [(1, 2, 1, 80, 6, t * 1000, 60) for t in range(50)] + [(1, 2, 1, 80, 6, 4 * 10**9, 60)] + [(1, 2, 1, 80, 6, t * 1000, 60) for t in range(300)]
    b = [(3, 4, 1, 80, 6, t * 700, 60) for t in range(100)] + [(3, 4, 1, 80, 6, 9 * 10**8, 60)] + [(3, 4, 1, 80, 6, t, 60) for t in range(200)] + [(3, 4, 1, 80, 6, 10**9, 60)]
    got = merge.merge_ordered(table(spark, a), table(spark, b)).orderBy("seq").collect()
    assert [(r.is_attack, r.idx, r.ts_ns) for r in got] == slow_merge([(i, r[5]) for i, r in enumerate(a)], [(i, r[5]) for i, r in enumerate(b)])


def test_segment_options(spark):
    rows = [(1, 2, 5, 80, 6, t * 30 * S, 60, t == 3) for t in range(4)]
    p = table(spark, rows)
    s = segments.segments(p, "pretrain", 20, 60 * S, 1)
    assert sorted((r.start_idx, r.n) for r in s.collect()) == [(0, 2), (2, 2)]
    s = segments.segments(p, "finetune", 20, 60 * S, 1)
    label = lambda policy: [r.label for r in segments.label_segments(s, policy, segments.attack_keys(p)).orderBy("start_idx").collect()]
    assert label("segment_only") == [0, 1] and label("flow_contaminated") == [1, 1]
    assert segments.segments(p, max_packets=2).first().n == 2 and segments.segments(p, cutoff=1, max_flows=3).count() == 3
    assert segments.segments(p.where("false")).count() == 0
    for bad in ({"cutoff": 0}, {"cutoff": 21}, {"interval": 0}, {"timeout_ns": 0}, {"policy": "x"}):
        with pytest.raises(ValueError):
            segments.segments(p, **bad)
    many = table(spark, random_rows(8, hosts=9))
    assert segments.normal_sample(many, 3).count() == 3 and segments.normal_sample(many, 10**6).join(segments.attack_keys(many), CANONICAL, "left_semi").count() == 0


def slow_window(rows, k, duration, limit):
    w = []
    for i in range(k + 1):
        w.append(i)
        while w and (rows[w[0]][5] < rows[i][5] - duration or len(w) > limit):
            w.pop(0)
    return w


def state(rows, picked):
    return (len(picked), sum(rows[i][6] for i in picked), len({canon(rows[i]) for i in picked}), max((rows[i][5] for i in picked), default=0))


@pytest.mark.parametrize("seed, duration, limit, block", [(1, 10 * S, 1000, 1), (2, 1000 * S, 9, 1), (3, 30 * S, 25, 40), (4, 1000 * S, 100_000, 1 << 14)])
def test_context_against_scan(spark, seed, duration, limit, block):
    rows = random_rows(seed, 150)
    p = table(spark, rows)
    segs = segments.segments(p, "finetune", 4, 20 * S, 8)
    b = context.window_bounds(segs, p, duration, limit)
    ends = {(r.start_idx, r.side): r for r in context.endpoint_state(b, p, limit, block=block).collect()}
    service = {r.start_idx: r for r in context.service_state(b, p, limit, block=block).collect()}
    edge = {r.start_idx: r for r in context.edge_state(b, p, limit, block=block).collect()}
    top = {}
    for r in context.graph_top(b, p, limit, block=block).orderBy("rank").collect():
        top.setdefault(r.start_idx, []).append((r.packets, r.bytes, r.last_seen))
    values = lambda r: (r.packets, r.bytes, r.flows, r.last_seen)
    found = segs.collect()
    assert found
    for s in found:
        w = [i for i in slow_window(rows, s.emit_idx, duration, limit) if rows[i][5] <= s.last_ts]
        host = lambda ip: int(ip.rsplit(".", 1)[1])
        x, y = host(s.a_ip), host(s.b_ip)
        for side, ip in enumerate((x, y)):
            assert values(ends[s.start_idx, side]) == state(rows, [i for i in w if ip in rows[i][:2]])
        port = min((q for q in (s.a_port, s.b_port) if q), default=0)
        assert values(service[s.start_idx]) == state(rows, [i for i in w if rows[i][4] == s.protocol and port in rows[i][2:4]])
        assert values(edge[s.start_idx]) == state(rows, [i for i in w if {x, y} == set(rows[i][:2])])
        by = {}
        for i in w:
            by.setdefault(frozenset(rows[i][:2]), []).append(i)
        want = sorted(((q[0], q[1], q[3]) for q in (state(rows, v) for v in by.values())), reverse=True)[:5]
        assert top.get(s.start_idx, []) == want


def test_rules_golden(spark):
    p = table(spark, [(1, 2, 1, 1, 6, 10 * S, 60), (1, 2, 1, 1, 6, 60 * S, 60), (1, 2, 1, 1, 6, 60 * S + 1, 60), (3, 2, 1, 1, 6, 10 * S, 60)])
    x = {"attackers": ["10.0.0.1"], "start_time": "1970-01-01 00:00:00", "end_time": "1970-01-01 00:01", "attack_type": "X", "direction": "src"}
    y = {"attackers": ["10.0.0.2"], "start_time": "1970-01-01 00:00", "end_time": "1970-01-01 00:01:00", "attack_type": "Y"}
    got = [r.attack_type for r in rules.label_first_match(p, rules.load_rules(spark, [y, x])).orderBy("idx").collect()]
    assert got == ["X", "X", "BENIGN", "Y"]
    bad = dict(y, direction="sideways")
    with pytest.raises(ValueError):
        rules.load_rules(spark, [bad])
    assert not any(r.attack for r in rules.label_exists(p, rules.load_rules(spark, [bad], strict=False)).collect())
    with pytest.raises(Exception, match="not a rule time"):
        rules.load_rules(spark, [dict(x, start_time="soon")]).collect()
    shifted = rules.load_rules(spark, [x], offset_hours=1).first()
    assert (shifted.start_ns, shifted.end_ns) == (3600 * S, 3660 * S)
    assert not any(r.attack for r in rules.label_exists(p, rules.load_rules(spark, [])).collect())


def test_stats(spark):
    p = table(spark, [(1, 2, 1, d, 6, 0, 10) for d in [80] * 5 + [22] * 5 + [443] * 9]).withColumn("attack", F.lit(False))
    assert [r.value for r in stats.histogram_top(p, "dst_port", 3).orderBy("rank").collect()] == [443, 22, 80]
    r = stats.dataset_stats(p, "x").first()
    assert (r.benign_packets, r.attack_packets, r.benign_flows, r.attack_packet_ratio, r.avg_pkts_per_attack_flow, len(r.attack_proto_top)) == (19, 0, 3, 0.0, 0.0, 0)
    empty = stats.dataset_stats(p.where("false"), "none").first()
    assert (empty.benign_packets, empty.attack_flow_ratio, empty.benign_dport_top) == (0, 0.0, [])


def test_ordering(spark):
    rnd = random.Random(3)
    points = sorted(rnd.randrange(2000) for _ in range(40))
    targets = [rnd.randrange(-300, 2600) for _ in range(200)]
    p = spark.createDataFrame(list(enumerate(points)), "v bigint, t bigint")
    q = spark.createDataFrame(list(enumerate(targets)), "id bigint, target bigint")
    got = {r.id: r.first for r in ordering.first_at_or_after(q, "target", p, "t", "v", "first", 97).collect()}
    assert got == {i: next((v for v, t in enumerate(points) if t >= x), None) for i, x in enumerate(targets)}
    assert {r.first for r in ordering.first_at_or_after(q, "target", p.where("false"), "t", "v", "first", 97).collect()} == {None}
    # a gap of centuries is one step
    far = spark.createDataFrame([(0, 5), (1, 10**18)], "v bigint, t bigint")
    assert [r.first for r in ordering.first_at_or_after(q.where("target > 5"), "target", far, "t", "v", "first", 1).distinct().select("first").distinct().collect()] == [1]
    df = q.withColumnRenamed("id", "o")
    big, want = -(10**9), []
    for x in targets:
        big = max(big, x)
        want.append(big)
    assert [r.m for r in ordering.running_max(df, "target", "o", "m", block=9).orderBy("o").collect()] == want
