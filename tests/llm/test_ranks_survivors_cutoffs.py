import datetime as dt
import math
import random
from statistics import median

import pytest

from tidewrack.llm import cutoffs, rank_fusion, survivors

T0 = dt.datetime(2024, 1, 1)
SCORES = "score_batch long, dataset string, cut_id string, utmos_t float, dns_t float, si_sdr_t float, stoi_t float, scored_at timestamp, median_rank double, value string"


def test_ranks_against_brute_force(spark):
    random.seed(1)
    rows = []
    for i in range(400):
        v = [random.choice([None, float("nan"), -7.0, 1 + random.randrange(9) / 2]) for _ in range(2)]
        rows.append((random.choice([1, 2, None]), "d", f"c{i % 150}", v[0], v[1], random.choice([-999.0, None, random.uniform(-60, 60)]), random.choice([2.0, random.random()]), T0 + dt.timedelta(seconds=i), 0.0, "x"))
    df = spark.createDataFrame(rows, SCORES)
    last = {}
    for r in rows:
        last[r[0], r[1], r[2]] = r
    want = {}
    for b in {k[0] for k in last}:
        items = {k: r for k, r in last.items() if k[0] == b}
        ranks = {k: [] for k in items}
        for j, (lo, hi) in enumerate(rank_fusion.SCALES.values()):
            vals = {k: r[3 + j] for k, r in items.items() if r[3 + j] is not None and not math.isnan(r[3 + j]) and lo <= r[3 + j] <= hi}
            for k, v in vals.items():
                above, same = sum(x > v for x in vals.values()), sum(x == v for x in vals.values())
                ranks[k].append((above + same / 2) / len(vals))
        order = sorted(items, key=lambda k: ((0, round(median(ranks[k]), 9), round(sum(ranks[k]) / len(ranks[k]), 9)) if ranks[k] else (1, 0, 0), k[1], k[2]))
        want |= {k: i + 1 for i, k in enumerate(order)}
    got = {(r.score_batch, r.dataset, r.cut_id): r.position for r in rank_fusion.ranking(df).collect()}
    assert got == want
    assert {tuple(r) for r in rank_fusion.best(df).collect()} == {k for k, p in want.items() if p <= 5}


def test_missing_all_last_ties_by_name_and_empty(spark):
    rows = [(1, "d", c, None, float("nan"), None, 9.0, T0, 0.0, "") for c in ("b", "a")] + [(1, "d", "z", 1.0, None, None, None, T0, 0.0, "")] * 3
    got = sorted(rank_fusion.ranking(spark.createDataFrame(rows, SCORES)).collect(), key=lambda r: r.position)
    assert [r.cut_id for r in got] == ["z", "a", "b"] and got[1].median_rank is None
    assert rank_fusion.best(spark.createDataFrame([], SCORES)).count() == 0


def test_weights(spark):
    rows = [(1, "d", "a", 5.0, 1.0, None, None, T0, 0.0, ""), (1, "d", "b", 1.0, 5.0, None, None, T0, 0.0, "")]
    out = rank_fusion.fused_ranks(spark.createDataFrame(rows, SCORES), weights={"utmos_t": 3.0, "dns_t": 1.0, "si_sdr_t": 1.0, "stoi_t": 1.0})
    assert min(out.collect(), key=lambda r: r.median_rank).cut_id == "a"


CLUSTERS = "dataset string, cut_id string, audio_cluster_id long, members int, _q string"
ASSIGN = "dataset string, cut_id string, recording_id string, quality_score float, gate_score float, duration_secs float, retention_reason string, is_kept boolean, run_no int, decided_at timestamp, audio_cluster_id long, score string"


def decision(cut, q=None, g=None, d=None, rec=None, reason=None, at=0, run=1):
    return ("d", cut, rec, q, g, d, reason, True, run, T0 + dt.timedelta(days=at), -5, "x")


def test_survivors(spark):
    clusters = [("d", c, 1, 9, "") for c in ("a", "b", "c")] * 3 + [("d", "e", 2, 9, ""), ("d", "f", None, 9, ""), ("d", "g", 3, 0, ""), ("d", "h", 3, 0, ""), ("d", "i", 4, 0, ""), ("d", "j", 4, 0, "")]
    assign = [decision("a", 9.0, at=0), decision("a", 1.0, at=1), decision("b", 2.0), decision("b", 2.0), decision("c", float("nan")), decision("g", 1.0, d=5.0), decision("h", 1.0, d=5.0, rec="r")]
    got = {r.audio_cluster_id: r.cut_id for r in survivors.survivors(spark.createDataFrame(clusters, CLUSTERS), spark.createDataFrame(assign, ASSIGN)).collect()}
    assert got == {1: "b", 3: "h", 4: "i"}  # a's later score counts; more fields win; undecided ones tie by name


def test_survivors_of_a_large_group_and_empty(spark):
    c = spark.createDataFrame([("d", str(i), 1, 0, "") for i in range(3000)], CLUSTERS)
    a = spark.createDataFrame([decision(str(i), i / 10) for i in range(3000)], ASSIGN)
    assert [r.cut_id for r in survivors.survivors(c, a).collect()] == ["2999"]
    assert survivors.survivors(c.limit(0), a.limit(0)).count() == 0
    assert survivors.merged(c.limit(0), a.limit(0)).count() == 0


def test_merged_takes_fields_from_whoever_has_them(spark):
    c = spark.createDataFrame([("d", "a", 1, 0, ""), ("d", "b", 1, 0, "")], CLUSTERS)
    a = spark.createDataFrame([decision("a", 2.0, rec=None), decision("b", float("nan"), g=1.5, rec="r")], ASSIGN)
    r = survivors.merged(c, a).first()
    assert (r.cut_id, r.best_recording_id, r.best_gate_score, r.best_quality_score) == ("a", "r", 1.5, 2.0)


def test_cutoffs_against_brute_force(spark):
    random.seed(5)
    rows, pct = [], {"d": 30, "x": 100, "y": 0}
    for i in range(3000):
        ds = "d" if random.random() < 0.7 else random.choice(["x", "y", "z", None])
        q = random.choice([None, float("nan"), -0.0, round(random.gauss(0, 1), 2)])
        rows.append((ds, f"c{i % 2000}", None, q, None, None, random.choice([None, "quality", "Quality-Dropped", "belowQualityGate dropped", "singleton"]), True, i, T0 + dt.timedelta(seconds=i), 0, "x"))
    last = {}
    for r in rows:
        last[r[0], r[1]] = r
    want = {}
    for ds, p in pct.items():
        some = {k: r[3] for k, r in last.items() if k[0] == ds and r[3] is not None and not math.isnan(r[3]) and not (r[6] or "").endswith("ropped")}
        need = max(1, -(-len(some) * p // 100))
        cut = sorted(some.values(), reverse=True)[need - 1]
        want |= {k: cut for k, v in some.items() if v >= cut}
    a = spark.createDataFrame(rows, ASSIGN)
    t = spark.createDataFrame([*pct.items(), ("none", 5), (None, 3), ("q", None)], "dataset string, keep_pct int")
    assert {tuple(r) for r in cutoffs.kept(a, t).collect()} == set(want)
    report = {r.dataset: (r.cutoff, r.kept) for r in cutoffs.cutoffs(a, t).collect()}
    assert {d: c for d, (c, _) in report.items()} == pytest.approx({k[0]: v for k, v in want.items()})


def test_brackets_repeat_until_small(spark):
    n = 5000
    rows = spark.range(n).selectExpr("'d' as dataset", "cast(pmod(id * 7919, 5000) div 3 as double) as score")
    need = spark.createDataFrame([("d", n, 1234)], "dataset string, n long, want long")
    got = cutoffs.select_at(rows, need, accuracy=20, at_once=10).first().cutoff
    assert got == sorted((i * 7919 % 5000 // 3 for i in range(n)), reverse=True)[1233]


def test_cutoffs_all_equal_and_empty(spark):
    a = spark.createDataFrame([decision(str(i), 1.0) for i in range(50)], ASSIGN)
    t = spark.createDataFrame([("d", 10)], "dataset string, keep_pct int")
    assert cutoffs.kept(a, t).count() == 50
    assert cutoffs.kept(a.limit(0), t).count() == 0 == cutoffs.kept(a, t.limit(0)).count()
