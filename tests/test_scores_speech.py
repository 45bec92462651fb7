import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewrack.operators import consensus as C
from tidewrack.operators import errorrate as E
from tidewrack.operators import fingerprint as P
from tidewrack.operators import quality as Q
from tidewrack.operators import retention as R
from tidewrack.operators import spans as S


def test_flatten_json(spark):
    box = {"CE": 1.5, "CU": 2.5, "PC": 8.0, "PQ": 5.0}
    full = {"cut_id": "./k/7", "dataset": "own", "metrics": {"audiobox": {"score": box}, "dnsmos": {"score": {"nisqa": 2.25}}, "utmos": {"score": 1.75}}, "rover": {"primary_fallbacks": 30}}
    short = {"cut_id": "q", "metrics": {"audiobox": {"score": {k: box[k] for k in ("CE", "PC")}}}}
    lines = spark.createDataFrame([(json.dumps(full),), (json.dumps(short),), ("{",), ("[1]",), (json.dumps({"dataset": "own"}),)], "value string")
    flat = Q.flattened(Q.parsed(lines))
    rows = {r.cut_id: r for r in flat.collect()}
    assert set(rows) == {"k/7", "q"} and (rows["k/7"].dataset, rows["q"].dataset) == ("own", "default")
    assert rows["k/7"].audiobox_OVL == pytest.approx((box["CE"] + box["CU"] + box["PQ"]) / 3) and rows["k/7"].audiobox_PC == box["PC"]
    assert rows["q"].audiobox_OVL is None and rows["q"].utmos is None  # the mean needs all three
    c = {r.cut_id: r for r in Q.components(flat).collect()}
    assert c["k/7"].rover == pytest.approx(math.exp(-3)) and c["q"].rover is None


def test_scores_are_those_of_the_z_values(spark):
    rng, axes = random.Random(12), ["utmos", "dnsmos", "stoi"]
    rows = [("d", str(i), *[None if rng.random() < 0.2 else rng.uniform(1, 5) for _ in axes]) for i in range(60)] + [("d", "none", None, None, None)]
    df = spark.createDataFrame(rows, "dataset string, cut_id string, " + ", ".join(f"{a} double" for a in axes))
    weights = {"utmos": 0.5, "stoi": 0.25}
    got = {r.cut_id: r for r in Q.with_scores(Q.z_scores(df, axes, 12), axes, weights).collect()}
    stats = []
    for k in range(2, 5):
        v = [r[k] for r in rows if r[k] is not None]
        mean = sum(v) / len(v)
        stats.append((mean, math.sqrt(sum((x - mean) ** 2 for x in v) / len(v))))
    for r in rows:
        z = [(x - m) / sd for x, (m, sd) in zip(r[2:], stats) if x is not None]
        g = got[r[1]]
        if not z:
            assert g.rank_score is None and g.gate_score is None and g.raw_score is None
            continue
        assert g.rank_score == pytest.approx(sum(z) / len(z), abs=1e-4)
        assert g.gate_score == pytest.approx((sum(z) / len(z) + min(z)) / 2, abs=1e-4)
        named = {a: x for a, x in zip(axes, r[2:]) if a in weights and x is not None}
        assert g.raw_score == (pytest.approx(sum(weights[a] * x for a, x in named.items()), abs=1e-4) if named else None)
    level = spark.createDataFrame([("d", "a", 2.5), ("d", "b", 2.5)], "dataset string, cut_id string, utmos double")
    assert [r.z_utmos for r in Q.z_scores(level, ["utmos"]).collect()] == [0.0, 0.0]  # an axis without spread says nothing


@pytest.mark.parametrize(("n", "p", "want"), [(5, 50, 2), (6, 50, 2), (4, 50, 2), (11, 10, 1), (1, 99, 0)])
def test_nearest_rank_rounds_half_to_even(spark, n, p, want):
    assert Q.nearest_rank(spark.range(n).withColumn("v", F.col("id").cast("double")), "v", p).first().value == want


def test_retention(spark):
    schema = "dataset string, cut_id string, text_cluster_id long, audio_cluster_id long, score double, floor double, duration_secs double, gate_score double, raw_score double"
    rows = [("x", "a", -1, 1, 0.0, None, 5.0, 1.0, 1.0), ("x", "b", -1, 1, -1.0, None, 9.0, 1.0, 1.0), ("x", "c", -1, 2, None, None, 1.0, None, None), ("y", "d", -1, 2, 0.1, 0.5, 3.0, 1.0, 0.2), ("x", "e", 7, -1, 0.5, None, 1.0, 0.5, 1.0), ("x", "f", 7, -1, None, None, 1.0, None, None), ("x", "g", 7, -1, 0.9, None, 1.0, -9.0, 1.0)]
    out = {r.cut_id: r for r in R.decide(spark.createDataFrame(rows, schema), ["y"], 2, 20.0, True).collect()}
    assert {k: r.retention_reason for k, r in out.items()} == {"a": "quality", "b": "quality_dropped", "c": "longest_fallback_dropped", "d": "longest_fallback", "e": "singleton", "f": "text_cluster_cap_dropped", "g": "below_quality_gate_dropped"}
    assert out["d"].keep_reason == "low_quality" or out["d"].floor == 0.5 and out["d"].low_quality
    assert out["a"].is_duplicate and not out["e"].is_duplicate


def test_runs_split_at_more_than_the_gap(spark):
    rows = [("s", 0.0, 45.0, 0), ("s", 10.0, 43.0, 1), ("s", 50.0, 51.0, 2), ("s", 56.0, 60.0, 3)]
    df = spark.createDataFrame(rows, "k string, s double, e double, i int")
    got = [(r.run, r.clip_num, r.universal_id) for r in sorted(S.runs_and_numbers(df, "k", "s", "e", ["i"], 6.0).collect(), key=lambda r: r.i)]
    assert got == [(0, 0, "s@000000"), (0, 1, "s@000001"), (1, 0, "s_R1@000000"), (1, 1, "s_R1@000001")]  # 50 - 43 is above 6, 56 - 51 is not


def test_packing_against_a_loop(spark):
    def fold(spans, gap, longest):
        done = []
        for a, b in spans:
            if done and a - done[-1][1] <= gap and b - done[-1][0] <= longest:
                done[-1] = (done[-1][0], b)
            else:
                done.append((a, b))
        return done

    rng, cases = random.Random(8), []
    for i in range(80):
        at, spans = 0.0, []
        for _ in range(rng.randrange(12)):
            at += rng.choice([0.0, 0.25, 1.0, 4.0])
            spans.append((at, at + rng.choice([0.25, 0.5, 3.0, 7.0, 31.0])))
            at = spans[-1][1] if rng.random() < 0.8 else at  # some lie in one another
        cases.append((i, sorted(spans)))
    df = spark.createDataFrame(cases, "i int, spans array<struct<start:double,end:double>>")
    for gap, longest, shortest in ((1.0, 16.0, 0.5), (0.0, 8.0, 0.0), (5.0, 30.0, 2.0)):
        got = {r.i: [tuple(c) for c in r.c] for r in df.select("i", S.packed(F.col("spans"), gap, longest, shortest).alias("c")).collect()}
        for i, spans in cases:
            once = fold([x for x in spans if x[1] - x[0] <= longest], gap, longest)
            assert got[i] == [x for x in fold(once, gap, longest) if x[1] - x[0] >= shortest]


def test_overlap_and_frames(spark):
    chunks = spark.createDataFrame([("a", 0, 0.0, 10.0), ("a", 1, 10.0, 20.0), ("b", 0, 0.0, 5.0)], "k string, chunk int, c_start double, c_end double")
    spans = spark.createDataFrame([("a", 8.0, 12.0), ("a", 1.0, 2.0), ("a", 15.0, 99.0)], "k string, s_start double, s_end double")
    assert {(r.k, r.chunk): r.seconds for r in S.overlap_seconds(chunks, spans, "k", 7).collect()} == {("a", 0): 3.0, ("a", 1): 7.0, ("b", 0): 0.0}
    frames = spark.createDataFrame([("a", i, 1.0 if i in (0, 1, 3, 10) else 0.0) for i in range(12)], "k string, f int, p double")
    assert [(r["first"], r["last"]) for r in S.frames_to_spans(frames, "k", "f", "p", 0.5, 2, 2).collect()] == [(0, 3)]


def test_edits_and_rates(spark):
    def slow(a, b):
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            p, d[0] = d[0], i
            for j, y in enumerate(b, 1):
                p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
        return d[-1]

    random.seed(0)
    for _ in range(300):
        a, b = ([random.choice("abc") for _ in range(random.randrange(90))] for _ in range(2))
        assert E.edits(a, b) == slow(a, b)
    df = spark.createDataFrame([("The cat, sat", "the cat sit"), ("", "x"), (None, None), ("Привет", "x")], "r string, h string")
    got = E.with_errors(df, "r", "h").collect()
    assert got[0].wer == pytest.approx(1 / 3) and got[0].cer == pytest.approx(1 / 11) and got[1].wer is None and got[2].cer is None and got[3].wer is None


SLOTS = {"own": 4.0, "p": 2.1, "q": 2.05, "r": 2.0}


def spoken(rng, n):
    return [rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) for _ in range(n)]


def test_alignment_costs_the_edit_distance():
    rng = random.Random(13)
    for _ in range(300):
        a, b = spoken(rng, rng.randrange(1, 30)), spoken(rng, rng.randrange(30))
        got = C.align(a, b)
        taken = [w for w in got if w is not None]
        rest = iter(b)
        assert len(got) == len(a) and all(w in rest for w in taken)  # in the order of b
        cost = sum(x != y for x, y in zip(a, got) if y is not None) + got.count(None) + len(b) - len(taken)
        assert cost == E.edits(a, b)


def test_votes_keep_to_the_contract():
    rng = random.Random(21)
    for _ in range(60):
        base = spoken(rng, rng.randrange(1, 9))
        texts = {s: " ".join(w if rng.random() > 0.3 else rng.choice(base) for w in base) for s in SLOTS}
        out = C.vote(texts, "own", SLOTS)["text"]
        assert out == C.vote(dict(sorted(texts.items(), reverse=True)), "own", SLOTS)["text"]  # the order of slots plays no part
        assert set(out.lower().split()) <= {w.lower() for t in texts.values() for w in t.split()}  # no word comes from nowhere
        same = " ".join(base)
        assert C.vote(dict.fromkeys(SLOTS, same), "own", SLOTS)["text"] == same
        # two that agree outweigh the own text where nobody stands by it, one does not
        other = " ".join("zeta" for _ in base)
        assert C.vote({"own": same, "p": other, "q": other, "r": other}, "own", SLOTS)["text"] == other
        assert C.vote({"own": same, "p": other, "q": same, "r": same}, "own", SLOTS)["text"] == same
        assert C.vote({"own": same.upper(), "p": same, "q": same, "r": same}, "own", SLOTS)["text"] == same.upper()  # case is the own one's


def test_majority_votes(spark):
    rng = random.Random(2)
    for _ in range(40):  # of equally long texts each place is decided for itself
        rows = [spoken(rng, 5) for _ in range(3)]
        want = []
        for place in zip(*rows):
            top = max(set(place), key=lambda w: (place.count(w), -place.index(w)))
            want.append(top)
        if all(len(set(p)) < 3 for p in zip(*rows)) and all(sum(a != b for a, b in zip(rows[0], r)) <= 1 for r in rows[1:]):
            assert C.vote(dict(zip("pqr", map(" ".join, rows))), "p", None)["text"].split() == want
    r = C.vote({"p": "north wind", "q": "north wing"}, "p", None)
    assert r["text"] == "north wind" and r["fallbacks"] == 1 and r["ambiguous"] == [{"position": 1, "primary": "wind", "default": "wind", "candidates": ["wind", "wing"]}]
    C.check_weights(SLOTS)
    with pytest.raises(ValueError):
        C.check_weights({"a": 3, "b": 5, "c": 8})
    df = spark.createDataFrame([("x y", "x y", None), (None, "single", ""), (None, None, " ")], "p string, q string, r string")
    assert [r.rover.text for r in C.consensus(df, ["p", "q", "r"], "p").collect()] == ["x y", "single", ""]


def test_signatures_against_a_search(spark):
    rng = random.Random(31)
    points = [(f"c{c}", t, rng.randrange(64), r) for c in range(6) for t in sorted(rng.sample(range(90), 12)) for r in range(rng.randrange(1, 3))]
    rows = P.signatures(spark.createDataFrame([*points, ("single", 3, 9, 0)], "clip string, t int, f int, r int")).collect()
    want = []
    for c, t, f, r in points:
        after = sorted(x for x in points if x[0] == c and P.NEAREST <= x[1] - t < P.FARTHEST)
        before = [x for x in points if x[0] == c and P.NEAREST <= t - x[1] < P.FARTHEST]
        if after and before:
            a, b = min(after, key=lambda x: (x[1], x[3])), max(before, key=lambda x: (x[1], x[3]))
            want.append((c, ((b[2] * 64 + f) * 64 + a[2]) * 256 + (t - b[1]) % 16 * 16 + (a[1] - t) % 16, t))
    assert sorted((r.clip, r.hash, r.t_hash) for r in rows if r.hash is not None) == sorted(want)
    totals = {r.clip: r.n_hashes_total for r in rows}
    assert all(totals[f"c{c}"] == sum(w[0] == f"c{c}" for w in want) for c in range(6))
    assert [(r.hash, r.t_hash, r.n_hashes_total) for r in rows if r.clip == "single"] == [(None, -1, 0)]


def test_packing_of_fields(spark):
    rng, widths = random.Random(5), list(P.FIELDS.values())
    rows = [tuple(rng.randrange(1 << b + 1) for b in widths) for _ in range(200)]  # half of them do not fit
    h = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in P.FIELDS)).select(P.packed(*[F.col(c) for c in P.FIELDS]).alias("h"))
    assert [tuple(r) for r in h.select(*P.unpacked(F.col("h"))).collect()] == [tuple(v % (1 << b) for v, b in zip(r, widths)) for r in rows]
    assert h.agg(F.max("h")).first()[0] < 1 << sum(widths)


def test_votes_of_offsets_against_counting(spark):
    rng = random.Random(17)
    post = [(c, rng.randrange(12), t) for c in range(8) for t in range(0, 40, 3)]
    post += [(c + 8, h, t + 7 * c) for c, h, t in post if c < 4]  # moved copies
    pairs = [(a, b) for a in range(12) for b in range(a + 1, 12)]
    p, q = spark.createDataFrame(post, "clip int, hash long, t_hash int"), spark.createDataFrame(pairs, "a int, b int")
    got, shared = {(r.a, r.b): r for r in P.hough(q, p).collect()}, {(r.a, r.b): r.shared for r in P.shared_hashes(q, p).collect()}
    for a, b in pairs:
        hits = [(ta - tb, ta, tb) for x, h, ta in post if x == a for y, g, tb in post if y == b and g == h]
        if not hits:
            assert (a, b) not in got
            continue
        votes = {d: [x for x in hits if x[0] == d] for d, _, _ in hits}
        d = max(votes, key=lambda k: (len(votes[k]), -k))
        span = lambda k: max(x[k] for x in votes[d]) - min(x[k] for x in votes[d]) + 1  # noqa: B023, E731
        assert tuple(got[a, b]) == (a, b, len(votes[d]), d, span(1), span(2))
        count = lambda c, h: sum(x == c and g == h for x, g, _ in post)
        assert shared[a, b] == sum(min(count(a, h), count(b, h)) for h in range(12))
    assert all(got[c, c + 8].delta == -7 * c for c in range(1, 4))


def test_clips_meet_in_groups_of_any_size(spark):
    n = 5100
    post = [(c, c * 10 + i, i) for c in range(n) for i in range(2)] + [(c, 7_000_000 + i, 5 + i + c // 1000) for c in (17, 2900) for i in range(6)]
    post += [(c, 9_000_000, 40 + c) for c in range(0, n, 100)] + [(n, None, -1)]  # a hash that many hold
    p = spark.createDataFrame(post, "clip int, hash long, t_hash int")
    members = spark.createDataFrame([("g", c) for c in range(n + 1)] + [("h", 17), ("h", 2900)], "grp string, clip int")
    got = {(r.a, r.b): r for r in P.group_hough(members, p).collect()}
    hot = list(range(0, n, 100))
    assert set(got) == {(a, b) for a in hot for b in hot if a < b} | {(17, 2900)}
    assert tuple(got[17, 2900]) == (17, 2900, 6, -2, 6, 6)
    assert {(r.a, r.b): r.shared for r in P.group_shared_hashes(members, p).collect()} == {k: 6 if k == (17, 2900) else 1 for k in got}
    clips = p.groupBy("clip").agg(F.count("hash").alias("n"), F.max("t_hash").alias("frames"))
    groups = P.match_groups(members, P.confirmed(P.group_hough(members, p), clips))
    assert {r.clip: (r.group, r.max_match_score) for r in groups.where("max_match_score > 0").collect()} == {17: (17, 6), 2900: (17, 6)}
    assert {(r.grp, r.clip): r.sub for r in P.subgroups(members, p, 100, 5).where("sub <> clip").collect()} == {("g", 2900): 17, ("h", 2900): 17}
    shards = P.meetings(members.where("grp = 'g'"), p.withColumnRenamed("t_hash", "v"), 4)
    assert shards.count() == shards.distinct().count() == len(hot) * (len(hot) - 1) // 2 + 6


def test_peaks_against_a_search(spark):
    rng = random.Random(9)
    cells = [("s", t, f, rng.choice([0.0, 0.1, 0.2, 0.9])) for t in range(30) for f in range(5)]
    df = spark.createDataFrame(cells, "clip string, t int, f int, energy double")
    e = {(t, f): x for _, t, f, x in cells}
    want = {(t, f) for (t, f), x in e.items() if x > 0 and x == max(e[u, f] for u in range(max(0, t - 2), min(29, t + 2) + 1))}
    assert {(r.t, r.f) for r in P.time_peaks(df, 4).collect()} == want
    mean = sum(e.values()) / len(e)
    assert {(r.t, r.f) for r in P.energy_gate(df, 1.5).collect()} == {k for k, x in e.items() if x > 1.5 * mean}
    assert P.time_peaks(df.withColumn("energy", F.lit(0.0)), 4).count() == 0


def test_runs_of_one_hot_source_spread_over_parts(spark):
    random.seed(4)
    rows, t = [], 0.0
    for i in range(2000):
        t += random.choice([0.5, 1.0, 9.0])
        rows.append(("hot" if i % 5 else "cold", t, t + random.choice([0.2, 3.0, 12.0]), i))
    df = spark.createDataFrame(rows, "k string, s double, e double, i int")
    want, merged = {}, []
    for k in ("hot", "cold"):
        run = n = 0
        last = top = None
        for _, s, e, i in sorted(r for r in rows if r[0] == k):
            if last is not None and s - last > 4:
                run, n = run + 1, 0
            want[i] = (run, n)
            last, n = e, n + 1
            if top is None or s > top + 4:
                merged.append([k, s, e])
            top = e if top is None else max(top, e)
            merged[-1][2] = max(merged[-1][2], e)
    assert {r.i: (r.run, r.clip_num) for r in S.runs_and_numbers(df, "k", "s", "e", ["i"], 4.0).collect()} == want
    assert sorted((r.k, r.start, r.end) for r in S.merged_rows(df, "k", "s", "e", 4.0).collect()) == sorted(map(tuple, merged))
    assert S.merged_rows(df.limit(0), "k", "s", "e", 4.0).count() == 0 == S.runs_and_numbers(df.limit(0), "k", "s", "e", ["i"], 4.0).count()
