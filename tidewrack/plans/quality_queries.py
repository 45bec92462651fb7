"""Queries on quality scores and retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewrack.operators import quality as Q
from tidewrack.operators import retention as R
from tidewrack.session import stored, table

WEIGHTS = {"utmos": 0.3, "dnsmos": 0.4, "stoi": 0.2, "pesq": 0.1}
PREFERENCE, CAP, GATE, FLOOR = ["audiobook_en", "floor_en"], 20, 10.0, {"crowd_en": 2.0, "podcast_en": 2.2}
AX = Q.MOS_AXES


def _scores(spark, sf):
    return table(spark, sf, "pending_batch")


def _json(spark, sf):
    """The score table as nested JSON lines, so that the path through JSON is the one that files take."""
    c = {a: F.when(~F.isnan(col), F.col(col).cast("double")) for a, (col, _, _) in Q.AXES.items()}
    metrics = F.struct(
        F.struct(c["utmos"].alias("score")).alias("utmos"), F.struct(F.create_map(F.lit("nisqa"), c["dnsmos"]).alias("score")).alias("dnsmos"),
        F.struct(F.struct(c["stoi"].alias("stoi"), c["pesq"].alias("pesq"), c["si_sdr"].alias("si_sdr")).alias("score")).alias("squim"))
    return _scores(spark, sf).select(F.to_json(F.struct("cut_id", "dataset", metrics.alias("metrics"))).alias("value"), "scored_at")


def quality_flatten(spark, sf):
    flat = Q.flattened(Q.parsed(_json(spark, sf)))
    return flat.select("dataset", "cut_id", "scored_at", "utmos", F.col("dnsmos_nisqa").alias("dnsmos"), "si_sdr", "stoi", "pesq")


def quality_latest_wins(spark, sf):
    return Q.scored(_scores(spark, sf))


def quality_pivot(spark, sf):
    long = Q.scored(_scores(spark, sf)).unpivot(["dataset", "cut_id"], AX, "metric", "value").where("value is not null")
    return Q.pivoted(long, AX)


def axis_stats(spark, sf):
    one = Q.axis_stats(Q.scored(_scores(spark, sf)), AX)
    return one.select(*[F.round(c, 6).alias(c) for c in one.columns])


def _z(spark, sf):
    return Q.z_scores(stored(Q.scored(_scores(spark, sf)), "scores"), AX)


def z_scores(spark, sf):
    return _z(spark, sf).select("dataset", "cut_id", *[f"z_{a}" for a in AX])


def _all_scores(spark, sf):
    return Q.with_scores(_z(spark, sf), AX, WEIGHTS, 4)


def rank_gate_raw_scores(spark, sf):
    return _all_scores(spark, sf).select("dataset", "cut_id", "rank_score", "gate_score", "raw_score")


def gate_threshold(spark, sf):
    return Q.nearest_rank(_all_scores(spark, sf), "gate_score", GATE)


def gate_flags(spark, sf):
    rows = _all_scores(spark, sf).select("dataset", "cut_id", "gate_score", F.lit(True).alias("is_kept"), F.lit(1).alias("cluster_size"), F.lit("").alias("retention_reason"))
    return R.gated(stored(rows, "gate"), GATE, False).select("dataset", "cut_id", "gate_flagged")


def floor_percentiles(spark, sf):
    return Q.floor_percentiles(_all_scores(spark, sf))


def _records(spark, sf):
    """One row per record: latest delivery, audio and text group, scores and floor."""
    m = table(spark, sf, "manifest").where("dataset is not null and cut_id is not null")
    usable = F.when(F.isnan("duration_secs") | (F.col("duration_secs") <= 0), None).otherwise(F.col("duration_secs"))
    last = m.groupBy("dataset", "cut_id").agg(F.max(F.struct("batch_no", "line_no", usable.alias("d"), "recording_id")).alias("b"))
    last = last.select("dataset", "cut_id", "b.recording_id", F.coalesce("b.d", F.lit(0.0)).alias("duration_secs"))
    groups = table(spark, sf, "clusters").groupBy("dataset", "cut_id").agg(F.max("text_cluster_id").alias("t"), F.max("audio_cluster_id").alias("a"))
    floors = F.create_map(*[x for k, v in FLOOR.items() for x in (F.lit(k), F.lit(v))])
    scores = _all_scores(spark, sf).select("dataset", "cut_id", "rank_score", "gate_score", "raw_score")
    rows = last.join(groups, ["dataset", "cut_id"], "left").join(scores, ["dataset", "cut_id"], "left")
    return rows.select("dataset", "cut_id", "recording_id", "duration_secs", F.coalesce("t", F.lit(-1)).alias("text_cluster_id"), F.coalesce("a", F.lit(-1)).alias("audio_cluster_id"),
                       F.col("rank_score").alias("score"), "gate_score", "raw_score", floors[F.col("dataset")].alias("floor"))


def retention_assignments(spark, sf):
    out = R.decide(stored(_records(spark, sf), "records"), PREFERENCE, CAP, GATE, True)
    return out.select("dataset", "cut_id", "recording_id", "text_cluster_id", "audio_cluster_id", "cluster_size", "is_duplicate", "is_kept", "low_quality", "keep_reason", "retention_reason",
                      F.col("score").alias("quality_score"), "gate_score", "duration_secs")


def text_cluster_cap(spark, sf):
    a = table(spark, sf, "assignments").groupBy("dataset", "cut_id").agg(F.max(F.struct("decided_at", "run_no", "text_cluster_id", "quality_score", "duration_secs", "retention_reason")).alias("b"))
    q = F.when(~F.isnan("b.quality_score"), F.col("b.quality_score"))
    rows = a.select("dataset", "cut_id", F.coalesce("b.text_cluster_id", F.lit(-1)).alias("text_cluster_id"), q.alias("score"), F.coalesce("b.duration_secs", F.lit(0.0).cast("float")).alias("duration_secs"),
                    F.lit(True).alias("is_kept"), F.lit("kept").alias("retention_reason"))
    return R.capped(rows, 5, PREFERENCE).where("not is_kept").select("dataset", "cut_id")


def decisions_applied(spark, sf):
    """Manifest rows as JSON with the decision of their record nested under `custom`; rows without one pass unchanged."""
    m = table(spark, sf, "manifest").select("line_no", "dataset", "cut_id", "text", "normalized_text")
    a = table(spark, sf, "assignments").groupBy("dataset", "cut_id").agg(F.max(F.struct("decided_at", "run_no", "is_kept", "keep_reason")).alias("b"))
    text = F.coalesce(F.when(F.trim("text") != "", F.col("text")), F.col("normalized_text"))
    custom = F.when(F.col("b").isNotNull(), F.struct(F.struct("b.is_kept", "b.keep_reason").alias("dedup")))
    lines = m.join(a, ["dataset", "cut_id"], "left").select("line_no", F.to_json(F.struct(F.col("cut_id").alias("id"), text.alias("text"), custom.alias("custom"))).alias("json"))
    get = lambda p: F.get_json_object("json", f"$.{p}")
    return lines.select("line_no", get("id").alias("id"), F.md5(F.coalesce(get("text"), F.lit(""))).alias("content"), get("custom.dedup.is_kept").alias("is_kept"), get("custom.dedup.keep_reason").alias("keep_reason"))


def _ax(a):
    c, lo, hi = Q.AXES[a]
    v = f"{c}::double"
    return f"case when not isnan({v}) and {v} between {lo} and {hi} then {v} end"


_SC = f"(select dataset, cut_id, {', '.join(f'arg_max({_ax(a)}, (scored_at, score_batch, {_ax(a)})) filter ({_ax(a)} is not null) as {a}' for a in AX)} from pending_batch group by 1, 2)"
_ST = f"(select {', '.join(f'avg({a}) as mu_{a}, stddev_pop({a}) as sd_{a}' for a in AX)} from {_SC})"
_Z = f"(select dataset, cut_id, {', '.join(AX)}, {', '.join(f'round(case when {a} is not null then case when sd_{a} > 0 then ({a} - mu_{a}) / sd_{a} else 0.0 end end, 6) as z_{a}' for a in AX)} from {_SC}, {_ST})"
_L = f"list_filter([{', '.join(f'z_{a}' for a in AX)}], lambda x: x is not null)"
_USED = " or ".join(f"{a} is not null" for a in WEIGHTS)
_ALL = f"""(select dataset, cut_id, round(case when len(l) > 0 then list_sum(l) / len(l) end, 4) as rank_score, round(case when len(l) > 0 then 0.5 * list_sum(l) / len(l) + 0.5 * list_min(l) end, 4) as gate_score,
 round(case when {_USED} then {' + '.join(f'coalesce({a} * {w}, 0)' for a, w in WEIGHTS.items())} end, 4) as raw_score from (select *, {_L} as l from {_Z}))"""
_T = f"(select s[least(greatest(round_even({GATE / 100} * (len(s) - 1), 0), 0), len(s) - 1)::bigint + 1] as value from (select list_sort(list(gate_score)) as s from {_ALL} where gate_score is not null))"
_REC = f"""(select m.dataset, m.cut_id, m.recording_id, m.d as duration_secs, coalesce(g.t, -1) as text_cluster_id, coalesce(g.a, -1) as audio_cluster_id, s.rank_score as score, s.gate_score, s.raw_score,
 case m.dataset {' '.join(f"when '{k}' then {v}" for k, v in FLOOR.items())} end as floor, coalesce(nullif(list_position({PREFERENCE!r}, m.dataset), 0), {len(PREFERENCE) + 1}) as pref
 from (select dataset, cut_id, recording_id, coalesce(case when isnan(duration_secs) or duration_secs <= 0 then null else duration_secs end, 0) as d, row_number() over (partition by dataset, cut_id order by batch_no desc, line_no desc) as rn
 from manifest where dataset is not null and cut_id is not null) m left join (select dataset, cut_id, max(text_cluster_id) as t, max(audio_cluster_id) as a from clusters group by 1, 2) g using (dataset, cut_id)
 left join {_ALL} s using (dataset, cut_id) where m.rn = 1)"""

QUERIES = {f.__name__: f for f in (
    quality_flatten, quality_latest_wins, quality_pivot, axis_stats, z_scores, rank_gate_raw_scores, gate_threshold, gate_flags, floor_percentiles, retention_assignments, text_cluster_cap, decisions_applied)}

SQL = {
    "decisions_applied": """select line_no, m.cut_id as id, md5(coalesce(case when trim(text, ' ') <> '' then text else normalized_text end, '')) as content, a.is_kept::varchar as is_kept, a.keep_reason from manifest m left join
 (select dataset, cut_id, is_kept, keep_reason from assignments qualify row_number() over (partition by dataset, cut_id order by decided_at desc, run_no desc) = 1) a using (dataset, cut_id)""",
    "quality_flatten": "select dataset, cut_id, scored_at, " + ", ".join(f"case when not isnan({c}) then {c}::double end as {a}" for a, (c, _, _) in Q.AXES.items()) + " from pending_batch",
    "quality_latest_wins": f"select * from {_SC}",
    "quality_pivot": f"select * from {_SC} where coalesce({', '.join(AX)}) is not null",
    "axis_stats": "select " + ", ".join(f"round(mu_{a}, 6) as mu_{a}, round(sd_{a}, 6) as sd_{a}" for a in AX) + f" from {_ST}",
    "z_scores": "select dataset, cut_id, " + ", ".join(f"z_{a}" for a in AX) + f" from {_Z}",
    "rank_gate_raw_scores": f"select * from {_ALL}",
    "gate_threshold": f"select value from {_T}",
    "gate_flags": f"select dataset, cut_id, coalesce(gate_score < value, false) as gate_flagged from {_ALL}, {_T}",
    "floor_percentiles": "select dataset, count(*) as n, " + ", ".join(f"round(quantile_cont(raw_score, {p / 100}), 6) as p{p}" for p in (10, 25, 50, 75, 90)) + f" from {_ALL} where raw_score is not null group by 1",
    "retention_assignments": f"""with rec as materialized (select *, score is not null and (floor is null or score >= floor) as sure from {_REC}),
 a as (select *, count(*) over (partition by audio_cluster_id) as sz, count(*) filter (sure) over (partition by audio_cluster_id) as ns,
 row_number() over (partition by audio_cluster_id order by sure desc, case when sure then score end desc, case when sure then pref end, duration_secs desc, pref, dataset, cut_id) as r1 from rec),
 b as (select *, case when audio_cluster_id < 0 then 1 else sz end as cluster_size, audio_cluster_id < 0 or r1 = 1 as k1,
 case when audio_cluster_id < 0 then 'singleton' else (case when ns > 0 then 'quality' else 'longest_fallback' end) || case when r1 = 1 then '' else '_dropped' end end as w1 from a),
 c as (select *, row_number() over (partition by text_cluster_id, k1 order by score desc nulls last, pref, duration_secs desc, dataset, cut_id) as r2 from b),
 d as (select *, k1 and text_cluster_id >= 0 and r2 > {CAP} as over_cap from c),
 e as (select *, k1 and not over_cap as k2, case when over_cap then 'text_cluster_cap_dropped' else w1 end as w2, coalesce(gate_score < t.value, false) as gf from d,
 (select s[least(greatest(round_even({GATE / 100} * (len(s) - 1), 0), 0), len(s) - 1)::bigint + 1] as value from (select list_sort(list(gate_score)) as s from rec where gate_score is not null)) t),
 f as (select *, gf and k2 and cluster_size <= 1 as gone, coalesce(raw_score < floor, false) or gf as low_quality from e)
 select dataset, cut_id, recording_id, text_cluster_id, audio_cluster_id, cluster_size, cluster_size > 1 as is_duplicate, k2 and not gone as is_kept, low_quality,
 case when not (k2 and not gone) then case when gone then 'below_quality_gate_dropped' else w2 end when low_quality then 'low_quality' else 'kept' end as keep_reason,
 case when gone then 'below_quality_gate_dropped' else w2 end as retention_reason, score as quality_score, gate_score, duration_secs from f""",
    "text_cluster_cap": f"""select dataset, cut_id from (select *, row_number() over (partition by text_cluster_id order by case when isnan(quality_score) then null else quality_score end desc nulls last,
 coalesce(nullif(list_position({PREFERENCE!r}, dataset), 0), {len(PREFERENCE) + 1}), coalesce(duration_secs, 0) desc, dataset, cut_id) as r from
 (select *, row_number() over (partition by dataset, cut_id order by decided_at desc, run_no desc) as rn from assignments) where rn = 1 and text_cluster_id >= 0) where r > 5""",
}
