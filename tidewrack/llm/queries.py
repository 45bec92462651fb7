"""The queries of problems 1 to 6 and 8 to 10, and their SQL where SQL can express them."""

from __future__ import annotations

from tidewrack.llm import confusables, cutoffs, forest, linkage, mixing, mojibake, rank_fusion, survivors, tokens
from tidewrack.session import table, widened

_SCALED = " ".join(
    f"case when not isnan({c}) and {c} between {lo} and {hi} then {c} end as {c}," for c, (lo, hi) in rank_fusion.SCALES.items()
)
_LATEST_SCORES = f"""select * exclude (rn) from (select score_batch, dataset, cut_id, {_SCALED}
 row_number() over (partition by score_batch, dataset, cut_id order by scored_at desc nulls last) as rn from pending_batch) where rn = 1"""
_RANKS = f"""with items as ({_LATEST_SCORES}),
 long as (select score_batch, dataset, cut_id, m, v::double as v from items unpivot include nulls (v for m in (utmos_t, dns_t, si_sdr_t, stoi_t))),
 ranked as (select *, case when v is not null then (rank() over w + (count(*) over (partition by score_batch, m, v) - 1) / 2.0 - 0.5)
   / count(v) over (partition by score_batch, m) end as r from long window w as (partition by score_batch, m order by v desc nulls last)),
 fused as (select score_batch, dataset, cut_id, round(median(r), 12) as median_rank, round(avg(r), 12) as mean_rank from ranked group by all)"""
_ORDER = "order by median_rank nulls last, mean_rank nulls last, dataset, cut_id"
_DECIDED = "(select * exclude (rn) from (select *, row_number() over (partition by dataset, cut_id order by decided_at desc, run_no desc) as rn from assignments) where rn = 1)"
_MEMBERS = """(select *, count(*) over (partition by audio_cluster_id) as members from
 (select distinct audio_cluster_id, dataset, cut_id from clusters where audio_cluster_id is not null))"""
_SURVIVORS = f"""(select m.audio_cluster_id, m.dataset, m.cut_id, m.members, a.recording_id, a.quality_score, a.gate_score, a.duration_secs, a.retention_reason, a.is_kept, a.decided_at,
 row_number() over (partition by m.audio_cluster_id order by case when isnan(a.quality_score) then null else a.quality_score end desc nulls last,
 (a.gate_score is not null)::int + (a.duration_secs is not null)::int + (a.recording_id is not null)::int desc, a.duration_secs desc nulls last,
 a.decided_at desc nulls last, m.dataset, m.cut_id) as rn from {_MEMBERS} m left join {_DECIDED} a using (dataset, cut_id) where m.members >= 2)"""
_CANDIDATES = f"""(select dataset, cut_id, quality_score::double as score from {_DECIDED} where quality_score is not null and not isnan(quality_score)
 and (retention_reason is null or not regexp_replace(lower(retention_reason), '[^a-z]', '', 'g') in ('qualitydropped', 'belowqualitygatedropped', 'textclustercapdropped', 'longestfallbackdropped')))"""
_CUTOFFS = f"""(select c.dataset, t.keep_pct, c.n as candidates, max(c.score) as cutoff, arg_max(c.upto, c.score) as kept from
 (select *, count(*) over (partition by dataset order by score desc range between unbounded preceding and current row) as upto, count(*) over (partition by dataset) as n from {_CANDIDATES}) c
 join keep_targets t using (dataset) where c.upto * 100 >= c.n * t.keep_pct group by all)"""


def _texts(spark, sf, name, *columns):
    return widened(table(spark, sf, name).select(*columns))


def p1_found(spark, sf):
    return rank_fusion.best(table(spark, sf, "pending_batch"))


def p1_ranking(spark, sf):
    return rank_fusion.ranking(table(spark, sf, "pending_batch"))


def p2_found(spark, sf):
    rows = survivors.survivors(table(spark, sf, "clusters"), table(spark, sf, "assignments"))
    return rows.select("audio_cluster_id", "dataset", "cut_id")


def p2_survivors(spark, sf):
    return survivors.survivors(table(spark, sf, "clusters"), table(spark, sf, "assignments"))


def p2_merged(spark, sf):
    return survivors.merged(table(spark, sf, "clusters"), table(spark, sf, "assignments"))


def p3_found(spark, sf):
    return forest.repeated(_texts(spark, sf, "manifest", "line_no", "batch_no", "dataset", "cut_id", "text"))


def p4_found(spark, sf):
    return confusables.unusual(_texts(spark, sf, "manifest", "line_no", "text", "normalized_text"), "line_no", ["text", "normalized_text"])


def p4_forms(spark, sf):
    return confusables.unified(_texts(spark, sf, "manifest", "line_no", "text", "normalized_text"), "line_no", ["text", "normalized_text"])


def p4_look_alikes(spark, sf):
    return confusables.look_alikes(_texts(spark, sf, "manifest", "text", "normalized_text"), ["text", "normalized_text"])


def p5_found(spark, sf):
    return linkage.record_groups(table(spark, sf, "match_edges"))


def p6_found(spark, sf):
    return cutoffs.kept(table(spark, sf, "assignments"), table(spark, sf, "keep_targets"))


def p6_cutoffs(spark, sf):
    return cutoffs.cutoffs(table(spark, sf, "assignments"), table(spark, sf, "keep_targets"))


def p8_ids(spark, sf):
    return tokens.encoded(_texts(spark, sf, "documents", "doc_id", "text"))


def p9_found(spark, sf):
    return mixing.short_sources(_texts(spark, sf, "documents", "doc_id", "source", "text"), table(spark, sf, "mix_weights"))


def p9_shares(spark, sf):
    return mixing.report(spark, mixing.prepare(_texts(spark, sf, "documents", "doc_id", "source", "text"), table(spark, sf, "mix_weights")))


def p9_mixture(spark, sf):
    return mixing.mixture(_texts(spark, sf, "documents", "doc_id", "source", "text"), table(spark, sf, "mix_weights"))


def p10_found(spark, sf):
    return mojibake.garbled_documents(_texts(spark, sf, "documents", "doc_id", "text"))


def p10_restored(spark, sf):
    return mojibake.restored(_texts(spark, sf, "documents", "doc_id", "text"))


QUERIES = {
    "p1_found": p1_found,
    "p1_ranking": p1_ranking,
    "p2_found": p2_found,
    "p2_survivors": p2_survivors,
    "p2_merged": p2_merged,
    "p3_found": p3_found,
    "p4_found": p4_found,
    "p4_forms": p4_forms,
    "p4_look_alikes": p4_look_alikes,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p6_cutoffs": p6_cutoffs,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_shares": p9_shares,
    "p9_mixture": p9_mixture,
    "p10_found": p10_found,
    "p10_restored": p10_restored,
}

SQL = {
    "p1_found": f"{_RANKS} select score_batch, dataset, cut_id from fused qualify row_number() over (partition by score_batch {_ORDER}) <= 5",
    "p1_ranking": f"{_RANKS} select *, row_number() over (partition by score_batch {_ORDER}) as position from fused",
    "p2_found": f"select audio_cluster_id, dataset, cut_id from {_SURVIVORS} where rn = 1",
    "p2_survivors": f"select * exclude (rn) from {_SURVIVORS} where rn = 1",
    "p2_merged": f"""select s.audio_cluster_id, s.dataset, s.cut_id, s.members, f.* exclude (audio_cluster_id) from (select * from {_SURVIVORS} where rn = 1) s join (select audio_cluster_id,
 arg_max(recording_id, (n, decided_at, recording_id)) filter (recording_id is not null) as best_recording_id, {', '.join(f"arg_max({c}, (n, decided_at, {c})) filter (not isnan({c})) as best_{c}" for c in ("quality_score", "gate_score", "duration_secs"))}
 from (select m.audio_cluster_id, a.*, (a.gate_score is not null)::int + (a.duration_secs is not null)::int + (a.recording_id is not null)::int as n from {_MEMBERS} m left join {_DECIDED} a using (dataset, cut_id)) group by 1) f using (audio_cluster_id)""",
    "p5_found": """with recursive e as (select (src_dataset, src_cut_id) as a, (dst_dataset, dst_cut_id) as b from match_edges
 union select (dst_dataset, dst_cut_id), (src_dataset, src_cut_id) from match_edges),
 r as (select a, a as b from e union select r.a, e.b from r join e on r.b = e.a)
 select a[1] as dataset, a[2] as cut_id, g[1] as group_dataset, g[2] as group_cut_id from (select a, min(b) as g from r group by a)""",
    "p6_found": f"select c.dataset, c.cut_id from {_CANDIDATES} c join {_CUTOFFS} k using (dataset) where c.score >= k.cutoff",
    "p6_cutoffs": f"select * from {_CUTOFFS}",
}
