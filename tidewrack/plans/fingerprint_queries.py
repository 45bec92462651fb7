"""Queries on fingerprints; the words of a text stand for its sounds: a word's hash for a band, its place for a frame."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewrack.functions.text import words
from tidewrack.operators import fingerprint as P
from tidewrack.session import stored, table


def _cells(spark, sf):
    """(clip, t, f, energy) of all documents: word number, 6 bits of its hash, its length."""
    d = table(spark, sf, "documents")
    w = d.select(F.col("doc_id").alias("clip"), F.posexplode(words(F.col("text"))).alias("t", "w"))
    return w.select("clip", "t", (F.conv(F.substring(F.md5("w"), 1, 4), 16, 10).cast("int") % 64).alias("f"), F.length("w").cast("double").alias("energy"))


def _points(spark, sf):
    return P.keypoints(_cells(spark, sf), 1)


def _signatures(spark, sf):
    return P.signatures(stored(_points(spark, sf), "points"))


def _deliveries(spark, sf):
    """(grp, clip): the lines of every record that was delivered more than once; and their signatures, ten frames a word."""
    m = table(spark, sf, "manifest").where("dataset is not null and cut_id is not null")
    again = m.groupBy("dataset", "cut_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    rows = stored(m.join(again, ["dataset", "cut_id"]).select(F.concat_ws("/", "dataset", "cut_id").alias("grp"), F.col("line_no").alias("clip"), "normalized_text"), "deliveries")
    w = rows.select("clip", F.posexplode(words(F.col("normalized_text"))).alias("t", "w"))
    cells = w.select("clip", (F.col("t") * 10).alias("t"), (F.conv(F.substring(F.md5("w"), 1, 4), 16, 10).cast("int") % 64).alias("f"), F.length("w").cast("double").alias("energy"))
    return rows.select("grp", "clip"), stored(P.signatures(stored(P.keypoints(cells, 1), "points")), "signatures")


def _members(spark, sf):
    """Documents by their recording."""
    d = table(spark, sf, "documents").where("recording_id is not null")
    return d.select(F.col("recording_id").alias("grp"), F.col("doc_id").alias("clip")).distinct()


def pack_hash(spark, sf):
    s = table(spark, sf, "events").select("event_id", *[(F.col("event_id") * (i + 3) % m).alias(n) for i, (n, m) in enumerate((("fb", 64), ("fk", 64), ("ff", 64), ("dtb", 20), ("dtf", 20)))])
    h = s.select("event_id", P.packed(*[F.col(c) for c in P.FIELDS]).alias("hash"))
    return h.select("event_id", "hash", *P.unpacked(F.col("hash")))


def energy_gates(spark, sf):
    c = _cells(spark, sf)
    return P.energy_gate(c, 1.5).join(P.energy_gate(c, 1.2, 9, 0.2), ["clip", "t", "f", "energy"]).groupBy("clip").agg(F.count(F.lit(1)).alias("n"))


def time_peaks(spark, sf):
    return P.top_bands(P.time_peaks(_cells(spark, sf), 8), 3).groupBy("clip").agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("t"))


def keypoints_topk(spark, sf):
    return P.keypoints(_cells(spark, sf), 2)


def triplet_signatures(spark, sf):
    return _signatures(spark, sf)


def hough_votes(spark, sf):
    return P.group_hough(_members(spark, sf), stored(_signatures(spark, sf), "signatures"))


def hough_tolerant(spark, sf):
    return P.group_hough(_members(spark, sf), stored(_signatures(spark, sf), "signatures"), 1)


def shared_hash_count(spark, sf):
    return P.group_shared_hashes(_members(spark, sf), stored(_signatures(spark, sf), "signatures"))


def _confirmed(members, s):
    frames = F.max(F.when(F.col("t_hash") >= 0, F.col("t_hash") + 1).otherwise(0)).alias("frames")
    clips = s.groupBy("clip").agg(F.max("n_hashes_total").alias("n"), frames)
    return P.confirmed(P.group_hough(members, s), clips)


def hough_confirmed(spark, sf):
    return _confirmed(*_deliveries(spark, sf))


def audio_clusters(spark, sf):
    members, s = _deliveries(spark, sf)
    out = P.match_groups(members, stored(_confirmed(members, s), "matches"))
    return out.withColumn("matched_span_secs", F.round("matched_span_secs", 4))


def recording_clusters(spark, sf):
    members, s = _members(spark, sf), stored(_signatures(spark, sf), "signatures")
    out = P.match_groups(members, stored(_confirmed(members, s), "matches"))
    return out.withColumn("matched_span_secs", F.round("matched_span_secs", 4))


def huge_groups(spark, sf):
    return P.large_groups(_members(spark, sf), 10)


def subgroups(spark, sf):
    return P.subgroups(_members(spark, sf), stored(_signatures(spark, sf), "signatures"), 3, 3)


def threshold_grid(spark, sf):
    e = table(spark, sf, "match_edges")
    rows = e.where("match_score is not null").select(F.col("match_score").alias("score"), (F.col("match_score") % 100 / 100).alias("ratio"), (F.col("src_dataset") == F.col("dst_dataset")).alias("is_match"))
    return P.threshold_grid(rows, [10, 100, 200, 300], [0.0, 0.25, 0.5])


_W = "list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r]+'), lambda w: w <> '')"
_C = f"(select clip, i - 1 as t, ('0x' || substr(md5(w[i]), 1, 4))::int % 64 as f, length(w[i])::double as energy from (select doc_id as clip, w, unnest(range(1, len(w) + 1)) as i from (select doc_id, {_W} as w from documents)))"


def _kp(k):
    return f"(select clip, bin as t, f, r from (select clip, floor(t * 0.3125)::int as bin, f, row_number() over (partition by clip, floor(t * 0.3125) order by energy desc, f, t) - 1 as r from {_C}) where r < {k})"


_SIG = f"""(with k as materialized (select * from {_kp(1)}), b as (select *, min((t, r, f)) over (partition by clip order by t range between 4 following and 19 following) as nx, max((t, r, f)) over (partition by clip order by t range between 19 preceding and 4 preceding) as pv from k),
 s as (select clip, ((pv[3] & 63)::bigint << 20) | ((f & 63)::bigint << 14) | ((nx[3] & 63)::bigint << 8) | (((t - pv[1]) & 15)::bigint << 4) | ((nx[1] - t) & 15)::bigint as hash, t as t_hash, count(*) over (partition by clip) as n from b where nx is not null and pv is not null)
 select c.clip, s.hash, coalesce(s.t_hash, -1) as t_hash, coalesce(s.n, 0)::int as n_hashes_total from (select distinct clip from k) c left join s on s.clip = c.clip)"""
_MEM = "(select distinct recording_id as grp, doc_id as clip from documents where recording_id is not null)"
_PAIR = f"(select distinct x.clip as a, y.clip as b from {_MEM} x join {_MEM} y on x.grp = y.grp and x.clip < y.clip)"
_V = """(with s as materialized (select * from {sig}), v as (select p.a, p.b, x.t_hash - y.t_hash as delta, count(*) as n, max(x.t_hash) - min(x.t_hash) + 1 as span_a, max(y.t_hash) - min(y.t_hash) + 1 as span_b from {pair} p join s x on x.clip = p.a join s y on y.clip = p.b and y.hash = x.hash group by 1, 2, 3),
 w as (select *, {score} as score from v) select a, b, max(score)::bigint as score, arg_max(delta, (score, -delta)) as delta, arg_max(span_a, (score, -delta)) as span_a, arg_max(span_b, (score, -delta)) as span_b from w group by a, b)"""
_VOTES = _V.format(sig=_SIG, pair=_PAIR, score="n")
_DMEM = """(select concat_ws('/', dataset, cut_id) as grp, line_no as clip, normalized_text from (select *, count(*) over (partition by dataset, cut_id) as c from manifest where dataset is not null and cut_id is not null) where c > 1)"""
_DPAIR = f"(select x.clip as a, y.clip as b from {_DMEM} x join {_DMEM} y on x.grp = y.grp and x.clip < y.clip)"
_DC = _C.replace("i - 1 as t", "(i - 1) * 10 as t").replace(f"(select doc_id as clip, w, unnest(range(1, len(w) + 1)) as i from (select doc_id, {_W} as w from documents))", f"(select clip, w, unnest(range(1, len(w) + 1)) as i from (select clip, {_W.replace('text', 'normalized_text')} as w from {_DMEM}))")
_DSIG = _SIG.replace(_C, _DC)
_CONFIRMED = """(with c as materialized (select clip, max(n_hashes_total) as n, max(case when t_hash >= 0 then t_hash + 1 else 0 end) as frames from {sig} group by 1) select v.* from {votes} v join c x on x.clip = v.a join c y on y.clip = v.b
 where least(x.n, y.n) >= 3 and v.score >= greatest(5, floor(least(x.n, y.n) * 0.1)) and (least(x.frames, y.frames) <= 0 or v.score / least(x.n, y.n) >= 0.5 or least(v.span_a, v.span_b) / least(x.frames, y.frames) >= 0.5))"""
_DCONF = _CONFIRMED.format(sig=_DSIG, votes=_V.format(sig=_DSIG, pair=_DPAIR, score="n"))
_MATCHED = """with recursive v as materialized (select * from {conf}), mem as materialized (select distinct clip from {mem}), e as (select a, b from v union select b, a from v), r as (select clip as a, clip as b from mem union select r.a, e.b from r join e on r.b = e.a),
 g as (select a as clip, min(b) as "group" from r group by a), s as (select clip, max(score)::int as m, max(span * 0.08) as span from (select a as clip, score, span_a as span from v union all select b, score, span_b from v) group by clip)
 select clip, "group", coalesce(m, 0) as max_match_score, round(coalesce(span, 0.0), 4)::double as matched_span_secs from g left join s using (clip)"""
_SHARED = f"(with c as materialized (select clip, hash, count(*) as c from {_SIG} where hash is not null group by 1, 2) select p.a, p.b, sum(least(x.c, y.c))::bigint as shared from {_PAIR} p join c x on x.clip = p.a join c y on y.clip = p.b and y.hash = x.hash group by 1, 2)"

QUERIES = {f.__name__: f for f in (
    pack_hash, energy_gates, time_peaks, keypoints_topk, triplet_signatures, hough_votes, hough_tolerant, shared_hash_count, hough_confirmed, audio_clusters, recording_clusters, huge_groups, subgroups, threshold_grid)}

SQL = {
    "pack_hash": """select event_id, hash, (hash >> 20 & 63)::int as fb, (hash >> 14 & 63)::int as fk, (hash >> 8 & 63)::int as ff, (hash >> 4 & 15)::int as dtb, (hash & 15)::int as dtf from (select event_id,
 ((event_id * 3 % 64 & 63) << 20) | ((event_id * 4 % 64 & 63) << 14) | ((event_id * 5 % 64 & 63) << 8) | ((event_id * 6 % 20 & 15) << 4) | (event_id * 7 % 20 & 15) as hash from events)""",
    "keypoints_topk": f"select * from {_kp(2)}",
    "time_peaks": f"""select clip, count(*) as n, sum(t)::bigint as t from (select *, rank() over (partition by clip, t order by energy desc) as r from (select * from (select *, max(energy) over (partition by clip, f order by t range between 4 preceding and 4 following) as m from {_C}) where energy = m and energy > 0)) where r <= 3 group by 1""",
    "triplet_signatures": f"select * from {_SIG}",
    "hough_votes": f"select * from {_VOTES}",
    "hough_tolerant": "select * from " + _V.format(sig=_SIG, pair=_PAIR, score="sum(n) over (partition by a, b order by delta range between 1 preceding and 1 following)"),
    "shared_hash_count": f"select * from {_SHARED}",
    "hough_confirmed": f"select * from {_DCONF}",
    "audio_clusters": _MATCHED.format(conf=_DCONF, mem=_DMEM),
    "recording_clusters": _MATCHED.format(conf=_CONFIRMED.format(sig=_SIG, votes=_VOTES), mem=_MEM),
    "subgroups": f"""with recursive m as materialized (select grp, clip, count(*) over (partition by grp) as n, min(clip) over (partition by grp) as first from {_MEM}), h as materialized (select x.grp, s.a, s.b from {_SHARED} s join m x on x.clip = s.a join m y on y.clip = s.b and y.grp = x.grp where s.shared >= 3 and x.n > 3),
 e as (select grp, a, b from h union select grp, b, a from h), r as (select grp, clip as a, clip as b from m where n > 3 union select r.grp, r.a, e.b from r join e on e.grp = r.grp and e.a = r.b)
 select grp, a as clip, min(b) as sub from r group by grp, a union all select grp, clip, first from m where n <= 3""",
    "energy_gates": f"""select clip, count(*) as n from (select c.*, avg(energy) over (partition by clip) as m, max(energy) over (partition by clip) as top, avg(energy) over (partition by clip, f order by t rows between 4 preceding and 4 following) as l from {_C} c)
 where energy > 1.5 * m and energy > 1.2 * l and energy > 0.2 * top group by clip""",
    "huge_groups": f"select grp, count(*) as n from {_MEM} group by 1 having count(*) > 10",
    "threshold_grid": """select s as min_score, r as span_ratio, tp, fp, fn, tn, round(p, 6) as precision, round(q, 6) as recall, round(2 * p * q / nullif(p + q, 0), 6) as f1 from (select *, tp / nullif(tp + fp, 0) as p, tp / nullif(tp + fn, 0) as q from
 (select s, r, count(*) filter (hit and m) as tp, count(*) filter (hit and not m) as fp, count(*) filter (not hit and m) as fn, count(*) filter (not hit and not m) as tn from
 (select s, r, match_score >= s and match_score % 100 / 100 >= r as hit, src_dataset = dst_dataset as m from match_edges, (values (10), (100), (200), (300)) a(s), (values (0.0), (0.25), (0.5)) b(r) where match_score is not null) group by 1, 2))""",
}
