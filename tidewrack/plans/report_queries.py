"""Queries of joins, evaluation, reports, and the plain relational categories over the star schema."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewrack.functions import arrays as A
from tidewrack.functions import text as T
from tidewrack.functions.columns import in_range, usable
from tidewrack.operators import evaluation as V
from tidewrack.operators import joins as J
from tidewrack.operators.ordering import percentiles
from tidewrack.session import table


def _latest(spark, sf, *rest):
    """The named columns of each record's latest decision; no other column is read."""
    a = table(spark, sf, "assignments")
    b = a.groupBy("dataset", "cut_id").agg(F.max(F.struct("decided_at", "run_no", *rest)).alias("b"))
    return b.select("dataset", "cut_id", "b.*")


# joins


def exclude_removed(spark, sf):
    gone = _latest(spark, sf, "is_kept").where("not is_kept")
    return J.unmatched(table(spark, sf, "manifest").select("line_no", "dataset", "cut_id"), gone, ["dataset", "cut_id"])


def candidates_only(spark, sf):
    m = table(spark, sf, "manifest").where("tar_offset is not null")
    return m.join(table(spark, sf, "clusters").select("dataset", "cut_id").distinct(), ["dataset", "cut_id"], "left_semi").select("line_no", "tar_path", "tar_offset", "tar_size")


def key_uniqueness(spark, sf):
    return J.repeated_keys(table(spark, sf, "manifest"), ["dataset", "cut_id"])


def cross_dataset_overlap(spark, sf):
    m = table(spark, sf, "manifest")
    return m.groupBy("cut_id").agg(F.count_distinct("dataset").alias("datasets")).where("datasets >= 2")


def full_outer_slots(spark, sf):
    m = table(spark, sf, "manifest").groupBy("dataset", "cut_id").agg(F.max(F.struct("line_no", "language", "text")).alias("b")).select("dataset", "cut_id", F.col("b.language").alias("language"), "b.text")
    a = _latest(spark, sf, "keep_reason").select("dataset", "cut_id", F.lit(None).cast("string").alias("language"), F.col("keep_reason").alias("text"))
    c = table(spark, sf, "clusters").groupBy("dataset", "cut_id").agg(F.max("text_cluster_id").cast("string").alias("text")).withColumn("language", F.lit("xx"))
    out = J.full_outer_slots({"own": m, "decided": a, "cluster": c}, ["dataset", "cut_id"], ["language"])
    return out.select("dataset", "cut_id", "language", "has_own", "has_decided", "has_cluster", F.array_join(F.map_keys("hypotheses"), ",").alias("slots"))


def metadata_fallback_join(spark, sf):
    m = table(spark, sf, "manifest").where("tar_path is not null").select(F.col("line_no").alias("row_id"), "tar_path")
    known = m.select(F.substring_index("tar_path", "/", -1).alias("name"), F.col("row_id")).groupBy("name").agg(F.max("row_id").alias("value")).where("value % 2 = 0")
    return J.fallback_lookup(m, known, "tar_path", "name", "value", ".gz").select("row_id", "value", "matched_by")


def three_way_join(spark, sf):
    m = table(spark, sf, "manifest")
    meta = m.select("cut_id", F.col("line_no").alias("m_order"), "tar_path")
    lang = m.where("language is not null").select("cut_id", F.col("line_no").alias("l_order"), T.base_language(F.col("language")).alias("lang"))
    spans = m.where("num_samples > 0").select("cut_id", F.col("line_no").alias("s_order"), "num_samples")
    return J.three_way(meta, lang, spans, "cut_id")


def override_merge(spark, sf):
    m = table(spark, sf, "manifest")
    rows = m.select("line_no", "text", F.create_map(F.lit("lang"), F.coalesce("language", F.lit("")), F.lit("fmt"), F.coalesce("audio_format", F.lit(""))).alias("custom"),
                    F.when(F.col("line_no") % 3 == 0, F.col("normalized_text")).alias("new_text"), F.when(F.col("line_no") % 2 == 0, F.create_map(F.lit("fmt"), F.lit("new"))).alias("new_custom"))
    out = J.overridden(rows, "text", "custom", "new_text", "new_custom")
    return out.select("line_no", "text", F.col("custom")["lang"].alias("lang"), F.col("custom")["fmt"].alias("fmt"))


def exact_recording_dedup(spark, sf):
    """Deliveries equal in duration (to 3 places), samples and content keep their first one by file order."""
    m = table(spark, sf, "manifest").where("num_samples is not null")
    k = m.select("line_no", F.round("duration_secs", 3).alias("d"), "num_samples", F.md5(F.concat_ws("|", "dataset", "cut_id", "text")).alias("content"))
    return k.groupBy("d", "num_samples", "content").agg(F.min("line_no").alias("line_no"), F.count(F.lit(1)).alias("copies")).select("line_no", "copies")


def clean_against_degraded(spark, sf):
    """Each record of an audio group next to the group's best score."""
    c = table(spark, sf, "clusters").where("audio_cluster_id is not null").select("audio_cluster_id", "dataset", "cut_id").distinct()
    q = c.join(_latest(spark, sf, "quality_score").select("dataset", "cut_id", usable(F.col("quality_score")).alias("q")), ["dataset", "cut_id"], "left")
    top = q.groupBy("audio_cluster_id").agg(F.max("q").alias("best"))
    return q.join(top, "audio_cluster_id").select("audio_cluster_id", "dataset", "cut_id", F.round(F.col("best").cast("double") - F.col("q").cast("double"), 4).alias("behind"))


# evaluation


def _truth(spark, sf):
    e = table(spark, sf, "match_edges").where("match_kind = 'text'")
    item = lambda s: F.concat_ws("/", f"{s}_dataset", f"{s}_cut_id")
    return e.select(item("src").alias("item"), item("dst").alias("partner"), F.col("src_dataset").alias("family")).distinct()


def _clusters(spark, sf):
    c = table(spark, sf, "clusters")
    return c.groupBy(F.concat_ws("/", "dataset", "cut_id").alias("item")).agg(F.max(F.coalesce("text_cluster_id", F.lit(-1))).alias("cluster"))


def recall_by_family(spark, sf):
    return V.recall_by(_truth(spark, sf), _clusters(spark, sf), "family").select(F.coalesce("family", F.lit("OVERALL")).alias("family"), "total", "found", "recall")


def purity(spark, sf):
    c = table(spark, sf, "clusters").where("audio_cluster_id is not null").select("audio_cluster_id", "dataset", "cut_id").distinct()
    return V.purity(c.select(F.col("audio_cluster_id").alias("cluster"), F.col("dataset").alias("origin")))


def keepbest_contrast(spark, sf):
    rows = _latest(spark, sf, "audio_cluster_id", "is_kept", "quality_score").where("audio_cluster_id >= 0 and is_kept is not null")
    return V.keep_best_contrast(rows.select(F.col("audio_cluster_id").alias("cluster"), F.coalesce(usable(F.col("quality_score")) > 0, F.lit(False)).alias("good"), F.col("is_kept").alias("kept")))


def gate_prf(spark, sf):
    rows = _latest(spark, sf, "low_quality", "is_kept").where("low_quality is not null and is_kept is not null")
    return V.confusion(rows, ["dataset"], ~F.col("is_kept"), F.col("low_quality"))


def _labelled(spark, sf):
    q = usable(F.col("quality_score")).cast("double")
    return _latest(spark, sf, "quality_score", "gate_score", "duration_secs", "is_kept").select("dataset", q.alias("score"), usable(F.col("gate_score")).cast("double").alias("gate"), F.col("duration_secs").cast("double").alias("secs"), F.col("is_kept").alias("label"))


def auroc_by_group(spark, sf):
    return V.auroc(_labelled(spark, sf), ["dataset"], "score", "label")


def roc_points(spark, sf):
    return V.roc_points(_labelled(spark, sf), ["dataset"], "score", "label")


def pr_thresholds(spark, sf):
    return V.threshold_curve(_labelled(spark, sf).where("label is not null"), "score", "label", -3.0, 3.0, 200)


def recall_at_specificity(spark, sf):
    rows = _labelled(spark, sf).where("label is not null").withColumn("bad", ~F.col("label"))
    return V.recall_at_specificity(rows, "score", "bad", 0.9)


def pearson_matrix(spark, sf):
    return V.pearson(_labelled(spark, sf), ["score", "gate", "secs"], ["dataset"])


def spearman_by_dataset(spark, sf):
    return V.spearman(_labelled(spark, sf), ["dataset"], "score", "gate")


def outcome_rollup(spark, sf):
    rows = _latest(spark, sf, "duration_secs", "is_kept", "is_duplicate", "low_quality")
    hours = F.round(F.sum(F.coalesce(F.col("duration_secs").cast("double"), F.lit(0.0))) / 3600, 5).alias("hours")
    out = rows.rollup("dataset").agg(F.count(F.lit(1)).alias("cuts"), hours, F.count_if("is_kept").alias("kept"), F.count_if("is_duplicate").alias("duplicates"), F.count_if("low_quality").alias("low_quality"))
    return out.withColumn("dataset", F.coalesce("dataset", F.lit("ALL")))


def removed_by_reason(spark, sf):
    rows = _latest(spark, sf, "is_kept", "retention_reason", "duration_secs").where("not is_kept").withColumn("reason", F.regexp_replace(F.lower("retention_reason"), "[^a-z]", ""))
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("cuts"), F.round(F.sum(F.coalesce(F.col("duration_secs").cast("double"), F.lit(0.0))) / 3600, 5).alias("hours"))


def per_language_overview(spark, sf):
    m = table(spark, sf, "manifest").withColumn("lang", T.base_language(F.col("language")))
    return m.groupBy("lang").agg(F.count(F.lit(1)).alias("cuts"), F.count_distinct("recording_id").alias("recordings"), F.round(F.avg(F.length("text")), 5).alias("mean_chars"), F.count_if(F.col("text").isNull()).alias("no_text"))


def size_distribution(spark, sf):
    c = table(spark, sf, "clusters").where("text_cluster_id is not null").select("text_cluster_id", "dataset", "cut_id").distinct()
    return c.groupBy("text_cluster_id").agg(F.count(F.lit(1)).alias("size")).groupBy("size").agg(F.count(F.lit(1)).alias("clusters"))


def duration_stats(spark, sf):
    v = F.when(~F.isnan("duration_secs"), F.col("duration_secs"))
    m = table(spark, sf, "manifest").select("dataset", v.alias("d"))
    p = percentiles(m, "d", [50.0, 95.0], ["dataset"])
    mean = m.groupBy("dataset").agg(F.round(F.avg("d"), 6).alias("mean"))
    return mean.join(p, "dataset", "left").select("dataset", "mean", F.round(F.col("p")[0], 6).alias("median"), F.round(F.col("p")[1], 6).alias("p95"))


def duration_histogram(spark, sf):
    return V.histogram(table(spark, sf, "manifest"), "duration_secs", 0.0, 20.0, 20)


def quality_edges(spark, sf):
    return V.equal_frequency_edges(_labelled(spark, sf), "score", 8).select(F.array_join(F.transform("edges", lambda x: F.format_number(x, 4)), ";").alias("edges"))


def crosstab_lang_source(spark, sf):
    d = table(spark, sf, "documents").select(T.base_language(F.col("lang")).alias("lang"), "source")
    return d.groupBy("lang").pivot("source", ["audiobook_reader", "crowd_prompts", "floor_minutes", "podcast_feed"]).count().na.fill(0)


def min_cell_heatmap(spark, sf):
    p = table(spark, sf, "pending_batch").select(in_range(F.col("utmos_t").cast("double"), 1, 5).alias("u"), in_range(F.col("dns_t").cast("double"), 1, 5).alias("d"), in_range(F.col("stoi_t").cast("double"), 0, 1).alias("s")).where("u is not null and d is not null")
    return V.heatmap(p, F.floor("u"), F.floor("d"), "s", 20)


def clip_buckets(spark, sf):
    v = F.when(~F.isnan("duration_secs"), F.col("duration_secs"))
    return table(spark, sf, "manifest").select(F.least(F.floor(v / 2), F.lit(10)).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def dataset_sizes(spark, sf):
    m = table(spark, sf, "manifest")
    secs = F.when(~F.isnan("duration_secs"), F.col("duration_secs"))
    return m.rollup("dataset").agg(F.count(F.lit(1)).alias("cuts"), F.round(F.sum(secs) / 3600, 5).alias("hours"), F.count_distinct("tar_path").alias("shards")).withColumn("dataset", F.coalesce("dataset", F.lit("TOTAL")))


def benchmark_plan(spark, sf):
    return V.planned(table(spark, sf, "documents"), "doc_id", ["noise", "reverb", "clipping", "codec"], 7)


def vector_samples(spark, sf):
    e = F.col("embedding")
    v = table(spark, sf, "embeddings")
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    return v.select("vec_id", F.round(A.rms_db(e), 5).alias("rms_db"), F.round(A.peak(A.peak_normalised(e)), 6).alias("peak"), A.loud_enough(e).alias("loud"), A.not_silent(e).alias("sound"), F.size(A.cropped(e, 0.25, 0.5)).alias("cropped"),
                    F.round(F.array_max(A.hard_clipped(e, 0.5)), 6).alias("clipped"), F.round(total(A.gained(e, 6.0)), 4).alias("gained"), F.round(total(A.mixed_at_snr(e, F.reverse(e), 10.0)), 4).alias("mixed"))


# the relational categories


def lineitem_summary(spark, sf):
    line = table(spark, sf, "lineitem")
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return line.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(price), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count(F.lit(1)).alias("n"))


def revenue_by_nation(spark, sf):
    c, o, li, n, r = (table(spark, sf, t) for t in ("customer", "orders", "lineitem", "nation", "region"))
    rows = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("r_name", "n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


def semi_anti(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    keys = o.select(F.col("o_custkey").alias("c_custkey"))
    yes = c.join(keys, "c_custkey", "left_semi").select("c_custkey", F.lit("has").alias("kind"))
    return yes.union(c.join(keys, "c_custkey", "left_anti").select("c_custkey", F.lit("none").alias("kind")))


def set_ops(spark, sf):
    o, c = table(spark, sf, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf, "customer").select(F.col("c_custkey").alias("k"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"))
    return c.intersect(o).subtract(s).union(s.subtract(c))


def topk_per_group(spark, sf):
    w = Window.partitionBy("o_orderpriority").orderBy(F.col("o_totalprice").desc(), "o_orderkey")
    return table(spark, sf, "orders").withColumn("rn", F.row_number().over(w)).where("rn <= 5").select("o_orderpriority", "o_orderkey", "rn")


def top_texts(spark, sf):
    return table(spark, sf, "manifest").where("text is not null").groupBy("text").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "text").limit(5)


def rolling_mean(spark, sf):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(-2, 2)
    return table(spark, sf, "events").select("event_id", F.round(F.avg("value").over(w), 5).alias("mean5"))


def cube_orders(spark, sf):
    o = table(spark, sf, "orders")
    return o.cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid"))


def seeded_sample(spark, sf):
    """A sample of a tenth by the hash of the id: the feature is the sampling itself."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit("7-"), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("bigint")
    return table(spark, sf, "documents").where(h % 10 == 0).select("doc_id")


def json_props(spark, sf):
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf, "events").groupBy("event_type").agg(F.sum(k).alias("k"), F.count(k).alias("n"))


_LAST = "(select * exclude (rn) from (select *, row_number() over (partition by dataset, cut_id order by decided_at desc, run_no desc) as rn from assignments) where rn = 1)"
_LAB = f"(select dataset, case when not isnan(quality_score) then quality_score::double + 0.0 end as score, case when not isnan(gate_score) then gate_score::double end as gate, duration_secs::double as secs, is_kept as label from {_LAST})"
_ROC = f"""(select *, sum(p) over (partition by dataset order by score desc) as tp, sum(n - p) over (partition by dataset order by score desc) as fp, sum(p) over (partition by dataset) as pp, sum(n - p) over (partition by dataset) as qq
 from (select dataset, score, count(*) as n, count(*) filter (label) as p from {_LAB} where score is not null and label is not null group by 1, 2))"""
_TRUTH = "(select distinct src_dataset || '/' || src_cut_id as item, dst_dataset || '/' || dst_cut_id as partner, src_dataset as family from match_edges where match_kind = 'text')"
_CLU = "(select dataset || '/' || cut_id as item, max(coalesce(text_cluster_id, -1)) as cluster from clusters group by 1)"

QUERIES = {f.__name__: f for f in (
    exclude_removed, candidates_only, key_uniqueness, cross_dataset_overlap, full_outer_slots, metadata_fallback_join, three_way_join, override_merge, exact_recording_dedup, clean_against_degraded,
    recall_by_family, purity, keepbest_contrast, gate_prf, auroc_by_group, roc_points, pr_thresholds, recall_at_specificity, pearson_matrix, spearman_by_dataset, outcome_rollup, removed_by_reason,
    per_language_overview, size_distribution, duration_stats, duration_histogram, quality_edges, crosstab_lang_source, min_cell_heatmap, clip_buckets, dataset_sizes, benchmark_plan, vector_samples,
    lineitem_summary, revenue_by_nation, semi_anti, set_ops, topk_per_group, top_texts, rolling_mean, cube_orders, seeded_sample, json_props)}

_V = "list_transform(embedding, lambda x: x::double)"
_P = "list_max(list_transform(v, lambda x: abs(x)))"
SQL = {
    "benchmark_plan": """select doc_id, (['noise', 'reverb', 'clipping', 'codec'])[h % 4 + 1] as family, (floor(h / 4) + 1)::int as severity from (select doc_id, ('0x' || substr(md5('7-' || doc_id::varchar), 1, 8))::bigint % 12 as h from documents)""",
    "pr_thresholds": f"""with c as (select greatest(least(floor((score + 3.0) / (6.0 / 199) + 1e-9), 199), -1) as step, count(*) as n, count(*) filter (label) as p from {_LAB} where label is not null and score is not null group by 1),
 x as (select s as step, coalesce(n, 0) as n, coalesce(p, 0) as p from range(200) r(s) left join c on c.step = s), y as (select step, sum(n) over w as kept, sum(p) over w as tp from x window w as (order by step desc))
 select step, round(-3.0 + step * (6.0 / 199), 6) as threshold, kept::bigint as kept, round(tp / nullif(kept, 0), 6) as precision, round(tp / nullif((select sum(p) from c), 0), 6) as recall from y""",
    "recall_at_specificity": f"""with c as (select score, count(*) filter (not label) as p, count(*) filter (label) as q from {_LAB} where label is not null and score is not null group by 1), y as (select sum(p) over w as tp, sum(q) over w as fp, sum(p) over () as pp, sum(q) over () as qq from c window w as (order by score))
 select max(round(tp / nullif(pp, 0), 6)) as recall from y where round(fp / nullif(qq, 0), 6) <= 0.1 + 1e-9""",
    "quality_edges": f"select array_to_string(list_transform(list_sort(list_distinct(list_transform(quantile_cont(score, [0, 0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1]), lambda x: round(x, 6)))), lambda x: printf('%.4f', x)), ';') as edges from {_LAB} where score is not null",
    "vector_samples": f"""select vec_id, round(20 * log10(sqrt(list_sum(list_transform(v, lambda x: x * x)) / len(v)) + 1e-10), 5) as rms_db, round(case when {_P} > 0 then {_P} * (pow(10, -3.0 / 20) / greatest({_P}, 1e-10)) else {_P} end, 6) as peak,
 20 * log10(sqrt(list_sum(list_transform(v, lambda x: x * x)) / len(v)) + 1e-10) >= -50 as loud, len(list_filter(v, lambda x: x <> 0)) > 0 as sound, greatest(floor(len(v) * 0.5), 1)::int as cropped,
 round(list_max(list_transform(v, lambda x: greatest(least(x, 0.5 * {_P}), -0.5 * {_P}))), 6) as clipped, round(list_sum(list_transform(v, lambda x: greatest(least(x * pow(10, 6.0 / 20), 1.0), -1.0))), 4) as gained,
 round(list_sum(v) + list_sum(v) * sqrt((list_sum(list_transform(v, lambda x: x * x)) / len(v)) / greatest(list_sum(list_transform(v, lambda x: x * x)) / len(v) * 10, 1e-10)), 4) as mixed from (select vec_id, {_V} as v from embeddings)""",
    "exclude_removed": f"select line_no, dataset, cut_id from manifest m where not exists (select 1 from {_LAST} a where a.dataset = m.dataset and a.cut_id = m.cut_id and not a.is_kept)",
    "candidates_only": "select line_no, tar_path, tar_offset, tar_size from manifest m where tar_offset is not null and exists (select 1 from clusters c where c.dataset = m.dataset and c.cut_id = m.cut_id)",
    "key_uniqueness": "select dataset, cut_id, count(*) as n from manifest group by 1, 2 having count(*) > 1",
    "cross_dataset_overlap": "select cut_id, count(distinct dataset) as datasets from manifest group by 1 having count(distinct dataset) >= 2",
    "full_outer_slots": f"""with m as (select dataset, cut_id, arg_max(language, line_no) filter (true) as language, max(line_no) as l from manifest group by 1, 2), o as (select m.dataset, m.cut_id, x.language, x.text from m join manifest x on x.line_no = m.l),
 d as (select dataset, cut_id, keep_reason as text from {_LAST}), c as (select dataset, cut_id, max(text_cluster_id)::varchar as text from clusters group by 1, 2)
 select coalesce(o.dataset, d.dataset, c.dataset) as dataset, coalesce(o.cut_id, d.cut_id, c.cut_id) as cut_id, coalesce(o.language, case when c.cut_id is not null then 'xx' end) as language, o.cut_id is not null as has_own, d.cut_id is not null as has_decided, c.cut_id is not null as has_cluster,
 concat_ws(',', case when c.text is not null then 'cluster' end, case when d.text is not null then 'decided' end, case when o.text is not null then 'own' end) as slots from o full join d on o.dataset = d.dataset and o.cut_id = d.cut_id full join c on coalesce(o.dataset, d.dataset) = c.dataset and coalesce(o.cut_id, d.cut_id) = c.cut_id""",
    "metadata_fallback_join": """with m as (select line_no as row_id, tar_path, split_part(tar_path, '/', -1) as base from manifest where tar_path is not null), k as (select base as name, max(row_id) as value from m group by 1 having max(row_id) % 2 = 0),
 t as (select row_id, tar_path as n, 0 as p from m union all select row_id, base, 1 from m union all select row_id, tar_path || '.gz', 2 from m union all select row_id, base || '.gz', 3 from m), h as (select row_id, arg_min(value, p) as value, min(p) as matched_by from t join k on t.n = k.name group by 1)
 select m.row_id, h.value, h.matched_by from m left join h using (row_id)""",
    "three_way_join": """select cut_id, m_order, tar_path, l_order, lang, s_order, num_samples from (select cut_id, min(line_no) as m_order, arg_min(coalesce(tar_path, chr(0)), line_no) as tp from manifest group by 1) a join (select line_no as m_order, tar_path from manifest) using (m_order)
 join (select cut_id, max(line_no) as l_order, arg_max(lower(split_part(language, '-', 1)), line_no) as lang from manifest where language is not null group by 1) b using (cut_id) join (select cut_id, min(line_no) as s_order, arg_min(num_samples, line_no) as num_samples from manifest where num_samples > 0 group by 1) c using (cut_id)""",
    "override_merge": "select line_no, coalesce(case when line_no % 3 = 0 then normalized_text end, text) as text, coalesce(language, '') as lang, case when line_no % 2 = 0 then 'new' else coalesce(audio_format, '') end as fmt from manifest",
    "exact_recording_dedup": "select min(line_no) as line_no, count(*) as copies from (select line_no, round(duration_secs, 3) as d, num_samples, md5(concat_ws('|', dataset, cut_id, text)) as content from manifest where num_samples is not null) group by d, num_samples, content",
    "clean_against_degraded": f"""select audio_cluster_id, dataset, cut_id, round(max(q) over (partition by audio_cluster_id) - q, 4) as behind from (select distinct audio_cluster_id, dataset, cut_id from clusters where audio_cluster_id is not null) c
 left join (select dataset, cut_id, case when not isnan(quality_score) then quality_score::double end as q from {_LAST}) using (dataset, cut_id)""",
    "recall_by_family": f"""select coalesce(family, 'OVERALL') as family, count(*) as total, count(*) filter (a.cluster >= 0 and a.cluster = b.cluster) as found, round(count(*) filter (a.cluster >= 0 and a.cluster = b.cluster) / count(*), 6) as recall
 from {_TRUTH} t left join {_CLU} a on a.item = t.item left join {_CLU} b on b.item = t.partner group by rollup (family)""",
    "purity": "select count(*) as clusters, count(*) filter (o = 1) as pure, round(count(*) filter (o = 1) / count(*), 6) as purity from (select count(distinct dataset) as o from (select distinct audio_cluster_id, dataset, cut_id from clusters where audio_cluster_id is not null) group by audio_cluster_id having count(*) > 1)",
    "keepbest_contrast": f"""select count(*) as clusters, count(*) filter (ok) as "right", round(count(*) filter (ok) / count(*), 6) as accuracy from (select bool_or(g and is_kept) as ok from (select audio_cluster_id, coalesce(not isnan(quality_score) and quality_score > 0, false) as g, is_kept from {_LAST} where audio_cluster_id >= 0 and is_kept is not null)
 group by audio_cluster_id having bool_or(g) and bool_or(not g) and bool_or(is_kept))""",
    "gate_prf": f"""select dataset, tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 6) as precision, round(tp / nullif(tp + fn, 0), 6) as recall, round(2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0)) / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 6) as f1, round(fp / nullif(fp + tn, 0), 6) as fpr
 from (select dataset, count(*) filter (not is_kept and low_quality) as tp, count(*) filter (is_kept and low_quality) as fp, count(*) filter (not is_kept and not low_quality) as fn, count(*) filter (is_kept and not low_quality) as tn from {_LAST} where low_quality is not null and is_kept is not null group by 1)""",
    "auroc_by_group": f"""select dataset, count(*) filter (label) as positives, count(*) filter (not label) as negatives, round((sum(case when label then r end) - count(*) filter (label) * (count(*) filter (label) + 1) / 2) / nullif(count(*) filter (label) * count(*) filter (not label), 0), 6) as auroc
 from (select *, rank() over (partition by dataset order by score) + (count(*) over (partition by dataset, score) - 1) / 2 as r from {_LAB} where score is not null and label is not null) group by 1""",
    "roc_points": f"select dataset, score as threshold, round(tp / nullif(pp, 0), 6) as tpr, round(fp / nullif(qq, 0), 6) as fpr from {_ROC}",
    "outcome_rollup": f"select coalesce(dataset, 'ALL') as dataset, count(*) as cuts, round(sum(coalesce(duration_secs::double, 0)) / 3600, 5) as hours, count(*) filter (is_kept) as kept, count(*) filter (is_duplicate) as duplicates, count(*) filter (low_quality) as low_quality from {_LAST} group by rollup (dataset)",
    "removed_by_reason": f"select regexp_replace(lower(retention_reason), '[^a-z]', '', 'g') as reason, count(*) as cuts, round(sum(coalesce(duration_secs::double, 0)) / 3600, 5) as hours from {_LAST} where not is_kept group by 1",
    "per_language_overview": "select lower(split_part(language, '-', 1)) as lang, count(*) as cuts, count(distinct recording_id) as recordings, round(avg(length(text)), 5) as mean_chars, count(*) filter (text is null) as no_text from manifest group by 1",
    "size_distribution": "select size, count(*) as clusters from (select count(distinct (dataset, cut_id)) as size from clusters where text_cluster_id is not null group by text_cluster_id) group by 1",
    "duration_stats": "select dataset, round(avg(d), 6) as mean, round(quantile_cont(d, 0.5), 6) as median, round(quantile_cont(d, 0.95), 6) as p95 from (select dataset, case when not isnan(duration_secs) then duration_secs end as d from manifest) group by 1",
    "duration_histogram": "select bin, count(*) as n from (select case when d < 0 then 0 when d >= 20 then 21 else floor(d)::bigint + 1 end as bin from (select duration_secs as d from manifest where duration_secs is not null and not isnan(duration_secs))) group by 1",
    "crosstab_lang_source": "select lower(split_part(lang, '-', 1)) as lang, " + ", ".join(f"count(*) filter (source = '{s}') as {s}" for s in ("audiobook_reader", "crowd_prompts", "floor_minutes", "podcast_feed")) + " from documents group by 1",
    "min_cell_heatmap": """select x, y, count(s) as n, round(case when count(s) >= 20 then avg(s) end, 6) as mean from (select floor(utmos_t::double)::bigint as x, floor(dns_t::double)::bigint as y, case when not isnan(stoi_t) and stoi_t between 0 and 1 then stoi_t::double end as s from pending_batch
 where not isnan(utmos_t) and utmos_t between 1 and 5 and not isnan(dns_t) and dns_t between 1 and 5) group by 1, 2""",
    "clip_buckets": "select least(floor(case when not isnan(duration_secs) then duration_secs end / 2), 10)::bigint as bucket, count(*) as n from manifest group by 1",
    "dataset_sizes": "select coalesce(dataset, 'TOTAL') as dataset, count(*) as cuts, round(sum(case when not isnan(duration_secs) then duration_secs end) / 3600, 5) as hours, count(distinct tar_path) as shards from manifest group by rollup (dataset)",
    "spearman_by_dataset": f"""select dataset, count(*) as n, round(corr(ra, rb), 6) as rho from (select dataset, rank() over (partition by dataset order by score) + (count(*) over (partition by dataset, score) - 1) / 2 as ra, rank() over (partition by dataset order by gate) + (count(*) over (partition by dataset, gate) - 1) / 2 as rb
 from {_LAB} where score is not null and gate is not null) group by 1 having count(*) >= 5""",
    "pearson_matrix": " union all ".join(f"select dataset, '{a}' as x, '{b}' as y, round(corr({a}, {b}), 6) as r from {_LAB} group by 1" for a, b in (("score", "gate"), ("score", "secs"), ("gate", "secs"))),
    "lineitem_summary": "select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue, round(avg(l_discount), 6) as avg_disc, count(*) as n from lineitem group by 1, 2",
    "revenue_by_nation": """select r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) as revenue from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2""",
    "semi_anti": "select c_custkey, case when exists (select 1 from orders where o_custkey = c_custkey) then 'has' else 'none' end as kind from customer",
    "set_ops": "((select c_custkey as k from customer intersect select o_custkey from orders) except select s_suppkey from supplier) union all (select s_suppkey from supplier except select c_custkey from customer)",
    "topk_per_group": "select o_orderpriority, o_orderkey, rn from (select *, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as rn from orders) where rn <= 5",
    "top_texts": "select text, count(*) as n from manifest where text is not null group by text order by n desc, text limit 5",
    "rolling_mean": "select event_id, round(avg(value) over (partition by user_id order by ts, event_id rows between 2 preceding and 2 following), 5) as mean5 from events",
    "cube_orders": "select o_orderstatus, o_orderpriority, count(*) as n, grouping(o_orderstatus, o_orderpriority) as gid from orders group by cube (o_orderstatus, o_orderpriority)",
    "seeded_sample": "select doc_id from documents where ('0x' || substr(md5('7-' || doc_id::varchar), 1, 8))::bigint % 10 = 0",
    "json_props": "select event_type, sum(json_extract(props, '$.k')::bigint)::bigint as k, count(json_extract(props, '$.k')) as n from events group by 1",
}
