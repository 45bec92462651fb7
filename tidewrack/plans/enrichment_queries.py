"""Queries on validation, enrichment joins, written-back decisions and the reports on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewrack.functions import text as T
from tidewrack.functions.columns import usable
from tidewrack.operators import enrichment as N
from tidewrack.operators import errorrate as E
from tidewrack.operators import evaluation as V
from tidewrack.operators import quality as Q
from tidewrack.operators import spans as S
from tidewrack.operators.components import connected_components
from tidewrack.plans.report_queries import _LAST, _latest
from tidewrack.plans.speech_queries import GAP, LONGEST, SHORTEST, SQL as SPEECH, WORD_EDITS, _by_day, _errors
from tidewrack.session import stored, table, widened

METRICS = ["quality_score", "gate_score", "duration_secs"]


def _m(spark, sf):
    return table(spark, sf, "manifest")


def min_rate_filter(spark, sf):
    rate = F.try_divide("num_samples", "duration_secs")
    return _m(spark, sf).where(N.fast_enough(rate, 16000)).select("line_no")


def record_contract(spark, sf):
    """Score rows as JSON records, some of which break the contract."""
    p = table(spark, sf, "pending_batch")
    whole = lambda c, k: F.coalesce(F.floor(usable(F.col(c)) * k).cast("string"), F.lit("null"))
    text = F.concat(F.lit('{"cut_id": '), F.when(F.col("cut_id").endswith("7"), F.lit('""')).otherwise(F.concat(F.lit('"'), "cut_id", F.lit('"'))), F.lit(', "duration": '), whole("audio_secs", 1), F.lit(', "rover": {"primary_fallbacks": '),
                    whole("utmos_t", 3), F.lit(', "voting": "'), F.when(F.col("score_batch") % 5 == 0, "best").otherwise("majority"), F.lit('"}, "vad": {"speech_pct": '), F.coalesce(F.floor(usable(F.col("stoi_t")) * 2.2).cast("string"), F.lit('"none"')), F.lit("}}"))
    return N.validated(p.select("score_batch", "cut_id", "scored_at", text.alias("value"))).groupBy("problem").agg(F.count(F.lit(1)).alias("n"))


def vad_short_circuit(spark, sf):
    p = table(spark, sf, "pending_batch").groupBy("dataset", "cut_id").agg(F.max(usable(F.col("stoi_t"))).cast("double").alias("speech_pct"))
    rows = _m(spark, sf).select("line_no", "dataset", "cut_id", "text").join(p, ["dataset", "cut_id"], "left")
    return N.short_circuited(rows, "speech_pct", "text", 0.5).select("line_no", "text", "vad_short_circuit", F.round("speech_pct", 5).alias("speech_pct"))


def language_precedence(spark, sf):
    m = _m(spark, sf)
    config = F.when(F.col("line_no") % 5 == 0, "de").when(F.col("line_no") % 5 == 1, " ")
    return m.select("line_no", N.language_hint(config, F.when(F.col("line_no") % 3 == 0, F.col("audio_format")), F.col("language")).alias("hint"))


def asr_with_source(spark, sf):
    out = _latest(spark, sf, "keep_reason", "retention_reason").select("dataset", "cut_id", F.when(F.col("keep_reason") == "kept", "  ").otherwise(F.col("keep_reason")).alias("ref_text"), F.col("retention_reason").alias("rover_text"))
    source = _m(spark, sf).select("dataset", "cut_id", "line_no", "text", F.create_map(F.lit("fmt"), "audio_format").alias("custom"))
    return N.with_source(out, source, ["dataset", "cut_id"], "line_no").select("dataset", "cut_id", "ref_text", "rover_text", F.col("custom")["fmt"].alias("fmt"))


def captions_joined(spark, sf):
    c = _latest(spark, sf, "keep_reason").select("dataset", "cut_id", F.when(F.length("cut_id") % 2 == 0, F.col("keep_reason")).otherwise("").alias("caption"))
    return N.captioned(_m(spark, sf).select("line_no", "dataset", "cut_id", "text"), c, ["dataset", "cut_id"]).select("line_no", "text", "patched")


def captions_by_field(spark, sf):
    m = _m(spark, sf).select("line_no", "text", F.create_map(F.lit("caption"), F.when(F.col("line_no") % 4 == 0, F.col("normalized_text"))).alias("custom"))
    return N.captioned(m, None, [], "caption").select("line_no", "text", "patched")


def folder_ingest(spark, sf):
    """Audio files by lower-cased stem beside detected speech: one row a chunk of every file whose rate is high enough or unknown."""
    days = _by_day(spark, sf)
    files = days.select("user_id").distinct().select(F.concat(F.lit("/audio/Rec_"), "user_id", F.lit(".FLAC")).alias("path"), F.when(F.col("user_id") % 7 == 0, 8000).when(F.col("user_id") % 11 != 0, 16000).alias("rate"))
    files = files.where(N.fast_enough(F.col("rate"), 16000)).withColumn("stem", F.lower(F.regexp_extract("path", r"([^/]+)\.[^./]*$", 1)))
    speech = days.select(F.concat(F.lit("rec_"), "user_id").alias("stem"), "day", "spans")
    rows = files.join(speech, "stem").select("stem", "day", F.posexplode(S.packed(F.col("spans"), GAP, LONGEST, SHORTEST)).alias("i", "c"))
    return rows.select(F.format_string("%s_%d@%06d", "stem", "day", "i").alias("cut_id"), "c.start", (F.col("c.end") - F.col("c.start")).alias("duration"))


def _applied(spark, sf):
    """Every line's nested record with the latest decision and the preferred transcript of its record."""
    m = _m(spark, sf).select("line_no", "dataset", "cut_id", "text", "normalized_text")
    fields = ["is_kept", "is_duplicate", "low_quality", "audio_cluster_id", "text_cluster_id", "cluster_size", "keep_reason", "retention_reason"]
    a = _latest(spark, sf, *fields, "quality_score").withColumn("quality_score", usable(F.col("quality_score")))
    p = table(spark, sf, "pending_batch").groupBy("dataset", "cut_id").agg(F.max(usable(F.col("pesq_t"))).alias("pesq")).select("dataset", "cut_id", F.struct("pesq").alias("metrics"))
    a = a.join(p, ["dataset", "cut_id"], "left").select("dataset", "cut_id", F.struct(*fields, "quality_score", "metrics").alias("d"))
    t = N.best_transcript(text_enhanced_itn=F.when(F.col("line_no") % 4 == 0, F.col("text")), text_enhanced=F.when(F.col("line_no") % 4 == 1, F.lit("  ")), text_itn=F.when(F.col("line_no") % 2 == 1, F.col("normalized_text")), text=F.col("text"))
    return m.join(a, ["dataset", "cut_id"], "left").withColumn("t", t).select("line_no", F.to_json(N.decision_record()).alias("custom"))


def decisions_written(spark, sf):
    """What a reader finds in the JSON written back."""
    get = lambda p: F.get_json_object("custom", f"$.{p}")
    return _applied(spark, sf).select("line_no", get("keep.is_kept").alias("is_kept"), get("keep.reason").alias("reason"), get("keep.detail").alias("detail"), get("dedup.cluster_size").alias("cluster_size"), get("dedup.is_duplicate").alias("is_duplicate"),
                                      (get("quality.score").cast("double") + F.lit(0.0)).alias("score"), get("quality.metrics.pesq").cast("double").alias("pesq"), get("asr_transcript.source").alias("source"), F.md5(F.coalesce(get("asr_transcript.text"), F.lit(""))).alias("content"))


def audio_recall(spark, sf):
    e = table(spark, sf, "match_edges").where("match_kind = 'audio'")
    item = lambda s: F.concat_ws("/", f"{s}_dataset", f"{s}_cut_id")
    truth = e.select(item("src").alias("item"), item("dst").alias("partner"), F.col("src_dataset").alias("family")).distinct()
    c = table(spark, sf, "clusters").groupBy(F.concat_ws("/", "dataset", "cut_id").alias("item")).agg(F.max(F.coalesce("audio_cluster_id", F.lit(-1))).alias("cluster"))
    return V.recall_by(truth, c, "family").select(F.coalesce("family", F.lit("OVERALL")).alias("family"), "total", "found", "recall")


def gate_populations(spark, sf):
    """The gate over all records, the acoustically single ones, each dataset, and the false alarms on clean originals."""
    rows = _latest(spark, sf, "low_quality", "is_kept", "is_duplicate").where("low_quality is not null and is_kept is not null and is_duplicate is not null")
    kinds = F.array(F.lit("all"), F.when(~F.col("is_duplicate"), "unique"), F.concat(F.lit("family:"), "dataset"), F.when(F.col("is_kept"), "clean"))
    each = rows.withColumn("population", F.explode(F.array_compact(kinds)))
    return V.confusion(each, ["population"], ~F.col("is_kept"), F.col("low_quality"))


def reduction_funnel(spark, sf):
    return N.funnel(_latest(spark, sf, "duration_secs", "is_kept", "is_duplicate").where("is_kept is not null and is_duplicate is not null"))


def change_rates(spark, sf):
    e = _errors(spark, sf)
    out = e.groupBy("dataset").agg(F.sum("word_edits").alias("edits"), F.sum("words").alias("words"), F.count_if(F.col("word_edits") > 0).alias("changed"), F.count(F.lit(1)).alias("cuts"))
    return out.withColumn("word_change", F.round(F.col("edits") / F.greatest(F.col("words"), F.lit(1)), 6))


def metric_coverage(spark, sf):
    rows = _latest(spark, sf, *METRICS, "is_kept").select("dataset", "is_kept", *[usable(F.col(c)).cast("double").alias(c) for c in METRICS])
    degraded = rows.where("not is_kept").select(F.col("dataset").alias("family"), *METRICS)
    return N.coverage(rows.where("is_kept").select(*METRICS), degraded, METRICS)


def severity_coverage(spark, sf):
    rows = _latest(spark, sf, *METRICS, "is_kept").select("is_kept", *[usable(F.col(c)).cast("double").alias(c) for c in METRICS])
    degraded = rows.where("not is_kept").select(F.coalesce(F.least(F.floor(F.col("duration_secs") / 4), F.lit(5)), F.lit(-1)).cast("string").alias("family"), *METRICS)
    return N.coverage(rows.where("is_kept").select(*METRICS), degraded, ["quality_score", "gate_score"])


def _copies(spark, sf):
    """Members of audio groups with their scores on z scales, and which one of each group is the clean reference."""
    z = Q.z_scores(stored(Q.scored(table(spark, sf, "pending_batch")), "scores"), Q.MOS_AXES)
    c = table(spark, sf, "clusters").where("audio_cluster_id is not null").select("audio_cluster_id", "dataset", "cut_id").distinct()
    return c.join(z, ["dataset", "cut_id"]).withColumn("item", F.concat_ws("/", "dataset", "cut_id"))


SCHEMES = {"dnsmos": ["z_dnsmos"], "mean": ["z_utmos", "z_dnsmos", "z_si_sdr", "z_stoi", "z_pesq"], "two": ["z_dnsmos", "z_si_sdr"]}


def _score(zs, prefix=""):
    return F.round(sum(F.coalesce(F.col(prefix + z), F.lit(0.0)) for z in zs) / len(zs), 6)


def combiner_accuracy(spark, sf):
    """Each copy against the clean reference of its group, which is the smallest record of it."""
    rows = stored(_copies(spark, sf), "copies")
    ref = rows.groupBy("audio_cluster_id").agg(F.min("item").alias("clean_ref_id"))
    clean = rows.select("audio_cluster_id", F.col("item").alias("clean_ref_id"), *[F.col(f"z_{a}").alias(f"r_z_{a}") for a in Q.MOS_AXES])
    pairs = rows.join(ref, "audio_cluster_id").where("item <> clean_ref_id").join(clean, ["audio_cluster_id", "clean_ref_id"])
    return N.pairwise_accuracy(pairs, {n: (_score(z, "r_"), _score(z)) for n, z in SCHEMES.items()})


def family_top1(spark, sf):
    rows = _copies(spark, sf).withColumn("low", F.coalesce(F.col("z_utmos") < -1, F.lit(False))).withColumn("clean", F.coalesce(F.col("z_pesq") > 0, F.lit(False)))
    return N.top_of_families(rows.select(F.col("audio_cluster_id").alias("family"), "item", "low", "clean", *[_score(z).alias(n) for n, z in SCHEMES.items()]), list(SCHEMES))


def vote_features(spark, sf):
    d = table(spark, sf, "documents")
    up, down = F.col("n_turns") % 5, F.col("n_chars") % 4
    return d.select("doc_id", *N.votes(up, down)).withColumn("vote_ratio", F.round("vote_ratio", 6))


def rover_flat(spark, sf):
    """Transcript records read from JSON, as flat columns."""
    m = _m(spark, sf)
    rover = F.struct(F.col("text"), F.col("normalized_text").alias("text_enhanced"), (F.col("line_no") % 4).alias("primary_fallbacks"), F.when(F.col("line_no") % 3 == 0, F.array(F.lit("a"), F.lit("b"))).alias("ambiguous_words_enhanced"))
    whole = F.struct("line_no", "cut_id", "dataset", F.col("language").alias("language_hint"), F.col("text").alias("ref_text"), rover.alias("rover"), F.struct((F.col("line_no") % 2 == 0).alias("all_consistent")).alias("language_consistency"),
                     F.create_map(F.lit("first"), F.struct(F.col("text")), F.lit("second"), F.struct(F.col("normalized_text").alias("text"))).alias("hypotheses"))
    kind = """line_no bigint, cut_id string, dataset string, language_hint string, ref_text string, filtered_reason string, rover struct<text:string,text_enhanced:string,text_enhanced_itn:string,primary_fallbacks:bigint,ambiguous_words_enhanced:array<string>>,
 language_consistency struct<all_consistent:boolean>, hypotheses map<string,struct<text:string>>"""
    r = m.select(F.from_json(F.to_json(whole), kind).alias("r"))
    return r.select("r.line_no", *N.flat_rover(F.col("r"), ["first", "second"]))


def leveled_dedup(spark, sf):
    m = _m(spark, sf).where("num_samples is not null")
    k = m.select("line_no", F.coalesce("dataset", F.lit("")).alias("dataset"), F.coalesce(T.base_language(F.col("language")), F.lit("")).alias("lang"), F.round("duration_secs", 3).alias("d"), "num_samples", F.md5(F.coalesce("normalized_text", F.lit(""))).alias("content"))
    return N.first_copies(k, ["d", "num_samples", "content"], "line_no", "dataset", "lang")


def marked_confidences(spark, sf):
    """Words as tokens, their length as the loss, between markers put before the third and fifth."""
    d = _m(spark, sf).select("line_no", T.words(F.col("text")).alias("w"))
    tok = lambda w: F.transform(w, lambda x: F.struct(x.alias("token"), (-F.length(x) / 10).alias("logprob")))
    mark = lambda s: F.array(F.struct(F.lit(s).alias("token"), F.lit(-9.0).alias("logprob")))
    n = F.size("w")
    whole = F.when(n >= 5, F.concat(tok(F.slice("w", 1, 2)), mark("<b>"), tok(F.slice("w", 3, 2)), mark("<e>"), tok(F.slice("w", 5, F.greatest(n - 4, F.lit(1)))))).otherwise(tok(F.col("w")))
    return d.select("line_no", F.round(N.marked_confidence(whole, "<b>", "<e>"), 6).alias("confidence"))


def rewrite_leaks(spark, sf):
    """Rewrites that repeat an example phrase fall back to the original, unless that has the phrase itself."""
    m = _m(spark, sf).where("text is not null")
    new = F.when(F.col("line_no") % 3 == 0, F.concat("text", F.lit(" thank you"))).otherwise(F.col("normalized_text"))
    return m.select("line_no", T.valid_rewrite(F.col("text"), F.coalesce(new, F.lit("")), examples=("thank you", "good morning")).alias("text"))


def threshold_table(spark, sf):
    """Clusters, records in them and the largest one for each threshold on the similarity of text matches."""
    e = table(spark, sf, "match_edges").where("match_kind = 'text'")
    item = lambda s: F.concat_ws("/", f"{s}_dataset", f"{s}_cut_id")
    at = F.explode(F.filter(F.array(F.lit(0.7), F.lit(0.8), F.lit(0.9)), lambda t: F.col("jaccard") >= t))
    ends = e.select(item("src").alias("a"), item("dst").alias("b"), at.alias("t")).where("a <> b").select(F.struct("t", F.col("a").alias("x")).alias("a"), F.struct("t", F.col("b").alias("x")).alias("b"))
    sizes = connected_components(ends).groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    return sizes.groupBy(F.col("root.t").alias("threshold")).agg(F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("records"), F.max("n").alias("largest"))


def speech_shares(spark, sf):
    """Share of a user's frames, from the first to the last, that are speech after closing gaps and dropping short stretches."""
    f = table(spark, sf, "events").select("user_id", F.hour("ts").alias("hour"), F.dayofyear("ts").alias("d"))
    frames = f.groupBy("user_id", (F.col("d") * 24 + F.col("hour")).alias("frame")).agg(F.least(F.count(F.lit(1)) / 2, F.lit(1.0)).alias("p"))
    runs = S.frames_to_spans(frames, "user_id", "frame", "p", 0.5, 3, 2).groupBy("user_id").agg(F.sum(F.col("last") - F.col("first") + 1).alias("speech"))
    all_ = frames.groupBy("user_id").agg((F.max("frame") - F.min("frame") + 1).alias("frames"))
    return all_.join(runs, "user_id", "left").select("user_id", F.round(F.coalesce("speech", F.lit(0)) / F.col("frames"), 6).alias("speech_pct"))


def component_map(spark, sf):
    rows = Q.scored(table(spark, sf, "pending_batch")).withColumnRenamed("dnsmos", "dnsmos_nisqa").withColumns({
        "audiobox_OVL": F.lit(None).cast("double"), "rover_primary_fallbacks": F.floor("pesq").cast("bigint"), "language_consistency": (F.col("stoi") > 0.8).cast("double")})
    out = Q.components(rows)
    return out.select("dataset", "cut_id", *[F.round(c, 6).alias(c) for c in Q.axes_for("both")], "language_penalty")


def sample_moments(spark, sf):
    v = usable(F.col("duration_secs"))
    return _m(spark, sf).groupBy("dataset").agg(F.count(v).alias("n"), F.round(F.stddev_samp(v), 6).alias("sd"), F.round(F.var_samp(v), 5).alias("var"))


def per_bin_sample(spark, sf):
    """Up to three records of every duration bin, by a seeded hash: the feature is the sampling itself."""
    from tidewrack.operators.ordering import top_per_group

    m = _m(spark, sf).where("duration_secs is not null and not isnan(duration_secs)").select("line_no", F.least(F.floor(F.col("duration_secs") / 2), F.lit(10)).alias("bin"), F.md5(F.concat(F.lit("11-"), F.col("line_no").cast("string"))).alias("h"))
    return top_per_group(m, ["bin"], [F.col("h")], 3).select("bin", "line_no")


def random_cluster(spark, sf):
    """The records of one cluster, drawn by a seeded hash."""
    c = table(spark, sf, "clusters").where("text_cluster_id is not null")
    one = c.select("text_cluster_id").distinct().orderBy(F.md5(F.concat(F.lit("5-"), F.col("text_cluster_id").cast("string")))).limit(1)
    return c.join(F.broadcast(one), "text_cluster_id").select("text_cluster_id", "dataset", "cut_id").distinct()  # one row


def delivery_times(spark, sf):
    t = F.col("delivered_at").cast("timestamp")
    return _m(spark, sf).select("line_no", F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), F.unix_timestamp(t).alias("seconds"), F.to_date(t).cast("string").alias("day"))


def seeded_edits(spark, sf):
    """Texts with about a tenth of their words dropped, by a seeded hash of the line, the place and the word."""
    w = T.words(F.col("text"))
    kept = F.filter(w, lambda x, i: F.conv(F.substring(F.md5(F.concat_ws("-", F.lit("3"), F.col("line_no").cast("string"), i.cast("string"), x)), 1, 4), 16, 10).cast("int") % 10 != 0)
    return _m(spark, sf).select("line_no", F.array_join(kept, " ").alias("text"))


def run_counters(spark, sf):
    """Counters that are observed while a table is written, as one row."""
    from pyspark.sql import Observation

    seen = Observation("assembly")
    rows = _latest(spark, sf, "is_kept", "is_duplicate", "low_quality").observe(seen, F.count(F.lit(1)).alias("records"), F.count_if("is_kept").alias("kept"), F.count_if("is_duplicate").alias("duplicates"), F.count_if("low_quality").alias("low_quality"))
    stored(rows, "assignments")
    got = seen.get
    return spark.createDataFrame([tuple(int(got[k]) for k in ("records", "kept", "duplicates", "low_quality"))], "records bigint, kept bigint, duplicates bigint, low_quality bigint")


def wer_change_kinds(spark, sf):
    """Kinds of change over all lines, with the share of words edited in each."""
    e = E.with_errors(widened(_m(spark, sf).where("text is not null").select("line_no", "text", "normalized_text")), "text", "normalized_text")
    return e.groupBy(E.change_kind(F.col("text"), F.col("normalized_text")).alias("kind")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("word_edits") / F.greatest(F.sum("words"), F.lit(1)), 6).alias("edit_rate"))


_ITEM = "{0}_dataset || '/' || {0}_cut_id"
_RATES = "round(tp / nullif(tp + fp, 0), 6) as precision, round(tp / nullif(tp + fn, 0), 6) as recall, round(2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0)) / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 6) as f1, round(fp / nullif(fp + tn, 0), 6) as fpr"
_HOURS = "round(coalesce(sum(coalesce(duration_secs::double, 0)) filter ({}), 0) / 3600, 5)"
_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\r]+'), lambda w: w <> '')"


def _coverage_sql(family, metrics):
    clean = " union all ".join(f"select f.family, '{c}' as metric, {c} as v, true as clean from l, f where is_kept" for c in metrics)
    bad = " union all ".join(f"select {family} as family, '{c}', {c}, false from l where not is_kept" for c in metrics)
    return f"""with l as (select dataset, is_kept, {', '.join(f'case when not isnan({c}) then {c}::double end as {c}' for c in METRICS)} from {_LAST}), f as (select distinct {family} as family from l where not is_kept),
 x as ({clean} union all {bad}), r as (select *, rank() over (partition by family, metric order by v) + (count(*) over (partition by family, metric, v) - 1) / 2 as r from x where v is not null),
 a as (select family, metric, count(*) filter (clean) as positives, count(*) filter (not clean) as negatives, round((sum(r) filter (clean) - count(*) filter (clean) * (count(*) filter (clean) + 1) / 2) / nullif(count(*) filter (clean) * count(*) filter (not clean), 0), 6) as auroc from r group by 1, 2)
 select *, case when auroc >= 0.8 then 'catch' when auroc < 0.65 then 'miss' end as verdict from a"""


from tidewrack.plans.quality_queries import _Z  # noqa: E402

_COPY = f"(select c.audio_cluster_id, dataset || '/' || cut_id as item, z.* exclude (dataset, cut_id) from (select distinct audio_cluster_id, dataset, cut_id from clusters where audio_cluster_id is not null) c join {_Z} z using (dataset, cut_id))"
_ZS = {n: "round((" + " + ".join(f"coalesce({{0}}{z}, 0)" for z in zs) + f") / {len(zs)}, 6)" for n, zs in SCHEMES.items()}

QUERIES = {f.__name__: f for f in (
    min_rate_filter, record_contract, vad_short_circuit, language_precedence, asr_with_source, captions_joined, captions_by_field, folder_ingest, decisions_written, audio_recall, gate_populations, reduction_funnel, change_rates, wer_change_kinds,
    metric_coverage, severity_coverage, combiner_accuracy, family_top1, vote_features, rover_flat, leveled_dedup, marked_confidences, rewrite_leaks, threshold_table, speech_shares, component_map, sample_moments, per_bin_sample, random_cluster,
    delivery_times, seeded_edits, run_counters)}

_FIELDS = "is_kept, is_duplicate, low_quality, audio_cluster_id, text_cluster_id, cluster_size, keep_reason, retention_reason"
SQL = {
    "min_rate_filter": "select line_no from manifest where num_samples / nullif(duration_secs, 0) is null or num_samples / nullif(duration_secs, 0) >= 16000",
    "record_contract": """select problem, count(*) as n from (select case when cut_id like '%7' or cut_id = '' then 'cut_id' when score_batch % 5 = 0 then 'rover.voting' when isnan(coalesce(utmos_t, 'nan'::float)) or floor(utmos_t * 3) < 0 then 'rover.primary_fallbacks'
 when isnan(coalesce(stoi_t, 'nan'::float)) or floor(stoi_t::double * 2.2) < 0 or floor(stoi_t::double * 2.2) > 1 then 'vad.speech_pct' end as problem from pending_batch) group by 1""",
    "vad_short_circuit": """select line_no, case when coalesce(p, 0) < 0.5 then '' else text end as text, coalesce(p, 0) < 0.5 as vad_short_circuit, round(coalesce(p, 0), 5) as speech_pct from manifest m left join
 (select dataset, cut_id, max(case when not isnan(stoi_t) then stoi_t end)::double as p from pending_batch group by 1, 2) using (dataset, cut_id)""",
    "language_precedence": "select line_no, coalesce(case when line_no % 5 = 0 then 'de' end, case when line_no % 3 = 0 and trim(audio_format, ' ') <> '' then audio_format end, case when trim(language, ' ') <> '' then language end) as hint from manifest",
    "asr_with_source": f"""select a.dataset, a.cut_id, coalesce(case when keep_reason <> 'kept' and trim(keep_reason, ' ') <> '' then trim(keep_reason, ' ') end, trim(s.text, ' '), '') as ref_text, retention_reason as rover_text, s.audio_format as fmt from {_LAST} a left join
 (select * from manifest qualify row_number() over (partition by dataset, cut_id order by line_no) = 1) s using (dataset, cut_id)""",
    "captions_joined": f"""select line_no, case when coalesce(length(cut_id) % 2 = 0 and keep_reason <> '', false) then keep_reason else text end as text, coalesce(length(cut_id) % 2 = 0 and keep_reason <> '', false) as patched from manifest left join (select dataset, cut_id, keep_reason from {_LAST}) using (dataset, cut_id)""",
    "captions_by_field": "select line_no, case when line_no % 4 = 0 and coalesce(normalized_text, '') <> '' then normalized_text else text end as text, line_no % 4 = 0 and coalesce(normalized_text, '') <> '' as patched from manifest",
    "folder_ingest": f"""select 'rec_' || user_id || '_' || day || '@' || lpad((row_number() over (partition by user_id, day order by start) - 1)::varchar, 6, '0') as cut_id, start, "end" - start as duration from ({SPEECH['vad_pack']}) where user_id % 7 <> 0""",
    "decisions_written": f"""select m.line_no, d.is_kept::varchar as is_kept, d.keep_reason as reason, d.retention_reason as detail, d.cluster_size::varchar as cluster_size, d.is_duplicate::varchar as is_duplicate, d.score::varchar::double + 0.0 as score, p.pesq::varchar::double as pesq,
 case when d.dataset is not null then t.source end as source, md5(coalesce(case when d.dataset is not null then t.text end, '')) as content from manifest m
 join (select line_no, case when line_no % 4 = 0 and trim(text, ' ') <> '' then text when line_no % 2 = 1 and trim(normalized_text, ' ') <> '' then normalized_text when trim(text, ' ') <> '' then text end as text,
 case when line_no % 4 = 0 and trim(text, ' ') <> '' then 'rover_enhanced_itn' when line_no % 2 = 1 and trim(normalized_text, ' ') <> '' then 'rover_itn' when trim(text, ' ') <> '' then 'rover' end as source from manifest) t using (line_no)
 left join (select dataset, cut_id, {_FIELDS}, case when not isnan(quality_score) then quality_score end as score from {_LAST}) d using (dataset, cut_id)
 left join (select dataset, cut_id, max(case when not isnan(pesq_t) then pesq_t end) as pesq from pending_batch group by 1, 2) p on p.dataset = d.dataset and p.cut_id = d.cut_id""",
    "audio_recall": f"""select coalesce(family, 'OVERALL') as family, count(*) as total, count(*) filter (a.cluster >= 0 and a.cluster = b.cluster) as found, round(count(*) filter (a.cluster >= 0 and a.cluster = b.cluster) / count(*), 6) as recall
 from (select distinct {_ITEM.format('src')} as item, {_ITEM.format('dst')} as partner, src_dataset as family from match_edges where match_kind = 'audio') t left join (select dataset || '/' || cut_id as item, max(coalesce(audio_cluster_id, -1)) as cluster from clusters group by 1) a on a.item = t.item
 left join (select dataset || '/' || cut_id as item, max(coalesce(audio_cluster_id, -1)) as cluster from clusters group by 1) b on b.item = t.partner group by rollup (family)""",
    "gate_populations": f"""select population, tp, fp, fn, tn, {_RATES} from (select population, count(*) filter (not is_kept and low_quality) as tp, count(*) filter (is_kept and low_quality) as fp, count(*) filter (not is_kept and not low_quality) as fn, count(*) filter (is_kept and not low_quality) as tn
 from (select *, unnest(['all', case when not is_duplicate then 'unique' end, 'family:' || dataset, case when is_kept then 'clean' end]) as population from {_LAST} where low_quality is not null and is_kept is not null and is_duplicate is not null) where population is not null group by 1)""",
    "reduction_funnel": f"""select unnest(['1 total', '2 redundant', '3 low quality', '4 kept']) as step, unnest([t, r, l, k]) as hours from (select {_HOURS.format('true')} as t, {_HOURS.format('not is_kept and is_duplicate')} as r, {_HOURS.format('not is_kept and not is_duplicate')} as l, {_HOURS.format('is_kept')} as k
 from {_LAST} where is_kept is not null and is_duplicate is not null)""",
    "change_rates": f"select dataset, sum(word_edits)::bigint as edits, sum(words)::bigint as words, count(*) filter (word_edits > 0) as changed, count(*) as cuts, round(sum(word_edits) / greatest(sum(words), 1), 6) as word_change from {WORD_EDITS} group by 1",
    "wer_change_kinds": f"""select case when text is not distinct from normalized_text then 'identical' when lower(text) is not distinct from lower(normalized_text) then 'casing_only' else 'real' end as kind, count(*) as n, round(sum(word_edits) / greatest(sum(words), 1), 6) as edit_rate from {WORD_EDITS} where text is not null group by 1""",
    "metric_coverage": _coverage_sql("dataset", METRICS),
    "severity_coverage": _coverage_sql("coalesce(least(floor(duration_secs / 4), 5)::bigint, -1)::varchar", ["quality_score", "gate_score"]),
    "combiner_accuracy": f"""with c as (select *, min(item) over (partition by audio_cluster_id) as ref from {_COPY}) select scheme, count(*) as pairs, count(*) filter (ok) as "right", round(count(*) filter (ok) / count(*), 6) as accuracy from
 (select unnest({list(SCHEMES)!r}) as scheme, unnest([{', '.join(f"coalesce({q.format('y.')} > {q.format('x.')}, false)" for q in _ZS.values())}]) as ok from c x join c y on x.audio_cluster_id = y.audio_cluster_id and y.item = x.ref where x.item <> x.ref) group by 1""",
    "family_top1": f"""with r as (select audio_cluster_id as family, item, coalesce(z_utmos < -1, false) as low, coalesce(z_pesq > 0, false) as clean, {', '.join(f'{q.format("")} as "{n}"' for n, q in _ZS.items())} from {_COPY}), f as (select family, bool_or(low) as hard from r group by 1 having count(*) > 1),
 k as ({' union all '.join(f"select * from (select '{n}' as scheme, family, low, clean, row_number() over (partition by family order by {chr(34)}{n}{chr(34)} desc nulls last, item) as rn from r) where rn = 1" for n in SCHEMES)})
 select scheme, count(*) as families, count(*) filter (low) as kept_low, count(*) filter (clean) as kept_clean, count(*) filter (hard) as hard_families, count(*) filter (hard and low) as hard_low from k join f using (family) group by 1""",
    "vote_features": "select doc_id, u - d as net_score, u + d as vote_total, round(u / nullif(u + d, 0), 6) as vote_ratio from (select doc_id, n_turns % 5 as u, n_chars % 4 as d from documents)",
    "rover_flat": """select line_no, cut_id, dataset, language as language_hint, text as ref_text, null::varchar as filtered_reason, text as rover_text, normalized_text as text_enhanced, null::varchar as text_enhanced_itn, line_no % 4 as primary_fallbacks, case when line_no % 3 = 0 then 2 else 0 end as n_ambiguous,
 line_no % 2 = 0 as lang_consistent, text as hyp_first, normalized_text as hyp_second from manifest""",
    "leveled_dedup": """with k as (select line_no, coalesce(dataset, '') as ds, coalesce(lower(split_part(language, '-', 1)), '') as l, round(duration_secs, 3) as d, num_samples as n, md5(coalesce(normalized_text, '')) as c from manifest where num_samples is not null)
 select line_no, first, case when h < line_no then 'local' when g < line_no then 'language' else 'cross' end as level from (select *, min(line_no) over (partition by d, n, c) as first, min(line_no) over (partition by d, n, c, ds) as h, min(line_no) over (partition by d, n, c, l) as g from k) where line_no > first""",
    "marked_confidences": f"""select line_no, round(case when len(w) >= 5 then (-length(w[3]) / 10 - length(w[4]) / 10) / 2 when len(w) > 0 then list_sum(list_transform(w, lambda x: -length(x) / 10)) / len(w) else 0 end, 6) as confidence from (select line_no, {_WORDS} as w from manifest)""",
    "rewrite_leaks": """select line_no, case when trim(n, ' ') <> '' and length(n) / greatest(length(text), 1) between 0.5 and 2.0 and not contains(n, 'Input:') and not contains(n, 'Output:') and not (contains(lower(n), 'thank you') and not contains(lower(text), 'thank you'))
 and not (contains(lower(n), 'good morning') and not contains(lower(text), 'good morning')) then n else text end as text from (select line_no, text, coalesce(case when line_no % 3 = 0 then text || ' thank you' else normalized_text end, '') as n from manifest where text is not null)""",
    "threshold_table": f"""with recursive e0 as (select t, {_ITEM.format('src')} as a, {_ITEM.format('dst')} as b from match_edges, (values (0.7::double), (0.8::double), (0.9::double)) v(t) where match_kind = 'text' and jaccard::double >= t), e as (select t, a, b from e0 where a <> b union select t, b, a from e0 where a <> b),
 r as (select t, a, a as b from e union select r.t, r.a, e.b from r join e on r.t = e.t and r.b = e.a), c as (select t, a, min(b) as root from r group by 1, 2)
 select t as threshold, count(*) as clusters, sum(n)::bigint as records, max(n) as largest from (select t, root, count(*) as n from c group by 1, 2) group by 1""",
    "component_map": None,
    "sample_moments": "select dataset, count(v) as n, round(stddev_samp(v), 6) as sd, round(var_samp(v), 5) as var from (select dataset, case when not isnan(duration_secs) then duration_secs end as v from manifest) group by 1",
    "per_bin_sample": "select bin, line_no from (select least(floor(duration_secs / 2), 10)::bigint as bin, line_no, row_number() over (partition by least(floor(duration_secs / 2), 10) order by md5('11-' || line_no::varchar)) as r from manifest where duration_secs is not null and not isnan(duration_secs)) where r <= 3",
    "random_cluster": "select distinct text_cluster_id, dataset, cut_id from clusters where text_cluster_id = (select text_cluster_id from clusters where text_cluster_id is not null order by md5('5-' || text_cluster_id::varchar) limit 1)",
    "delivery_times": "select line_no, strftime(delivered_at, '%Y-%m-%dT%H:%M:%S') as iso, floor(epoch(delivered_at))::bigint as seconds, strftime(delivered_at, '%Y-%m-%d') as day from manifest",
    "seeded_edits": f"""select line_no, array_to_string(list_transform(list_filter(list_zip(w, range(len(w))), lambda z: ('0x' || substr(md5('3-' || line_no::varchar || '-' || z[2]::varchar || '-' || z[1]), 1, 4))::int % 10 <> 0), lambda z: z[1]), ' ') as text from (select line_no, {_WORDS} as w from manifest)""",
    "run_counters": f"select count(*) as records, count(*) filter (is_kept) as kept, count(*) filter (is_duplicate) as duplicates, count(*) filter (low_quality) as low_quality from {_LAST}",
    "speech_shares": """with fr as (select user_id, d * 24 + h as frame from (select user_id, dayofyear(ts) as d, hour(ts) as h from events) group by 1, 2), s as (select user_id, frame, sum(n) over (partition by user_id order by frame rows unbounded preceding) as run from
 (select *, case when frame - lag(frame) over (partition by user_id order by frame) - 1 < 3 then 0 else 1 end as n from fr)), r as (select user_id, max(frame) - min(frame) + 1 as len from s group by user_id, run having max(frame) - min(frame) + 1 >= 2), t as (select user_id, sum(len) as speech from r group by 1)
 select f.user_id, round(coalesce(any_value(t.speech), 0) / (max(frame) - min(frame) + 1), 6) as speech_pct from fr f left join t using (user_id) group by f.user_id""",
}
from tidewrack.plans.quality_queries import _SC  # noqa: E402

SQL["component_map"] = f"select dataset, cut_id, {', '.join(f'round({a}, 6) as {a}' for a in Q.MOS_AXES)}, round(exp(-floor(pesq)::bigint / 10), 6) as rover, case when stoi is not null then case when stoi > 0.8 then 0.0 else 1.0 end end as language_penalty from {_SC}"
