"""Checks and joins around enrichment: record validation, short-circuits, precedence, decisions written back, reports on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.functions.text import let
from tidewrack.operators.evaluation import auroc
from tidewrack.operators.ordering import top_per_group

# Fixed values of the record contract: the names that its enumerations allow.
VOTINGS = ["majority", "confidence"]
PRIMARIES = ["parakeet", "canary", "qwen", "voxtral", "whisper", "ref"]
#: The transcript to write back is the first of these fields that is not blank; with the name of its source.
TRANSCRIPTS = {"text_enhanced_itn": "rover_enhanced_itn", "text_enhanced": "rover_enhanced", "text_itn": "rover_itn", "text": "rover"}
CATCHES, MISSES = 0.80, 0.65


def not_blank(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def fast_enough(rate: Column, least: float) -> Column:
    """Whether a sample rate is high enough; an unknown one passes."""
    return rate.isNull() | (rate >= least)


def _kind(v: Column, path: str) -> Column:
    """The type of a field of a variant, its parameters cut off; VOID for a JSON null, null where the field is absent."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, path, "variant")), "^[A-Z]+", 0)


def validated(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add `problem`: why the JSON record breaks the contract, or null.

    Required: an object with a text `cut_id` that is not empty. Optional fields must have their type where they are given
    (null only for those that allow it), the voting and its primary one of their names, counts at least 0 and the share of
    speech within 0 and 1; a score object must hold its score.
    """
    v = F.try_parse_json(F.col(column))
    numbers = ["BIGINT", "DOUBLE", "DECIMAL", "FLOAT", "INT"]

    def wrong(path: str, kinds: list[str]) -> Column:
        k = _kind(v, path)
        return k.isNotNull() & ~k.isin(kinds)

    def value(path: str, kind: str) -> Column:
        return F.try_variant_get(v, path, kind)

    rules = [
        ("not an object", F.coalesce(_kind(v, "$") != "OBJECT", F.lit(True))),
        ("cut_id", F.coalesce(_kind(v, "$.cut_id") != "STRING", F.lit(True)) | (value("$.cut_id", "string") == "")),
        ("dataset", wrong("$.dataset", ["STRING", "VOID"])),
        ("duration", wrong("$.duration", [*numbers, "VOID"])),
        ("metrics.utmos", _kind(v, "$.metrics.utmos").isNotNull() & ~F.coalesce(_kind(v, "$.metrics.utmos.score.utmos").isin(numbers), F.lit(False))),
        ("rover.voting", _kind(v, "$.rover.voting").isNotNull() & ~F.coalesce(value("$.rover.voting", "string").isin(VOTINGS), F.lit(False))),
        ("rover.primary", _kind(v, "$.rover.primary").isNotNull() & ~F.coalesce(value("$.rover.primary", "string").isin(PRIMARIES), F.lit(False))),
        ("rover.primary_fallbacks", wrong("$.rover.primary_fallbacks", ["BIGINT", "INT"]) | F.coalesce(value("$.rover.primary_fallbacks", "bigint") < 0, F.lit(False))),
        ("vad.speech_pct", wrong("$.vad.speech_pct", numbers) | F.coalesce(~value("$.vad.speech_pct", "double").between(0.0, 1.0), F.lit(False))),
        ("filtered_reason", wrong("$.filtered_reason", ["STRING", "VOID"])),
    ]
    return lines.withColumn("problem", F.coalesce(*[F.when(F.coalesce(bad, F.lit(False)), name) for name, bad in rules]))


def require_valid(lines: DataFrame) -> DataFrame:
    """The rows of `validated` without a problem; raises if there are rows and all have one."""
    good = lines.where("problem is null").drop("problem")
    if good.isEmpty() and not lines.isEmpty():
        raise ValueError("no record keeps to the contract")
    return good


def short_circuited(rows: DataFrame, speech: str, text: str, least: float) -> DataFrame:
    """Rows with hardly any speech get an empty transcript without a run of a model; no measurement counts as silence."""
    share = F.coalesce(F.col(speech), F.lit(0.0))
    return rows.withColumn("vad_short_circuit", share < least).withColumn(text, F.when(share < least, F.lit("")).otherwise(F.col(text))).withColumn(speech, share)


def language_hint(config: Column, custom: Column, supervision: Column) -> Column:
    """The configured language, else the record's own field, else its supervision's; blank ones do not count."""
    return F.coalesce(not_blank(config), not_blank(custom), not_blank(supervision))


def with_source(output: DataFrame, source: DataFrame, key: list[str], order: str) -> DataFrame:
    """Transcription output beside the source's fields: `ref_text` is its own where that is not blank, else the source's text.

    Of a source record given several times the first in `order` counts; output without a source keeps what it has.
    """
    first = source.groupBy(*key).agg(F.min_by(F.struct(F.col("text").alias("source_text"), "custom"), order).alias("s"))
    out = output.join(first, key, "left")
    return out.select(*[c for c in output.columns if c != "ref_text"], F.coalesce(F.trim(not_blank(F.col("ref_text"))), F.trim("s.source_text"), F.lit("")).alias("ref_text"), F.col("s.custom").alias("custom"))


def captioned(cuts: DataFrame, captions: DataFrame | None, key: list[str], custom_key: str | None = None) -> DataFrame:
    """Cuts with their caption in place of the text, by the old id or by a field of their own; `patched` tells which have one."""
    if custom_key:
        rows = cuts.withColumn("_caption", F.col("custom")[custom_key])
    else:
        rows = cuts.join(captions.select(*key, F.col("caption").alias("_caption")), key, "left")
    has = F.coalesce(F.col("_caption") != "", F.lit(False))
    return rows.withColumn("text", F.when(has, F.col("_caption")).otherwise(F.col("text"))).withColumn("patched", has).drop("_caption")


def best_transcript(**fields: Column) -> Column:
    """struct(text, source) of the preferred transcript that is not blank; null if all are."""
    tries = [F.when(F.trim(fields[f]) != "", F.struct(fields[f].alias("text"), F.lit(source).alias("source"))) for f, source in TRANSCRIPTS.items() if f in fields]
    return F.coalesce(*tries)


def decision_record(d: str = "d", t: str = "t") -> Column:
    """The nested record that a decision is written back as; null without a decision. Null members are left out of its JSON."""
    c = lambda name: F.col(f"{d}.{name}")
    return F.when(F.col(d).isNotNull(), F.struct(
        F.struct(*[c(n).alias(n) for n in ("audio_cluster_id", "text_cluster_id", "cluster_size", "is_duplicate")]).alias("dedup"),
        F.struct(c("quality_score").alias("score"), c("low_quality").alias("low_quality"), c("metrics").alias("metrics")).alias("quality"),
        F.col(t).alias("asr_transcript"),
        F.struct(c("is_kept").alias("is_kept"), c("keep_reason").alias("reason"), c("retention_reason").alias("detail")).alias("keep")))


def votes(up: Column, down: Column) -> list[Column]:
    """net_score, vote_total and vote_ratio; the ratio of no votes is null."""
    return [(up - down).alias("net_score"), (up + down).alias("vote_total"), F.try_divide(up, up + down).alias("vote_ratio")]


def flat_rover(records: Column, slots: list[str]) -> list[Column]:
    """Columns for reports of a transcript record: its texts, how many words were ambiguous, and each slot's hypothesis."""
    r = lambda name: records.getField(name)
    rover = r("rover")
    return [
        *[r(n).alias(n) for n in ("cut_id", "dataset", "language_hint", "ref_text", "filtered_reason")], rover.getField("text").alias("rover_text"),
        *[rover.getField(n).alias(n) for n in ("text_enhanced", "text_enhanced_itn", "primary_fallbacks")],
        F.coalesce(F.array_size(rover.getField("ambiguous_words_enhanced")), F.lit(0)).alias("n_ambiguous"), r("language_consistency").getField("all_consistent").alias("lang_consistent"),
        *[r("hypotheses")[s]["text"].alias(f"hyp_{s}") for s in slots],
    ]


def first_copies(rows: DataFrame, content: list[str], order: str, local: str, language: str) -> DataFrame:
    """(order, first, level) of every row that repeats an earlier one in `content`: level local, language or cross after whether
    an earlier copy stands in the same corpus, else in the same language. Copies are counted by windows of minima."""
    same = [F.col(c) for c in content]
    first = F.min(order).over(Window.partitionBy(*same))
    here = F.min(order).over(Window.partitionBy(*same, F.col(local)))
    near = F.min(order).over(Window.partitionBy(*same, F.col(language)))
    out = rows.select("*", first.alias("first"), here.alias("_here"), near.alias("_near")).where(F.col(order) > F.col("first"))
    return out.select(order, "first", F.when(F.col("_here") < F.col(order), "local").when(F.col("_near") < F.col(order), "language").otherwise("cross").alias("level"))


def marked_confidence(tokens: Column, begin: str, end: str) -> Column:
    """Mean log-probability of the tokens between the markers; without tokens there of all, without any 0.

    Tokens: array of struct(token, logprob). Markers are tokens of their own; without the first the region starts at once.
    """
    def of(t: Column) -> Column:
        place = lambda m, missing: F.coalesce(F.nullif(F.array_position(F.transform(t, lambda x: x["token"]), m), F.lit(0)), missing)
        inside = let(F.struct(place(begin, F.lit(0)).alias("low"), place(end, F.size(t) + 1).alias("high")), lambda b: F.filter(t, lambda x, i: (i + 1 > b["low"]) & (i + 1 < b["high"])))
        mean = lambda c: let(c, lambda a: F.when(F.size(a) > 0, F.aggregate(a, F.lit(0.0), lambda s, x: s + x["logprob"]) / F.size(a)))
        return F.coalesce(mean(inside), mean(F.filter(t, lambda x: ~x["token"].isin([begin, end]))), F.lit(0.0))

    return let(tokens, of)


def funnel(rows: DataFrame) -> DataFrame:
    """(step, hours): in all, minus redundant, minus low quality, kept; of (duration_secs, is_kept, is_duplicate)."""
    hours = lambda on: F.round(F.coalesce(F.sum(F.when(on, F.coalesce(F.col("duration_secs").cast("double"), F.lit(0.0)))), F.lit(0.0)) / 3600, 5)
    gone = ~F.col("is_kept")
    one = rows.agg(hours(F.lit(True)).alias("1 total"), hours(gone & F.col("is_duplicate")).alias("2 redundant"), hours(gone & ~F.col("is_duplicate")).alias("3 low quality"), hours(F.col("is_kept")).alias("4 kept"))
    return one.unpivot([], one.columns, "step", "hours")


def coverage(clean: DataFrame, degraded: DataFrame, metrics: list[str]) -> DataFrame:
    """(family, metric, positives, negatives, auroc, verdict): how well each metric tells a family's rows from the clean ones.

    `clean` (metrics...) is held against every family of `degraded` (family, metrics...), of which there are few: it is
    repeated once a family. Verdict: catch from 0.80 up, miss below 0.65.
    """
    families = F.broadcast(degraded.agg(F.array_compact(F.collect_set("family")).alias("families")))  # one row
    long = lambda df: df.unpivot(["family", "clean"], metrics, "metric", "value")
    rows = long(clean.crossJoin(families).select(F.explode("families").alias("family"), F.lit(True).alias("clean"), *metrics)).union(long(degraded.select("family", F.lit(False).alias("clean"), *metrics)))
    out = auroc(rows, ["family", "metric"], "value", "clean")
    return out.withColumn("verdict", F.when(F.col("auroc") >= CATCHES, "catch").when(F.col("auroc") < MISSES, "miss"))


def pairwise_accuracy(pairs: DataFrame, schemes: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(scheme, pairs, right, accuracy): how often the clean side of a pair has the higher score; a missing one is not right."""
    each = F.array(*[F.struct(F.lit(n).alias("scheme"), F.coalesce(a > b, F.lit(False)).alias("ok")) for n, (a, b) in schemes.items()])
    out = pairs.select(F.explode(each).alias("x")).groupBy("x.scheme").agg(F.count(F.lit(1)).alias("pairs"), F.count_if("x.ok").alias("right"))
    return out.withColumn("accuracy", F.round(F.col("right") / F.col("pairs"), 6))


def top_of_families(rows: DataFrame, schemes: list[str]) -> DataFrame:
    """(scheme, families, kept_low, kept_clean, hard_families, hard_low): what stays if each scheme keeps its best of a family.

    Rows: (family, item, low, clean, one column a scheme); families of two or more count, hard ones hold a low member.
    The best is the row with the highest score, of equal ones the smallest item; null scores come last.
    """
    sizes = rows.groupBy("family").agg(F.count(F.lit(1)).alias("n"), F.bool_or("low").alias("hard")).where("n > 1").drop("n")
    long = rows.unpivot(["family", "item", "low", "clean"], schemes, "scheme", "score")
    kept = top_per_group(long, ["family", "scheme"], [F.col("score").desc_nulls_last(), F.col("item")], 1).join(sizes, "family")
    return kept.groupBy("scheme").agg(F.count(F.lit(1)).alias("families"), F.count_if("low").alias("kept_low"), F.count_if("clean").alias("kept_clean"), F.count_if("hard").alias("hard_families"), F.count_if(F.col("hard") & F.col("low")).alias("hard_low"))
