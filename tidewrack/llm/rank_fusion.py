"""Problem 1: one ranking per batch from scores on unlike scales, by median rank aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.columns import in_range
from tidewrack.operators.ordering import running_total, top_per_group

#: The scale of each score: values outside it are failed scorings.
SCALES = {"utmos_t": (1.0, 5.0), "dns_t": (1.0, 5.0), "si_sdr_t": (-60.0, 60.0), "stoi_t": (0.0, 1.0)}
ITEM = ["score_batch", "dataset", "cut_id"]


def latest_scores(scores: DataFrame, scales: dict[str, tuple[float, float]] = SCALES) -> DataFrame:
    """One row per cut and batch, with the scores of its latest `scored_at`; values off the scale become null.

    Of rows with equal `scored_at` the one with the larger scores in the order of `scales` counts; null times are oldest.
    """
    clean = [in_range(F.col(c), *r).alias(c) for c, r in scales.items()]
    rows = scores.select(*ITEM, "scored_at", *clean)
    best = rows.groupBy(*ITEM).agg(F.max(F.struct("scored_at", *scales)).alias("_b"))
    return best.select(*ITEM, *[F.col(f"_b.{c}").alias(c) for c in scales])


def weighted_median(pairs: Column) -> Column:
    """Weighted median of an array of structs (rank, weight); between two middle ranks their mean; null if it is empty."""
    ordered = F.sort_array(pairs)
    half = F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x["weight"]) / 2
    start = F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))

    def step(a, x):
        cum = a["cum"] + x["weight"]
        return F.struct(
            cum.alias("cum"),
            F.coalesce(a["lo"], F.when(cum >= half, x["rank"])).alias("lo"),
            F.coalesce(a["hi"], F.when(cum > half, x["rank"])).alias("hi"),
        )

    return F.aggregate(ordered, start, step, lambda a: (a["lo"] + F.coalesce(a["hi"], a["lo"])) / 2)


def fused_ranks(scores: DataFrame, scales: dict[str, tuple[float, float]] = SCALES, weights: dict[str, float] | None = None) -> DataFrame:
    """(score_batch, dataset, cut_id, median_rank, mean_rank): lower is better, null if all scores are missing.

    The rank of a score is its average rank among the batch's present values, the highest first, divided by their number,
    so that a missing score neither helps nor harms. Ties share the average of their ranks.
    """
    weights = weights or dict.fromkeys(scales, 1.0)
    items = latest_scores(scores, scales)
    metrics = F.array(*[F.struct(F.lit(i).alias("metric"), F.col(c).cast("double").alias("value"), F.lit(float(weights[c])).alias("weight")) for i, c in enumerate(scales)])
    long = items.withColumn("_m", F.explode(metrics)).select(*ITEM, "_m.*")
    counts = long.where(F.col("value").isNotNull()).groupBy("score_batch", "metric", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = running_total(counts, ["score_batch", "metric"], [F.col("value").desc()], "n", "upto", "present")
    ranks = upto.select("score_batch", "metric", "value", ((F.col("upto") - F.col("n") / 2) / F.col("present")).alias("rank"))
    same_group = F.col("a.score_batch").eqNullSafe(F.col("b.score_batch")) & (F.col("a.metric") == F.col("b.metric"))
    same_value = same_group & (F.col("a.value") == F.col("b.value"))
    ranked = long.alias("a").join(ranks.alias("b"), same_value, "left").select(*[F.col(f"a.{c}") for c in ITEM], F.col("b.rank").alias("rank"), F.col("a.weight"))
    pairs = F.collect_list(F.when(F.col("rank").isNotNull(), F.struct("rank", "weight")))
    out = ranked.groupBy(*ITEM).agg(pairs.alias("_p"), (F.sum(F.when(F.col("rank").isNotNull(), F.col("rank") * F.col("weight"))) / F.sum(F.when(F.col("rank").isNotNull(), F.col("weight")))).alias("mean_rank"))
    return out.select(*ITEM, F.round(weighted_median(F.col("_p")), 12).alias("median_rank"), F.round("mean_rank", 12).alias("mean_rank"))


def order() -> list[Column]:
    return [F.col("median_rank").asc_nulls_last(), F.col("mean_rank").asc_nulls_last(), F.col("dataset").asc(), F.col("cut_id").asc()]


def ranking(scores: DataFrame) -> DataFrame:
    """Every cut of every batch with its `position`, from 1; all four missing ranks last; ties by (dataset, cut_id)."""
    fused = fused_ranks(scores).withColumn("_one", F.lit(1).cast("bigint"))
    return running_total(fused, ["score_batch"], order(), "_one", "position").drop("_one")


def best(scores: DataFrame, k: int = 5) -> DataFrame:
    """The `k` highest-ranked cuts of each batch; each task keeps its own first `k` before the shuffle."""
    return top_per_group(fused_ranks(scores), ["score_batch"], order(), k).select(*ITEM)
