"""Problem 6: a score cutoff per source that keeps a target fraction, by sketch-bracketed exact selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.functions.columns import usable
from tidewrack.llm.survivors import latest_decisions
from tidewrack.operators.joins import bounded
from tidewrack.session import cut, stored

#: Kinds of retention_reason that mean a drop; spellings differ in case, spaces, hyphens and underscores only.
DROPPED = ["qualitydropped", "belowqualitygatedropped", "textclustercapdropped", "longestfallbackdropped"]
#: The sketch's rank error is at most n / ACCURACY. A bracket holds at most about 4 / ACCURACY of a source's records.
ACCURACY = 1000
#: Brackets with more records than this are bracketed again before their records are sorted.
SORTED_AT_ONCE = 200_000


def candidates(assignments: DataFrame) -> DataFrame:
    """(dataset, cut_id, score) of the records that take part: latest decision, a score, and not dropped for any reason."""
    last = latest_decisions(assignments, ["quality_score", "retention_reason", "decided_at"])
    kind = F.regexp_replace(F.lower("retention_reason"), "[^a-z]", "")
    kept = F.col("retention_reason").isNull() | ~kind.isin(DROPPED)
    score = usable(F.col("quality_score")).cast("double") + F.lit(0.0)  # -0.0 becomes 0.0
    return last.where(kept).select("dataset", "cut_id", score.alias("score")).where("score is not null")


def select_at(rows: DataFrame, need: DataFrame, accuracy: int = ACCURACY, at_once: int = SORTED_AT_ONCE) -> DataFrame:
    """Per dataset of `need` (dataset, n, want): the `want`-th highest score of `rows` (dataset, score), as `cutoff`.

    A mergeable quantile sketch gives two values between which the wanted score is certain to lie; the records above are
    only counted, those between are bracketed again while they are many, and the last ones are sorted.
    """
    goal = cut(need.select("dataset", "n", "want", F.lit(float("-inf")).alias("lo"), F.lit(float("inf")).alias("hi"), F.lit(0).cast("bigint").alias("above"), F.col("n").alias("inside")))
    for round_no in range(64):
        if round_no and goal.where((F.col("inside") > at_once) & (F.col("lo") < F.col("hi"))).isEmpty():
            break
        inside = rows.join(bounded(goal), "dataset").where(F.col("score").between(F.col("lo"), F.col("hi")))
        cuts = inside.groupBy("dataset").agg(F.percentile_approx("score", [i / accuracy for i in range(accuracy + 1)], accuracy * 4).alias("cuts"))
        # position of the wanted record among those inside, from the lowest; the sketch is off by inside / (4 * accuracy) at most
        place = F.floor((F.col("inside") - (F.col("want") - F.col("above"))) * accuracy / F.col("inside")).cast("int")
        near = goal.join(cuts, "dataset").select(
            "dataset", "n", "want", F.get("cuts", F.greatest(place - 1, F.lit(0))).alias("lo1"), F.get("cuts", F.least(place + 3, F.lit(accuracy))).alias("hi1"),
            (place <= 1).alias("first"), (place + 3 >= accuracy).alias("last"), "lo", "hi")
        near = near.select("dataset", "n", "want", F.when(F.col("first"), F.col("lo")).otherwise(F.col("lo1")).alias("lo"), F.when(F.col("last"), F.col("hi")).otherwise(F.col("hi1")).alias("hi"))
        near = bounded(near)
        tally = rows.join(near, "dataset").groupBy("dataset").agg(
            F.count(F.when(F.col("score") > F.col("hi"), 1)).alias("above"), F.count(F.when(F.col("score").between(F.col("lo"), F.col("hi")), 1)).alias("inside"))
        found = near.join(tally, "dataset").select("dataset", "n", "want", "lo", "hi", "above", "inside")
        found = cut(found)
        wrong = found.where((F.col("above") >= F.col("want")) | (F.col("above") + F.col("inside") < F.col("want")))
        assert wrong.isEmpty(), "a bracket missed its score"
        goal = found
    inside = rows.join(bounded(goal), "dataset").where(F.col("score").between(F.col("lo"), F.col("hi")))
    counts = inside.groupBy("dataset", "score", "above", "want").agg(F.count(F.lit(1)).alias("c"))
    w = Window.partitionBy("dataset").orderBy(F.col("score").desc())
    upto = counts.withColumn("upto", F.col("above") + F.sum("c").over(w))
    return upto.where(F.col("upto") >= F.col("want")).groupBy("dataset").agg(F.max("score").alias("cutoff"))


def cutoffs(assignments: DataFrame, targets: DataFrame) -> DataFrame:
    """(dataset, keep_pct, candidates, cutoff, kept) for every dataset of `targets` with records taking part.

    The cutoff is the highest score such that the records at or above it are at least keep_pct percent; ties are kept.
    A target given twice counts with its larger percentage; null targets and datasets are left out; at 0 percent the cutoff is the top score.
    """
    rows = stored(candidates(assignments), "candidates")
    need, at = _at(rows, targets)
    size = rows.join(at, "dataset").where("score >= cutoff").groupBy("dataset").agg(F.count(F.lit(1)).alias("kept"))
    return need.join(at, "dataset").join(size, "dataset").select("dataset", "keep_pct", F.col("n").alias("candidates"), "cutoff", "kept")


def _at(rows: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(dataset, keep_pct, n, want) and (dataset, cutoff), both one row a dataset, for a written table of candidates."""
    pct = targets.where("dataset is not null and keep_pct is not null").groupBy("dataset").agg(F.max("keep_pct").alias("keep_pct"))
    n = rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))
    need = n.join(pct, "dataset").withColumn("want", F.least(F.expr("cast((n * keep_pct + 99) div 100 as bigint)"), F.col("n")))
    need = cut(need.withColumn("want", F.greatest(F.col("want"), F.lit(1))))
    return need, bounded(cut(select_at(rows, need)))


def kept(assignments: DataFrame, targets: DataFrame) -> DataFrame:
    """(dataset, cut_id) of the records at or above their dataset's cutoff."""
    rows = stored(candidates(assignments), "candidates")
    return rows.join(_at(rows, targets)[1], "dataset").where("score >= cutoff").select("dataset", "cut_id")
