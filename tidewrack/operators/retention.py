"""Which record of each group stays: best copy, cap per text group, quality gate, and the flags drawn from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.operators.quality import nearest_rank

RECORD = ["dataset", "cut_id"]


def _preference(order: list[str]):
    return F.coalesce(F.array_position(F.array(*map(F.lit, order)), F.col("dataset")), F.lit(0)).cast("int") if order else F.lit(0)


def keep_best(rows: DataFrame, preference: list[str]) -> DataFrame:
    """Add is_kept and retention_reason by audio_cluster_id (-1: in none).

    Among members with a score at or above their floor the best score wins, then the dataset named earlier in
    `preference`, then the longer duration; if no member has such a score, the longest. Last tie: (dataset, cut_id).
    Rows: dataset, cut_id, audio_cluster_id, score, floor, duration_secs. The winner of a cluster is one aggregate.
    """
    named = _preference(preference)
    rank = F.when(named > 0, named).otherwise(len(preference) + 1)
    sure = F.col("score").isNotNull() & (F.col("floor").isNull() | (F.col("score") >= F.col("floor")))
    name = F.struct("dataset", "cut_id")
    rows = rows.withColumn("_rank", rank).withColumn("_sure", sure)
    grouped = rows.where("audio_cluster_id >= 0")
    best = F.min(F.when(F.col("_sure"), F.struct((-F.col("score")).alias("s"), F.col("_rank").alias("p"), (-F.col("duration_secs")).alias("d"), name.alias("k"))))
    longest = F.min(F.struct((-F.col("duration_secs")).alias("d"), F.col("_rank").alias("p"), name.alias("k")))
    winners = grouped.groupBy("audio_cluster_id").agg(best.alias("b"), longest.alias("l"), F.count(F.lit(1)).alias("cluster_size"))
    winners = winners.select("audio_cluster_id", "cluster_size", F.coalesce("b.k", "l.k").alias("_k"), F.when(F.col("b").isNotNull(), "quality").otherwise("longest_fallback").alias("_why"))
    own = [c for c in rows.columns if c not in ("_rank", "_sure")]
    kept = F.col("_k") == name
    reason = F.when(kept, F.col("_why")).otherwise(F.concat("_why", F.lit("_dropped")))
    out = grouped.join(winners, "audio_cluster_id").select(*own, F.col("cluster_size").cast("bigint").alias("cluster_size"), kept.alias("is_kept"), reason.alias("retention_reason"))
    # rows in no group, most of them, take no part in the join, where they would all have one key
    alone = rows.where("audio_cluster_id < 0 or audio_cluster_id is null")
    return out.union(alone.select(*own, F.lit(1).cast("bigint").alias("cluster_size"), F.lit(True).alias("is_kept"), F.lit("singleton").alias("retention_reason")))


def capped(rows: DataFrame, cap: int, preference: list[str]) -> DataFrame:
    """Of each text_cluster_id (-1: in none) only the first `cap` kept rows stay: by score (null last), preference, duration.

    Only kept rows take part, so a kept row's place is counted among kept ones. Ranking in one pass over a cluster of any
    size would put it into one task; the first `cap` are found with a limit in every task before the shuffle.
    """
    named = _preference(preference)
    order = [F.col("score").desc_nulls_last(), F.when(named > 0, named).otherwise(len(preference) + 1), F.col("duration_secs").desc(), "dataset", "cut_id"]
    within = rows.where(F.col("is_kept") & (F.col("text_cluster_id") >= 0))
    top = within.withColumn("_rn", F.row_number().over(Window.partitionBy("text_cluster_id").orderBy(*order))).where(F.col("_rn") <= cap).select(*RECORD, F.lit(True).alias("_in"))
    out = rows.join(top, RECORD, "left")
    over = F.col("is_kept") & (F.col("text_cluster_id") >= 0) & F.col("_in").isNull()
    return out.withColumn("retention_reason", F.when(over, "text_cluster_cap_dropped").otherwise(F.col("retention_reason"))).withColumn("is_kept", F.col("is_kept") & ~over).drop("_in")


def gated(rows: DataFrame, percent: float, drop: bool) -> DataFrame:
    """Flag rows whose gate_score is below the percentile of all gate scores; with `drop`, kept rows in no larger group go."""
    at = F.broadcast(nearest_rank(rows, "gate_score", percent).select(F.col("value").alias("_t")))  # one row
    out = rows.join(at, F.lit(True), "left")
    flagged = F.coalesce(F.col("gate_score") < F.col("_t"), F.lit(False))
    gone = flagged & F.lit(drop) & F.col("is_kept") & (F.col("cluster_size") <= 1)
    out = out.withColumn("gate_flagged", flagged).withColumn("retention_reason", F.when(gone, "below_quality_gate_dropped").otherwise(F.col("retention_reason")))
    return out.withColumn("is_kept", F.col("is_kept") & ~gone).drop("_t")


def flagged(rows: DataFrame) -> DataFrame:
    """Add is_duplicate, low_quality (below the floor on the native scale, or flagged by the gate) and keep_reason."""
    low = F.coalesce(F.col("raw_score") < F.col("floor"), F.lit(False)) | F.col("gate_flagged")
    rows = rows.withColumn("is_duplicate", F.col("cluster_size") > 1).withColumn("low_quality", low)
    return rows.withColumn("keep_reason", F.when(~F.col("is_kept"), F.col("retention_reason")).when(F.col("low_quality"), "low_quality").otherwise("kept"))


def decide(rows: DataFrame, preference: list[str], cap: int, gate_percent: float, gate_drop: bool) -> DataFrame:
    """The whole decision, in this order: best copy, cap, gate, flags."""
    return flagged(gated(capped(keep_best(rows, preference), cap, preference), gate_percent, gate_drop))
