"""Problem 2: one surviving record per group of copies, by window ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.columns import usable
from tidewrack.operators.ordering import top_per_group

RECORD = ["dataset", "cut_id"]
FIELDS = ["recording_id", "quality_score", "gate_score", "duration_secs", "retention_reason", "is_kept", "decided_at"]


def latest_decisions(assignments: DataFrame, fields: list[str] = FIELDS) -> DataFrame:
    """One row per record: its latest `decided_at`. Of equal times the later run counts, then the larger values.

    Taken as the maximum of a struct, so that a record with very many runs is combined before the shuffle.
    """
    rest = [f for f in fields if f != "decided_at"]
    rows = assignments.groupBy(*RECORD).agg(F.max(F.struct("decided_at", "run_no", *rest)).alias("_b"))
    return rows.select(*RECORD, *[F.col(f"_b.{f}").alias(f) for f in fields])


def members(clusters: DataFrame) -> DataFrame:
    """Distinct records of every audio group. Rows without a group are left out."""
    return clusters.where(F.col("audio_cluster_id").isNotNull()).select("audio_cluster_id", *RECORD).distinct()


def _of_two(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of `groups`, one a group, whose groups have at least two members, with their number. No row of a group but
    these moves by its group, so one group with most records is no load."""
    return groups.join(rows.groupBy("audio_cluster_id").agg(F.count(F.lit(1)).alias("members")).where("members >= 2"), "audio_cluster_id")


def completeness():
    return sum(F.col(c).isNotNull().cast("int") for c in ("gate_score", "duration_secs", "recording_id"))


def survivors(clusters: DataFrame, assignments: DataFrame) -> DataFrame:
    """The record kept of each group, with the fields of its latest decision.

    Order: quality_score (null and NaN last), number of non-null fields of gate_score, duration_secs and recording_id,
    duration_secs (null last), decided_at, then (dataset, cut_id). A record that was never decided has nulls throughout.
    Only each task's best row of a group is shuffled, so a group of any size is no load.
    """
    some = members(clusters)
    rows = some.join(latest_decisions(assignments), RECORD, "left")
    rows = rows.withColumn("_q", usable(F.col("quality_score"))).withColumn("_n", completeness())
    order = [F.col("_q").desc_nulls_last(), F.col("_n").desc(), F.col("duration_secs").desc_nulls_last(), F.col("decided_at").desc_nulls_last(), F.col("dataset"), F.col("cut_id")]
    return _of_two(top_per_group(rows, ["audio_cluster_id"], order, 1).drop("_q", "_n"), some)


def merged(clusters: DataFrame, assignments: DataFrame) -> DataFrame:
    """One built record per group: the survivor's identity, and each field from the best record that has it.

    A field is taken, among the records with a value that is neither null nor NaN, from the one with the most non-null
    fields, then the latest decision, then the largest value; this is one aggregate per group, combined before the shuffle.
    """
    rows = members(clusters).join(latest_decisions(assignments), RECORD, "left")
    trust = F.struct(completeness().alias("n"), F.col("decided_at").alias("at"))

    def pick(c: str):
        ok = usable(F.col(c)) if c in ("quality_score", "gate_score", "duration_secs") else F.col(c)
        return F.max(F.when(ok.isNotNull(), F.struct(trust.alias("t"), ok.alias("v"))))["v"].alias(f"best_{c}")

    fields = rows.groupBy("audio_cluster_id").agg(*[pick(c) for c in ("recording_id", "quality_score", "gate_score", "duration_secs")])
    return survivors(clusters, assignments).select("audio_cluster_id", *RECORD, "members").join(fields, "audio_cluster_id")
