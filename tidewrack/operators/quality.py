"""Quality records: nested JSON to columns, merged attempts, axes, z-scores, ranking and gate scores, percentiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewrack.functions.columns import in_range
from tidewrack.operators.ordering import percentiles as percentile_table
from tidewrack.operators.ordering import running_total

#: Axis: (column of the score table, lowest value, highest value).
AXES = {"utmos": ("utmos_t", 1.0, 5.0), "dnsmos": ("dns_t", 1.0, 5.0), "si_sdr": ("si_sdr_t", -60.0, 60.0), "stoi": ("stoi_t", 0.0, 1.0), "pesq": ("pesq_t", -0.5, 4.5)}
MOS_AXES, ASR_AXES = ["utmos", "dnsmos", "si_sdr", "stoi", "pesq"], ["rover"]
RECORD = ["dataset", "cut_id"]

_D = T.DoubleType()


def _s(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


RECORD_SCHEMA = _s(
    cut_id=T.StringType(),
    dataset=T.StringType(),
    metrics=_s(
        utmos=_s(score=_D),
        dnsmos=_s(score=T.MapType(T.StringType(), _D)),
        squim=_s(score=_s(stoi=_D, pesq=_D, si_sdr=_D)),
        audiobox=_s(score=_s(CE=_D, CU=_D, PC=_D, PQ=_D)),
    ),
    rover=_s(primary_fallbacks=T.LongType()),
    language_consistency=_s(consistent=T.BooleanType()),
)


def axes_for(mode: str) -> list[str]:
    """The axes of mode mos, asr or both."""
    return {"mos": MOS_AXES, "asr": ASR_AXES}.get(mode.lower(), MOS_AXES + ASR_AXES)


def parsed(lines: DataFrame, column: str = "value") -> DataFrame:
    """Quality records from JSON lines; a line that is no JSON object or has no id is left out."""
    r = F.from_json(F.col(column), RECORD_SCHEMA)
    return lines.select(r.alias("r"), *[c for c in lines.columns if c != column]).where("r.cut_id is not null")


def flattened(records: DataFrame, path_dataset: Column | None = None) -> DataFrame:
    """One nullable column per metric. The overall AudioBox score is the mean of CE, CU and PQ, all of which it needs."""
    box = F.col("r.metrics.audiobox.score")
    overall = (box["CE"] + box["CU"] + box["PQ"]) / 3
    dns = F.col("r.metrics.dnsmos.score")
    return records.select(
        F.coalesce(F.col("r.dataset"), path_dataset if path_dataset is not None else F.lit(None), F.lit("default")).alias("dataset"),
        F.regexp_replace("r.cut_id", r"^\./", "").alias("cut_id"),
        F.col("r.metrics.utmos.score").alias("utmos"),
        *[dns[v].alias(f"dnsmos_{v}") for v in ("nisqa", "bvcc")],
        *[F.col(f"r.metrics.squim.score.{k}").alias(k) for k in ("stoi", "pesq", "si_sdr")],
        *[box[k].alias(f"audiobox_{k}") for k in ("CE", "CU", "PC", "PQ")],
        overall.alias("audiobox_OVL"),
        F.col("r.rover.primary_fallbacks").alias("rover_primary_fallbacks"),
        F.col("r.language_consistency.consistent").cast("double").alias("language_consistency"),
        *[c for c in records.columns if c != "r"],
    )


def merged(rows: DataFrame, metrics: list[str], order: list[str]) -> DataFrame:
    """One row per record; of several, for each metric the value of the last one in `order` that has it."""
    picks = [F.max(F.when(F.col(m).isNotNull(), F.struct(*order, m)))[m].alias(m) for m in metrics]
    return rows.groupBy(*RECORD).agg(*picks)


def pivoted(long: DataFrame, metrics: list[str]) -> DataFrame:
    """(dataset, cut_id, metric, value) to one column per metric, null where it is absent; the set of columns is declared."""
    return long.groupBy(*RECORD).pivot("metric", metrics).agg(F.max("value"))


def scored(scores: DataFrame) -> DataFrame:
    """(dataset, cut_id, one column per MOS axis) of a score table: the latest value of each axis that lies on its scale."""
    rows = scores.select(*RECORD, "scored_at", "score_batch", *[in_range(F.col(c).cast("double"), lo, hi).alias(a) for a, (c, lo, hi) in AXES.items()])
    return merged(rows, list(AXES), ["scored_at", "score_batch"])


def components(flat: DataFrame, dnsmos_variant: str = "nisqa") -> DataFrame:
    """The axes: rover is exp(-fallbacks / 10), language_penalty one minus the consistency; absent ones are null."""
    return flat.select(
        *RECORD, "utmos", F.col(f"dnsmos_{dnsmos_variant}").alias("dnsmos"), "si_sdr", "stoi", "pesq", F.col("audiobox_OVL").alias("aes_ovl"),
        F.exp(-F.col("rover_primary_fallbacks") / 10).alias("rover"), (1 - F.col("language_consistency")).alias("language_penalty"))


def axis_stats(rows: DataFrame, axes: list[str]) -> DataFrame:
    """One row: mean and population deviation of each axis over the values present."""
    return rows.agg(*[f(a).alias(f"{n}_{a}") for a in axes for n, f in (("mu", F.avg), ("sd", F.stddev_pop))])


def z_scores(rows: DataFrame, axes: list[str], digits: int = 6) -> DataFrame:
    """Each axis as z_<axis>: 0 on an axis without variance, null where it is absent."""
    both = rows.crossJoin(F.broadcast(axis_stats(rows, axes)))  # the statistics are one row

    def z(a: str) -> Column:
        sd = F.col(f"sd_{a}")
        return F.round(F.when(F.col(a).isNotNull(), F.when(sd > 0, (F.col(a) - F.col(f"mu_{a}")) / sd).otherwise(0.0)), digits).alias(f"z_{a}")

    return both.select(*rows.columns, *[z(a) for a in axes])


def _penalty(weights: dict[str, float], columns: list[str]) -> Column:
    w = weights.get("language", 0.0)
    return F.coalesce(F.col("language_penalty") * w, F.lit(0.0)) if w and "language_penalty" in columns else F.lit(0.0)


def with_scores(z: DataFrame, axes: list[str], weights: dict[str, float], digits: int = 6) -> DataFrame:
    """Add rank_score (mean z), gate_score (half mean, half worst z) and raw_score (weighted sum on the native scales).

    Null where no axis is present (for the raw score: none with a weight); a language penalty is taken off all three.
    """
    present = F.filter(F.array(*[f"z_{a}" for a in axes]), lambda x: x.isNotNull())
    n = F.size(present)
    mean = F.aggregate(present, F.lit(0.0), lambda s, x: s + x) / n
    penalty = _penalty(weights, z.columns)
    terms = [F.col(a) * weights[a] for a in axes if weights.get(a)]
    raw = reduce(lambda x, y: x + y, [F.coalesce(t, F.lit(0.0)) for t in terms], F.lit(0.0)) - penalty
    used = F.coalesce(*terms).isNotNull() if terms else F.lit(False)
    return z.select(
        "*", F.round(F.when(n > 0, mean - penalty), digits).alias("rank_score"),
        F.round(F.when(n > 0, 0.5 * mean + 0.5 * F.array_min(present) - penalty), digits).alias("gate_score"),
        F.round(F.when(used, raw), digits).alias("raw_score"))


def nearest_rank(rows: DataFrame, column: str, percent: float, group: list[str] | None = None) -> DataFrame:
    """(group..., value): the value at index percent / 100 * (n - 1), rounded half to even, of the sorted values present.

    Values are counted, the counts summed up in order over range partitions; no group is sorted in one task.
    """
    keys = group or []
    some = rows.where(F.col(column).isNotNull()).select(*(keys or [F.lit(0).alias("_all")]), F.col(column).alias("value"))
    keys = keys or ["_all"]
    counts = some.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_c"))
    upto = running_total(counts, keys, [F.col("value")], "_c", "_upto")
    n = counts.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    at = F.least(F.greatest(F.rint(F.lit(percent / 100) * (F.col("_n") - 1)), F.lit(0)), F.col("_n") - 1)
    return upto.join(n, keys).where(F.col("_upto") > at).groupBy(*keys).agg(F.min("value").alias("value")).drop("_all")


def floor_percentiles(rows: DataFrame, column: str = "raw_score", percents: tuple[int, ...] = (10, 25, 50, 75, 90)) -> DataFrame:
    """(dataset, n, p10 ...): interpolated percentiles, from which a floor per dataset can be chosen."""
    out = percentile_table(rows, column, [float(x) for x in percents], ["dataset"])
    return out.select("dataset", "n", *[F.round(F.col("p")[i], 6).alias(f"p{x}") for i, x in enumerate(percents)])
