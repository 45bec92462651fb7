"""Evaluation and reporting: recall, purity, rank statistics, curves, correlations, histograms, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.operators.ordering import percentiles, running_total


def recall_by(truth: DataFrame, clusters: DataFrame, family: str) -> DataFrame:
    """(family, total, found, recall) and a row of all (family null): items that share the cluster of their expected partner.

    truth: (item, partner, family); clusters: (item, cluster), an id below 0 being none. Items or partners without a
    cluster count as not found.
    """
    a = clusters.where("cluster >= 0")
    rows = truth.join(a, "item", "left").join(a.select(F.col("item").alias("partner"), F.col("cluster").alias("other")), "partner", "left")
    hit = F.coalesce(F.col("cluster") == F.col("other"), F.lit(False))
    return rows.rollup(family).agg(F.count(F.lit(1)).alias("total"), F.count_if(hit).alias("found"), F.round(F.count_if(hit) / F.count(F.lit(1)), 6).alias("recall"))


def purity(members: DataFrame) -> DataFrame:
    """One row (clusters, pure, purity) over the clusters of two or more: those whose members have one origin. Two-level
    counting (cluster, origin) first, so no cluster is gathered. members: (cluster, origin)."""
    pair = members.groupBy("cluster", "origin").agg(F.count(F.lit(1)).alias("c"))
    per = pair.groupBy("cluster").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("origins")).where("n > 1")
    return per.agg(F.count(F.lit(1)).alias("clusters"), F.count_if(F.col("origins") == 1).alias("pure"), F.round(F.try_divide(F.count_if(F.col("origins") == 1), F.count(F.lit(1))), 6).alias("purity"))


def keep_best_contrast(rows: DataFrame) -> DataFrame:
    """One row: of clusters that hold both good and bad members (cluster, good, kept), in how many the kept one is good."""
    per = rows.groupBy("cluster").agg(F.bool_or("good").alias("g"), F.bool_or(~F.col("good")).alias("b"), F.bool_or(F.col("good") & F.col("kept")).alias("ok"), F.bool_or("kept").alias("k"))
    some = per.where("g and b and k")
    return some.agg(F.count(F.lit(1)).alias("clusters"), F.count_if("ok").alias("right"), F.round(F.try_divide(F.count_if("ok"), F.count(F.lit(1))), 6).alias("accuracy"))


def confusion(rows: DataFrame, by: list[str], truth: Column, flagged: Column) -> DataFrame:
    """(by..., tp, fp, fn, tn, precision, recall, f1, fpr), rates null on a zero denominator."""
    n = rows.groupBy(*by).agg(
        F.count_if(truth & flagged).alias("tp"), F.count_if(~truth & flagged).alias("fp"), F.count_if(truth & ~flagged).alias("fn"), F.count_if(~truth & ~flagged).alias("tn"))
    p, r = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    return n.select("*", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.try_divide(2 * p * r, p + r), 6).alias("f1"), F.round(F.try_divide("fp", F.col("fp") + F.col("tn")), 6).alias("fpr"))


def auroc(rows: DataFrame, by: list[str], score: str, truth: str) -> DataFrame:
    """(by..., positives, negatives, auroc) by average ranks (Mann-Whitney); null without both classes.

    Equal scores are counted first; the ranks come from running totals over range partitions, so a group of any size is
    spread over the tasks.
    """
    c = rows.where(F.col(score).isNotNull() & F.col(truth).isNotNull()).groupBy(*by, score).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(truth)).alias("p"))
    upto = running_total(c, by, [F.col(score)], "n", "upto")
    sums = upto.groupBy(*by).agg(F.sum("p").alias("positives"), F.sum(F.col("n") - F.col("p")).alias("negatives"), F.sum(F.col("p") * (F.col("upto") - (F.col("n") - 1) / 2)).alias("ranks"))
    area = F.try_divide(F.col("ranks") - F.col("positives") * (F.col("positives") + 1) / 2, F.col("positives") * F.col("negatives"))
    return sums.select(*by, "positives", "negatives", F.round(area, 6).alias("auroc"))


def roc_points(rows: DataFrame, by: list[str], score: str, truth: str) -> DataFrame:
    """(by..., threshold, tpr, fpr): one point for each distinct score, from the highest."""
    c = rows.where(F.col(score).isNotNull() & F.col(truth).isNotNull()).groupBy(*by, score).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(truth)).alias("p"))
    c = c.withColumn("q", F.col("n") - F.col("p"))
    down = running_total(running_total(c, by, [F.col(score).desc()], "p", "tp"), by, [F.col(score).desc()], "q", "fp")
    total = c.groupBy(*by).agg(F.sum("p").alias("all_p"), F.sum("q").alias("all_q"))
    out = down.join(total, by)
    return out.select(*by, F.col(score).alias("threshold"), F.round(F.try_divide("tp", "all_p"), 6).alias("tpr"), F.round(F.try_divide("fp", "all_q"), 6).alias("fpr"))


def threshold_curve(rows: DataFrame, score: str, truth: str, low: float, high: float, steps: int) -> DataFrame:
    """(step, threshold, kept, precision, recall) at `steps` even thresholds. Each row falls into one step; the counts per
    step, a bounded number, are summed from the top, so rows are not unfolded by the thresholds."""
    width = (high - low) / (steps - 1)
    step = F.least(F.floor((F.col(score) - low) / width + 1e-9), F.lit(steps - 1))
    c = rows.where(F.col(score).isNotNull()).groupBy(F.greatest(step, F.lit(-1)).alias("step")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(truth)).alias("p"))
    all_steps = rows.sparkSession.range(steps).select(F.col("id").alias("step"))
    every = all_steps.join(F.broadcast(c), "step", "left").na.fill(0)
    w = Window.orderBy(F.col("step").desc())  # `steps` rows
    total = c.agg(F.sum("p").alias("all_p"))
    out = every.withColumn("kept", F.sum("n").over(w)).withColumn("tp", F.sum("p").over(w)).crossJoin(F.broadcast(total))
    return out.select("step", F.round(low + F.col("step") * width, 6).alias("threshold"), "kept", F.round(F.try_divide("tp", "kept"), 6).alias("precision"), F.round(F.try_divide("tp", "all_p"), 6).alias("recall"))


def recall_at_specificity(rows: DataFrame, score: str, truth: str, specificity: float) -> DataFrame:
    """One row: the largest share of positives (low scores) found while at most 1 - specificity of the negatives are."""
    points = roc_points(rows.withColumn("_s", -F.col(score)).withColumn("_g", F.lit(0)), ["_g"], "_s", truth)
    return points.where(F.col("fpr") <= 1 - specificity + 1e-9).agg(F.max("tpr").alias("recall"))


def pearson(rows: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    """(by..., x, y, r) of every pair of columns, over rows that have both; one pass over the rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = rows.groupBy(*by).agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    flat = F.explode(F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.round(F.col(f"`{a}|{b}`"), 6).alias("r")) for a, b in pairs]))
    return one.select(*by, flat.alias("c")).select(*by, "c.*")


def spearman(rows: DataFrame, by: list[str], a: str, b: str, sign: int = 1, least: int = 5) -> DataFrame:
    """(by..., n, rho): correlation of average ranks times `sign`; groups with fewer than `least` rows are left out."""
    some = rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(*by, F.col(a).alias("_a"), F.col(b).alias("_b"))
    ranked = some
    for c in ("_a", "_b"):
        n = some.groupBy(*by, c).agg(F.count(F.lit(1)).alias("n"))
        r = running_total(n, by, [F.col(c)], "n", "upto").select(*by, c, (F.col("upto") - (F.col("n") - 1) / 2).alias(f"r{c}"))
        ranked = ranked.join(r, [*by, c])
    return ranked.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.round(sign * F.corr("r_a", "r_b"), 6).alias("rho")).where(F.col("n") >= least)


def histogram(rows: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """(bin, n): equal bins of [low, high), values outside in bins 0 and bins + 1; null and NaN are left out."""
    v = F.when(~F.isnan(column), F.col(column))
    return rows.select(F.width_bucket(v, F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).where("bin is not null").groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


def equal_frequency_edges(rows: DataFrame, column: str, bins: int) -> DataFrame:
    """(edges): interpolated quantiles, equal ones collapsed."""
    out = percentiles(rows, column, [100 * i / bins for i in range(bins + 1)], [])
    return out.select(F.array_distinct(F.transform("p", lambda x: F.round(x, 6))).alias("edges"))


def heatmap(rows: DataFrame, x: Column, y: Column, value: str, least: int) -> DataFrame:
    """(x, y, n, mean): cell means, null in cells of fewer than `least` rows."""
    c = rows.groupBy(x.alias("x"), y.alias("y")).agg(F.count(value).alias("n"), F.avg(value).alias("m"))
    return c.select("x", "y", "n", F.round(F.when(F.col("n") >= least, F.col("m")), 6).alias("mean"))


def allocation(total: int, shares: dict[str, float], rest: str) -> dict[str, int]:
    """Whole numbers by fixed shares; what rounding down leaves goes to `rest`."""
    out = {k: int(total * s) for k, s in shares.items()}
    out[rest] = out.get(rest, 0) + total - sum(out.values())
    return out


def planned(rows: DataFrame, key: str, families: list[str], seed: int) -> DataFrame:
    """(key, family, severity): a seeded plan per key, the same in every run and partitioning."""
    h = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string"))), 1, 8), 16, 10).cast("bigint") % (len(families) * 3)
    return rows.select(key, F.get(F.array(*map(F.lit, families)), (h % len(families)).cast("int")).alias("family"), (F.floor(h / len(families)) + 1).cast("int").alias("severity"))
