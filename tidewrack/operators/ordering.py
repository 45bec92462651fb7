"""Order statistics over groups of any size: running totals without putting a group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidewrack.session import cut


def running_total(df: DataFrame, group: list[str], order: list[Column], weight: str, into: str, total: str | None = None) -> DataFrame:
    """Add `into`, the sum of `weight` over the rows of the group up to and with this one in `order`; and `total`, that of all.

    Rows are range-partitioned by (group, order), so a group that holds most rows is spread over many tasks; each
    task sums its own stretch and adds the total of the stretches before it, of which there are (groups + tasks).
    Rows equal in `order` share one total. Null group values form a group. An empty input gives an empty result.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("__group", F.struct(*[F.col(c) for c in group]))
    ranged = cut(keyed.repartitionByRange(n, F.col("__group"), *order).withColumn("__part", F.spark_partition_id()))
    sums = ranged.groupBy("__group", "__part").agg(F.sum(weight).alias("__sum"))
    before = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    of_all = [F.sum("__sum").over(Window.partitionBy("__group")).alias(total)] if total else []
    sums = sums.select("__group", "__part", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"), *of_all)
    here = F.sum(weight).over(Window.partitionBy("__group", "__part").orderBy(*order))
    return ranged.withColumn("__here", here).join(sums, ["__group", "__part"]).withColumn(into, F.col("__here") + F.col("__before")).drop("__group", "__part", "__here", "__before")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first `k` rows of each group in `order`; each task keeps only its own first `k` before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def spread(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The rows with `__group` and `__part`, range-partitioned by (group, order): part by part, a group's rows are in order."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("__group", F.struct(*[F.col(c) for c in group]))
    return cut(keyed.repartitionByRange(n, F.col("__group"), *order).withColumn("__part", F.spark_partition_id()))


def here(order: list[Column]) -> WindowSpec:
    """The window of a row's group within its part, for `spread` rows."""
    return Window.partitionBy("__group", "__part").orderBy(*order)


def with_carry(rows: DataFrame, value: Column, combine: str, into: str) -> DataFrame:
    """Add `into`: the aggregate `value` of all earlier parts of the row's group, combined by sum, max or last; null if none."""
    per = rows.groupBy("__group", "__part").agg(value.alias("__v"))
    before = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    how = {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}[combine]
    return rows.join(per.select("__group", "__part", how("__v").over(before).alias(into)), ["__group", "__part"])


def percentiles(df: DataFrame, column: str, percents: list[float], group: list[str]) -> DataFrame:
    """(group..., n, p: array) of interpolated percentiles (0 to 100) of the values present.

    Values are counted, the counts summed up over range partitions: the state of a group is never held in one place.
    """
    some = df.where(F.col(column).isNotNull()).select(*group, F.lit(0).alias("__all"), F.col(column).cast("double").alias("__value"))
    keys = [*group, "__all"]
    counts = some.groupBy(*keys, "__value").agg(F.count(F.lit(1)).alias("__c"))
    upto = running_total(counts, keys, [F.col("__value")], "__c", "__upto")
    total = counts.groupBy(*keys).agg(F.sum("__c").alias("n"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    rows = upto.alias("a").join(total.alias("b"), same).select(*[F.col(f"a.{k}") for k in group], "__value", "__upto", "n")
    ends = []
    for p in percents:
        at = (F.col("n") - 1) * (p / 100)
        ends += [F.min(F.when(F.col("__upto") > F.floor(at), F.col("__value"))), F.min(F.when(F.col("__upto") > F.ceil(at), F.col("__value")))]
    out = rows.groupBy(*group, "n").agg(*[e.alias(f"__{i}") for i, e in enumerate(ends)])
    between = [F.col(f"__{2 * i}") + (F.col(f"__{2 * i + 1}") - F.col(f"__{2 * i}")) * ((F.col("n") - 1) * (p / 100) - F.floor((F.col("n") - 1) * (p / 100))) for i, p in enumerate(percents)]
    return out.select(*group, "n", F.array(*between).alias("p"))
