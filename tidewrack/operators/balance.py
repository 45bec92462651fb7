"""Work per key when a handful of keys hold most rows: keys are packed into tasks, large keys are split into shards.

The loads of all keys are counted with map-side combination. A key above the fair load of a task is split into as many
shards as it holds fair loads, so there are fewer than twice as many shards as tasks; all other keys fall into a fixed
number of hash bins per task. Shards and bins, both bounded by the number of tasks, are packed on the driver, the
largest first onto the least loaded task. Only this plan is broadcast: its size depends on the tasks, not on the data.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.session import cut

BINS_PER_TASK = 8


@dataclass(frozen=True)
class Plan:
    key: str
    tasks: int
    bins: int
    first: dict[object, tuple[int, int]]  # heavy key: its first slot, its number of shards
    place: list[int]  # by slot: the value that hashes to the slot's task
    loads: list[int]  # planned rows by task


def _places(spark, tasks: int) -> list[int]:
    """By task, a number that Spark's hash partitioning sends to that task."""
    found: dict[int, int] = {}
    low, step = 0, max(64, tasks * 16)
    while len(found) < tasks:
        rows = spark.range(low, low + step).select("id", F.expr(f"pmod(hash(id), {tasks})").alias("t")).groupBy("t").agg(F.min("id").alias("id")).collect()
        for r in rows:
            found.setdefault(r.t, r.id)
        low += step
    return [found[t] for t in range(tasks)]


def plan(df: DataFrame, key: str, tasks: int | None = None) -> Plan:
    """Count the load of every key and pack the keys into `tasks` (by default spark.sql.shuffle.partitions)."""
    spark = df.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bins = tasks * BINS_PER_TASK
    loads = cut(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_load")))
    total = loads.agg(F.sum("_load")).first()[0] or 0
    fair = max(1, -(-total // tasks))
    heavy = loads.where(F.col("_load") > fair).collect()  # fewer than `tasks` rows: each holds more than total / tasks
    light = loads.where(F.col("_load") <= fair).groupBy(F.pmod(F.xxhash64(key), F.lit(bins)).alias("b")).agg(F.sum("_load").alias("n")).collect()
    first: dict[object, tuple[int, int]] = {}
    sizes: list[int] = []
    for r in sorted(heavy, key=lambda r: (-r["_load"], str(r[key]))):
        n = -(-r["_load"] // fair)
        first[r[key]] = (len(sizes), n)
        sizes += [-(-r["_load"] // n)] * n
    base = len(sizes)
    sizes += [0] * bins
    for r in light:
        sizes[base + r.b] = r.n
    heap = [(0, t) for t in range(tasks)]
    task_of, planned = [0] * len(sizes), [0] * tasks
    for slot in sorted(range(len(sizes)), key=lambda s: (-sizes[s], s)):
        n, t = heapq.heappop(heap)
        task_of[slot], planned[t] = t, n + sizes[slot]
        heapq.heappush(heap, (n + sizes[slot], t))
    values = _places(spark, tasks)
    return Plan(key, tasks, bins, first, [values[t] for t in task_of], planned)


def _with_heavy(df: DataFrame, p: Plan) -> DataFrame:
    spark = df.sparkSession
    kind = df.schema[p.key].dataType.simpleString()
    rows = [(k, a, n) for k, (a, n) in p.first.items()]
    known = spark.createDataFrame(rows, f"_k {kind}, _first int, _shards int")
    return df.join(F.broadcast(known), F.col(p.key) == F.col("_k"), "left").drop("_k")


def _slot(p: Plan, shard: Column) -> Column:
    light = F.lit(sum(n for _, n in p.first.values())) + F.pmod(F.xxhash64(p.key), F.lit(p.bins)).cast("int")
    return F.when(F.col("_first").isNotNull(), F.col("_first") + shard.cast("int")).otherwise(light)


def shard(df: DataFrame, p: Plan, by: list[str]) -> DataFrame:
    """Add `_slot` and `_place`; rows of a split key go to the shard of the hash of `by`. Rows without a key are left out."""
    rows = _with_heavy(df.where(F.col(p.key).isNotNull()), p)
    rows = rows.withColumn("_slot", _slot(p, F.pmod(F.xxhash64(*by), F.col("_shards"))))
    return _placed(rows.drop("_first", "_shards"), p)


def _placed(rows: DataFrame, p: Plan) -> DataFrame:
    """Add `_place`, the value that hashes to the task of `_slot`; the table of slots has some nine rows a task."""
    slots = rows.sparkSession.createDataFrame(list(enumerate(p.place)), "_slot int, _place bigint")
    return rows.join(F.broadcast(slots), "_slot")


def balanced_distinct_count(df: DataFrame, key: str, member: list[str], extra: dict[str, Column], tasks: int | None = None) -> DataFrame:
    """Per key: `members`, its distinct values of `member`, and the `extra` aggregates (mergeable min/max only, by name).

    Repeated members are combined before the shuffle. A member always falls into the same shard, so the shards' counts
    add up exactly. Null keys give no row; an empty table gives none; a null in `member` counts as a value of its own.
    """
    parts = df.groupBy(key, *member).agg(*[c.alias(n) for n, c in extra.items()])
    p = plan(parts, key, tasks)
    placed = shard(parts, p, member).repartition(p.tasks, "_place")
    again = {n: (F.min if n.startswith("min_") else F.max)(n).alias(n) for n in extra}
    by_shard = placed.groupBy("_place", "_slot", key).agg(F.count(F.lit(1)).alias("members"), *again.values())
    return by_shard.groupBy(key).agg(F.sum("members").alias("members"), *again.values())


def fragment_replicate_join(left: DataFrame, right: DataFrame, key: str, by: list[str], tasks: int | None = None) -> DataFrame:
    """Inner join on `key`; large keys of `left` are split by the hash of `by`, and `right` is copied to those shards only.

    Both sides go to the tasks that the plan has packed, and the join runs there: it is told that rows of one place lie
    together, whatever else it is keyed by (as Spark keeps to from as many tasks on as there are shuffle partitions, the default).
    Null keys match nothing. `by` should tell rows of one key apart. Columns other than
    `key` must differ in name.
    """
    p = plan(left, key, tasks)
    left.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    a = shard(left, p, by).repartition(p.tasks, "_place")
    b = _with_heavy(right.where(F.col(key).isNotNull()), p)
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_shards"), F.lit(1)) - 1)
    b = b.withColumn("_copy", F.explode(copies)).withColumn("_slot", _slot(p, F.col("_copy"))).drop("_copy", "_first", "_shards")
    return a.join(_placed(b, p).repartition(p.tasks, "_place"), ["_place", key, "_slot"]).drop("_slot", "_place")


def cluster_sizes(clusters: DataFrame, tasks: int | None = None) -> DataFrame:
    """(text_cluster_id, members, min_recorded, max_recorded, is_stale) of a clusters table.

    `members` counts distinct (dataset, cut_id); the recorded sizes are over the rows whose cluster_size is not null (null
    if there is none); a cluster is stale if any recorded size differs from `members`. Rows without an id give nothing.
    """
    rows = clusters.select("text_cluster_id", "dataset", "cut_id", "cluster_size")
    sizes = {"min_recorded": F.min("cluster_size"), "max_recorded": F.max("cluster_size")}
    counts = balanced_distinct_count(rows, "text_cluster_id", ["dataset", "cut_id"], sizes, tasks)
    differs = (F.col("min_recorded") != F.col("members")) | (F.col("max_recorded") != F.col("members"))
    return counts.withColumn("is_stale", F.coalesce(differs, F.lit(False)))


def records_with_sizes(clusters: DataFrame, tasks: int | None = None) -> DataFrame:
    """Every row of the clusters table that has an id, next to the counted size of its cluster (fragment-replicate join)."""
    rows = clusters.select("text_cluster_id", "dataset", "cut_id", "cluster_size")
    counts = cluster_sizes(clusters, tasks).select("text_cluster_id", "members")
    return fragment_replicate_join(rows, counts, "text_cluster_id", ["dataset", "cut_id"], tasks)
