import random

from pyspark.sql import functions as F

from tidewrack.operators.balance import cluster_sizes, fragment_replicate_join, plan, records_with_sizes
from tidewrack.operators.ordering import running_total, top_per_group

SCHEMA = "dataset string, cut_id string, text_cluster_id long, cluster_size long, members string, _slot int"


def brute(rows):
    members, sizes = {}, {}
    for d, c, k, s, *_ in rows:
        if k is not None:
            members.setdefault(k, set()).add((d, c))
            if s is not None:
                sizes.setdefault(k, set()).add(s)
    return {k: (len(m), k in sizes and sizes[k] != {len(m)}) for k, m in members.items()}


def test_hot_keys_repeats_and_nulls(spark):
    random.seed(3)
    rows = []
    for i in range(3000):  # one key holds two thirds
        k = 7 if random.random() < 0.66 else random.choice([None, *range(100)])
        rows.append((random.choice(["a", "b", None]), random.choice([None, *map(str, range(900))]), k, random.choice([None, 1, 2, 500]), "x", 1))
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.text_cluster_id: (r.members, r.is_stale) for r in cluster_sizes(df, 5).collect()}
    assert got == brute(rows)
    joined = records_with_sizes(df, 5).collect()
    assert len(joined) == sum(r[2] is not None for r in rows)
    assert all(r.members == got[r.text_cluster_id][0] for r in joined)


def test_plan_is_balanced_and_bounded(spark):
    df = spark.range(10000).select(F.when(F.col("id") < 5000, F.lit(1)).otherwise(F.col("id")).alias("k"))
    p = plan(df, "k", 8)
    assert sum(p.loads) == 10000 and max(p.loads) <= 1.5 * 10000 / 8
    assert len(p.place) <= 2 * 8 + 8 * 8


def test_single_record_repeated(spark):
    df = spark.createDataFrame([("a", "1", 5, 1, "", 0)] * 500, SCHEMA)
    assert [tuple(r) for r in cluster_sizes(df).select("text_cluster_id", "members", "is_stale").collect()] == [(5, 1, False)]


def test_empty(spark):
    assert cluster_sizes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_join_keeps_every_pair(spark):
    left = spark.range(200).select((F.col("id") % 3).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (9, "d"), (None, "e")], "k long, v string")
    got = sorted((r.k, r.id, r.v) for r in fragment_replicate_join(left, right, "k", ["id"], 4).collect())
    assert got == sorted((i % 3, i, v) for i in range(200) for k, v in [(0, "a"), (1, "b"), (1, "c")] if i % 3 == k)


def test_running_total_with_ties_and_null_groups(spark):
    rows = [(None, 1, 2), (None, 1, 3), (None, 2, 4), ("g", 5, 1)] + [("h", i, 1) for i in range(50)]
    df = spark.createDataFrame(rows, "g string, o int, w long")
    got = {(r.g, r.o, r.w): r.t for r in running_total(df, ["g"], [F.col("o")], "w", "t").collect()}
    assert got[None, 1, 2] == got[None, 1, 3] == 5 and got[None, 2, 4] == 9 and got["g", 5, 1] == 1
    assert all(got["h", i, 1] == i + 1 for i in range(50))


def test_top_per_group(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), "id")
    assert sorted(r.id for r in top_per_group(df, ["g"], [F.col("id").desc()], 2).collect()) == [96, 97, 98, 99]
