"""Problem 5: one group per set of linked records, by union-find within partitions and merging of spanning forests."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.operators.joins import bounded
from tidewrack.session import cut

#: Edges that one union-find holds at most; larger partitions are worked off in blocks of this size.
EDGES_AT_ONCE = 500_000
FOREST = "node string, root string"
#: Star steps settle a graph in about the square of the logarithm of its nodes at worst.
MOST_ROUNDS = 500


def _forest(edges_at_once: int):
    """A function over Arrow batches of (node, root): spanning stars (node, smallest node of its tree), a block at a time."""

    def stars(parent: dict[str, str]) -> pa.RecordBatch:
        nodes, roots = [], []
        for x in parent:
            r = x
            while parent[r] != r:
                r = parent[r]
            while parent[x] != r:
                parent[x], x = r, parent[x]
        for x, r in parent.items():
            nodes.append(x)
            roots.append(r)
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.string()), pa.array(roots, pa.string())], names=["node", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[str, str] = {}
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ra, rb = parent.setdefault(a, a), parent.setdefault(b, b)
                while parent[ra] != ra:
                    parent[ra] = parent[parent[ra]]
                    ra = parent[ra]
                while parent[rb] != rb:
                    parent[rb] = parent[parent[rb]]
                    rb = parent[rb]
                if ra < rb:
                    parent[rb] = ra
                elif rb < ra:
                    parent[ra] = rb
            if len(parent) > edges_at_once:
                yield stars(parent)
                parent = {}
        if parent:
            yield stars(parent)

    return run


def _star_round(forest: DataFrame) -> DataFrame:
    """One large-star and one small-star step: every node moves to the smallest node it can see."""
    e = forest.where("node <> root")
    both = e.union(e.select(F.col("root").alias("node"), F.col("node").alias("root")))
    low = both.groupBy("node").agg(F.min("root").alias("m")).select("node", F.least("node", "m").alias("m"))
    large = both.join(low, "node").where(F.col("root") > F.col("node")).select(F.col("root").alias("node"), F.col("m").alias("root"))
    large = large.where("node <> root").distinct()
    least = large.groupBy("node").agg(F.min("root").alias("m"))
    moved = large.join(least, "node").where(F.col("root") > F.col("m")).select(F.col("root").alias("node"), F.col("m").alias("root"))
    return least.select("node", F.col("m").alias("root")).union(moved).distinct()


def components(edges: DataFrame, edges_at_once: int = EDGES_AT_ONCE) -> DataFrame:
    """(node, root) of every node of `edges` (a, b, both strings): the smallest node, in byte order, of its component.

    Each scan task keeps a spanning forest of its own edges; the forests are merged in ever fewer partitions, none of which
    holds more than `edges_at_once` edges. If the forest of all is larger than one partition may be, the merged forests are
    contracted to their roots: only nodes that stand in several trees link two of them, so hubs and leaves are gone, and the
    graph of roots is finished by star steps, which need no memory per component. A node linked only with itself is its own root.
    """
    spark = edges.sparkSession
    run = _forest(edges_at_once)
    forest = cut(edges.selectExpr("a as node", "b as root").mapInArrow(run, FOREST))
    n, parts = forest.count(), max(1, forest.rdd.getNumPartitions())
    while parts > 1 or n > edges_at_once:
        fewer = max(-(-n // edges_at_once), -(-parts // 8))
        if n <= edges_at_once // 4:
            fewer = 1
        if fewer >= parts and n > edges_at_once:
            break
        forest = cut(forest.repartition(fewer, "root").mapInArrow(run, FOREST))
        n, parts = forest.count(), fewer
    else:
        return forest.distinct()
    # a node has at most one root from every partition and block
    trees = cut(forest.groupBy("node").agg(F.min("root").alias("least"), F.collect_set("root").alias("roots")))
    links = cut(trees.select(F.explode("roots").alias("node"), F.col("least").alias("root")).where("node <> root").distinct())
    seen = None
    for _ in range(MOST_ROUNDS):
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen, links = now, cut(_star_round(links))
    else:
        raise RuntimeError(f"components are not settled after {MOST_ROUNDS} rounds")
    final = bounded(links.select(F.col("node").alias("least"), "root"))
    return trees.select("node", "least").join(final, "least", "left").select("node", F.coalesce("root", "least").alias("root"))


def record_groups(match_edges: DataFrame, edges_at_once: int = EDGES_AT_ONCE) -> DataFrame:
    """(dataset, cut_id, group_dataset, group_cut_id) of every record on either side of `match_edges`.

    Text and sound links count alike, and scores play no part. A record matched only with itself is its own group. A side
    whose dataset or cut_id is null is no record; the other side then still comes out. An empty table gives no rows.
    """
    def key(side: str):
        return F.when(F.col(f"{side}_dataset").isNotNull() & F.col(f"{side}_cut_id").isNotNull(), F.concat(F.col(f"{side}_dataset"), F.lit("\0"), F.col(f"{side}_cut_id")))

    sides = match_edges.select(key("src").alias("s"), key("dst").alias("d"))
    edges = sides.select(F.coalesce("s", "d").alias("a"), F.coalesce("d", "s").alias("b")).where("a is not null")
    out = components(edges, edges_at_once)

    def part(c: str, i: int):
        return F.split(F.col(c), "\0", 2)[i]

    return out.select(part("node", 0).alias("dataset"), part("node", 1).alias("cut_id"), part("root", 0).alias("group_dataset"), part("root", 1).alias("group_cut_id"))
