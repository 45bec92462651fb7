"""Connected components by alternating star steps: no task ever holds a component, lineage is cut every round."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.session import cut

#: Links up to this number are joined up in one task; their number is counted first.
IN_ONE_TASK = 100_000


def _joined_up(links: DataFrame, kind: str) -> DataFrame:
    """(u, v): every node of a bounded number of links with the smallest node of its component, by union-find in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def root(x):
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        schema = None
        for batch in batches:
            schema = batch.schema
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parent.setdefault(a, a)
                parent.setdefault(b, b)
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        if schema is not None:
            yield pa.RecordBatch.from_arrays([pa.array(list(parent), schema.field(0).type), pa.array([root(x) for x in parent], schema.field(0).type)], names=["u", "v"])

    return links.coalesce(1).mapInArrow(run, f"u {kind}, v {kind}")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", in_one_task: int = IN_ONE_TASK) -> DataFrame:
    """(node, root): the smallest node of each node's component, for all nodes of `edges`; rows with a null end are left out.

    A large-star step links a node's larger neighbours to the smallest node it sees, a small-star step its smaller ones;
    neighbours are never gathered, only their minimum is. It ends when a round changes nothing, after about log n rounds.
    Up to `in_one_task` links of plain numbers or strings are joined up in one task instead, with the same result.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    ends = cut(e.distinct())
    nodes = ends.select("u").union(ends.select("v")).distinct()
    links = ends.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    kind = links.schema["u"].dataType.simpleString()
    if kind in ("int", "bigint", "string") and ends.count() <= in_one_task:
        links = cut(_joined_up(links, kind))
        return nodes.join(links, nodes.u == links.u, "left").select(nodes.u.alias("node"), F.coalesce(links.v, nodes.u).alias("root"))
    links = cut(links)
    state = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = cut(low.select("u", F.col("m").alias("v")).union(small).distinct())
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    return nodes.join(links, nodes.u == links.u, "left").select(nodes.u.alias("node"), F.coalesce(links.v, nodes.u).alias("root"))
