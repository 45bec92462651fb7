"""Near-duplicate texts: shingles, signatures, candidates, exact verification and groups."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.operators import buckets as bucketed
from tidewrack.operators.components import connected_components
from tidewrack.operators.ordering import here, spread, with_carry
from tidewrack.session import cut, stored, widened

SHINGLE, THRESHOLD = 5, 0.8
PRIME = 2147483647
_SPACE = re.compile(r"[ \t\n\r]+")
_TOKEN = re.compile(r"\w+")
#: A bucket or shingle that more rows hold than this is met in several shards.
SHARD = 500


def shingle_sets(df: DataFrame, key: str, text: str, n: int = SHINGLE, tokens: bool = False) -> DataFrame:
    """(id, shingles): the distinct runs of `n` words of each text, sorted; a shorter text is one run, one without words none.

    Words stand between spaces; with `tokens` they are runs of letters, digits and underscores. Made in Arrow batches: the
    array functions that could build them are interpreted, at some twenty times the cost.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sets = [], []
            for i, t in enumerate(batch.column(1).to_pylist()):
                w = _TOKEN.findall(t or "") if tokens else [x for x in _SPACE.split(t or "") if x]
                if w:
                    keep.append(i)
                    sets.append(sorted({" ".join(w[j : j + n]) for j in range(max(1, len(w) - n + 1))}))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(sets, pa.list_(pa.string()))], names=["id", "shingles"])

    return widened(df.select(key, text)).mapInArrow(run, f"id {kind}, shingles array<string>")


def char_sets(df: DataFrame, key: str, text: str, n: int = 12, pad: bool = True) -> DataFrame:
    """(id, shingles): the distinct runs of `n` characters of each text, sorted; a shorter text is one run, filled up with NUL
    if `pad`; an empty or null one gives no row."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            keep = [i for i, t in enumerate(texts) if t]
            sets = [sorted({t[j : j + n] for j in range(len(t) - n + 1)} or {t.ljust(n, "\0") if pad else t}) for t in (texts[i] for i in keep)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(sets, pa.list_(pa.string()))], names=["id", "shingles"])

    return widened(df.select(key, text)).mapInArrow(run, f"id {kind}, shingles array<string>")


def base_hash(c: Column) -> Column:
    """60 bits of md5, reduced below PRIME; the same in any engine that has md5."""
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("bigint") % PRIME


def permutations(k: int) -> list[tuple[int, int]]:
    return [((i * 2654435761 + 12345) % (PRIME - 1) + 1, (i * 40503 + 977) % PRIME) for i in range(1, k + 1)]


def minhash(sets: DataFrame, k: int) -> DataFrame:
    """(id, signature): for each of `k` affine permutations the least image of the set; hashes are made once a shingle."""
    hashed = sets.select("id", F.explode("shingles").alias("s")).select("id", base_hash(F.col("s")).alias("h"))
    least = [F.min((F.col("h") * a + b) % PRIME).alias(f"m{i}") for i, (a, b) in enumerate(permutations(k))]
    return hashed.groupBy("id").agg(*least).select("id", F.array(*[f"m{i}" for i in range(k)]).alias("signature"))


def buckets(signatures: DataFrame, bands: int, width: int) -> DataFrame:
    """(band, bucket, id): one row per text and band; raises where `bands` * `width` exceed a signature."""
    size = F.size("signature")
    whole = F.when(size < bands * width, F.raise_error(F.lit("the bands are longer than the signature"))).otherwise(F.col("signature"))
    signatures = signatures.select("id", whole.alias("signature"))
    slices = [F.struct(F.lit(i).alias("band"), F.md5(F.array_join(F.slice("signature", i * width + 1, width).cast("array<string>"), ",")).alias("bucket")) for i in range(bands)]
    return signatures.select("id", F.explode(F.array(*slices)).alias("b")).select("b.band", "b.bucket", "id")


def signature_classes(signatures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct signatures, named by their smallest id, and (id, rep) of all: texts of one signature stand for each other."""
    reps = cut(signatures.groupBy("signature").agg(F.min("id").alias("id")))
    return reps.select("id", "signature"), signatures.join(reps.withColumnRenamed("id", "rep"), "signature").select("id", "rep")


def candidates(rows: DataFrame, shard: int = SHARD) -> DataFrame:
    """(a, b), a < b, distinct: all pairs that share a bucket, in buckets of any size.

    Give it the buckets of `signature_classes`, so that copies are not paired off with each other. A bucket of more than
    `shard` members is met in several shards, so it is not the work of one task.
    """
    n = rows.groupBy("band", "bucket").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    both = cut(rows.join(n, ["band", "bucket"]))
    x = both.select("band", "bucket", F.pmod(F.xxhash64("id"), "shards").cast("int").alias("shard"), F.col("id").alias("a"))
    y = both.select("band", "bucket", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.col("id").alias("b"))
    return x.join(y, ["band", "bucket", "shard"]).where("a < b").select("a", "b").distinct()


def chained(rows: DataFrame) -> DataFrame:
    """(band, a, b): each member of a bucket with the one before it, m - 1 pairs for m members, also of a bucket of most rows."""
    order = [F.col("id")]
    parts = with_carry(spread(rows.select("band", "bucket", "id"), ["band", "bucket"], order), F.max("id"), "max", "_last")
    before = F.coalesce(F.lag("id").over(here(order)), F.col("_last"))
    return parts.select("band", before.alias("a"), F.col("id").alias("b")).where("a is not null")


def estimated(pairs: DataFrame, signatures: DataFrame, k: int) -> DataFrame:
    """(a, b, estimate): the share of equal signature components."""
    a, b = (signatures.select(F.col("id").alias(x), F.col("signature").alias(f"s{x}")) for x in "ab")
    equal = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return pairs.join(a, "a").join(b, "b").select("a", "b", (equal / k).alias("estimate"))


def verified(pairs: DataFrame, sets: DataFrame, threshold: float = THRESHOLD, min_shared: int = 0, containment: bool = False) -> DataFrame:
    """(a, b, shared, score) of pairs whose exact similarity reaches the threshold; without a shared shingle none does."""
    a, b = (sets.select(F.col("id").alias(x), F.col("shingles").alias(f"s{x}")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").withColumn("shared", F.size(F.array_intersect("sa", "sb")))
    base = F.least(F.size("sa"), F.size("sb")) if containment else F.size("sa") + F.size("sb") - F.col("shared")
    return both.withColumn("score", F.col("shared") / base).where((F.col("shared") > 0) & (F.col("shared") >= min_shared) & (F.col("score") >= threshold)).select("a", "b", "shared", "score")


def distinct_sets(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sets once each, named by their smallest id, and (id, rep) of all texts; copies are joined by their hash."""
    keyed = stored(sets.withColumn("k", F.sha2(F.array_join("shingles", "\n"), 256)), "sets")
    first = stored(keyed.groupBy("k").agg(F.min("id").alias("rep")), "reps")
    reps = keyed.join(first, "k").where("id = rep").select("id", "shingles")
    return reps, keyed.select("k", "id").join(first, "k").select("id", "rep")


def similar_pairs(reps: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, shared, score), a < b: all pairs of sets with at least this Jaccard similarity, none left out.

    Shingles are ordered from the rarest; two such sets must share one among the first n - ceil(threshold * n) + 1 of
    each, so only those are joined, under the length bound. Common shingles hardly ever come that far forward. Shingles are
    compared by 64-bit hashes, equal ones only adding a candidate; what is returned is verified on the shingles themselves.
    """
    rows = reps.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("s")).select("id", "n", F.xxhash64("s").alias("h"))
    seen = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df"))
    ranked = rows.join(seen, "h").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("o"))
    keep = F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)).cast("int") + 1
    prefix = ranked.select("id", "n", F.explode(F.slice("o", 1, keep)).alias("p")).where("p.df > 1")
    prefix = stored(prefix.select("id", "n", F.col("p.h").alias("h"), F.ceil(F.col("p.df") / SHARD).cast("int").alias("shards")), "prefix")
    x = prefix.withColumn("shard", F.pmod(F.xxhash64("id"), "shards").cast("int")).alias("x")
    y = prefix.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).alias("y")
    near = (F.least("x.n", "y.n") >= F.greatest("x.n", "y.n") * F.lit(threshold) - F.lit(1e-9))
    same = (F.col("x.h") == F.col("y.h")) & (F.col("x.shard") == F.col("y.shard"))
    pairs = x.join(y, same & (F.col("x.id") < F.col("y.id")) & near).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    return verified(pairs, reps, threshold)


def contained_pairs(sets: DataFrame, threshold: float = THRESHOLD, min_shared: int = 1) -> DataFrame:
    """(a, b, shared, score), a < b: all pairs that share this part of the smaller set and `min_shared` shingles, none left out.

    Of n shingles of the smaller set, ordered from the rarest, the larger one holds at least `need`, so also one of the first
    n - need + 1, however long it is: those are looked up among all shingles of the others. Shingles of one text only come
    first and meet nothing, so only the rest is ordered. Hashes only add candidates, as in `similar_pairs`.
    """
    rows = sets.select("id", F.size("shingles").alias("n"), F.explode("shingles").alias("s")).select("id", "n", F.xxhash64("s").alias("h"))
    seen = F.count(F.lit(1)).over(Window.partitionBy("h"))  # counts and rows in one shuffle, which is the bulk of the disk
    shared = stored(rows.withColumn("df", seen).where("df > 1"), "shared")
    need = F.greatest(F.lit(min_shared), F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)).cast("int"))
    ranked = shared.groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("o"))
    prefix = ranked.select("id", "n", F.explode(F.slice("o", 1, F.greatest(F.size("o") - need + 1, F.lit(0)))).alias("p")).select("id", "n", F.col("p.h").alias("h"))
    x, y = prefix.alias("x"), shared.alias("y")
    larger = (F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.id") < F.col("y.id")))
    pairs = x.join(y, (F.col("x.h") == F.col("y.h")) & larger).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
    pairs = stored(pairs, "pairs")
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    return verified(pairs, stored(sets.join(ends, "id", "left_semi"), "sets"), threshold, min_shared, True)


def duplicate_classes(df: DataFrame, key: str, text: str, n: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """(id, class_id, class_size, links): texts linked directly or indirectly by exact Jaccard similarity of word shingles.

    Copies are one vertex; `links` counts the other texts, copies included, that are similar enough to this one.
    """
    reps, membership = distinct_sets(shingle_sets(df, key, text, n))
    pairs = stored(similar_pairs(reps, threshold), "pairs")
    roots = connected_components(pairs)
    copies = membership.groupBy("rep").agg(F.count(F.lit(1)).alias("copies"))
    ends = pairs.select(F.col("a").alias("rep"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    links = ends.join(copies.withColumnRenamed("rep", "other"), "other").groupBy("rep").agg(F.sum("copies").alias("near"))
    classes = copies.join(roots, F.col("rep") == F.col("node"), "left").join(links, "rep", "left")
    classes = classes.select("rep", F.coalesce("root", "rep").alias("class_id"), (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("links"), "copies")
    sizes = classes.groupBy("class_id").agg(F.sum("copies").alias("class_size"))
    return membership.join(classes.drop("copies"), "rep").join(sizes, "class_id").select("id", "class_id", "class_size", "links")


def lsh_clusters(df: DataFrame, key: str, text: str, threshold: float = THRESHOLD, max_fraction: float | None = None) -> DataFrame:
    """(id, cluster_id, cluster_size): clusters of two or more texts, numbered from 0 by their smallest text.

    Equal sets are one vertex; the pairs are those of `similar_pairs`, so none is lost to banding, estimates or the size of a
    bucket. If more than `max_fraction` of the texts end up in clusters, it raises: the parameters are then too loose.
    """
    reps, membership = distinct_sets(shingle_sets(df, key, text))
    same = membership.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    edges = similar_pairs(reps, threshold).select("a", "b").union(same)
    return numbered(connected_components(edges), membership.select("id"), max_fraction)


def char_clusters(df: DataFrame, key: str, text: str, n: int = 12, threshold: float = 0.5, bands: int = 16, width: int = 2, shard: int = bucketed.SHARD) -> DataFrame:
    """(id, cluster_id, cluster_size) by character runs: signatures, banding, exact verification of all candidates, components.

    Equal texts are one vertex. At similarity s a pair is met with probability 1 - (1 - s ** width) ** bands. Neither sets nor
    candidates are written, see `operators/buckets`; a bucket of more than `shard` texts is met in shards. `key` is unique.
    """
    rows, folder = bucketed.signed(df, key, text, n, bands, width, permutations(bands * width), PRIME)
    members = rows.select("id", "node")
    near = bucketed.near_nodes(rows, folder, n, threshold, shard)
    groups = members.join(near, "node", "left").select("id", F.coalesce("root", "node").alias("g"))
    first = groups.groupBy("g").agg(F.min("id").alias("root"), F.count(F.lit(1)).alias("size")).where("size > 1").drop("size")
    return numbered(groups.join(first, "g").select(F.col("id").alias("node"), "root"), members.select("id"))


def containment_clusters(df: DataFrame, key: str, text: str, n: int = SHINGLE, threshold: float = THRESHOLD, min_shared: int = 3) -> DataFrame:
    """(id, cluster_id, cluster_size) of texts of which one holds the other, directly or through others, by runs of tokens."""
    reps, membership = distinct_sets(shingle_sets(df, key, text, n, tokens=True))
    edges = contained_pairs(reps, threshold, min_shared).select("a", "b")
    copies = membership.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    return numbered(connected_components(edges.union(copies)), membership.select("id"))


def numbered(roots: DataFrame, everything: DataFrame, max_fraction: float | None = None) -> DataFrame:
    """(id, cluster_id, cluster_size) of components of two or more, numbered densely by their root."""
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("cluster_size")).where("cluster_size > 1")
    dense = Window.partitionBy("part").orderBy("root")
    spread = cut(sizes.repartitionByRange("root").withColumn("part", F.spark_partition_id()))
    counts = spread.groupBy("part").agg(F.count(F.lit(1)).alias("c"))
    before = counts.withColumn("base", F.coalesce(F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("c")
    ids = spread.join(before, "part").select("root", "cluster_size", (F.row_number().over(dense) - 1 + F.col("base")).alias("cluster_id"))
    out = roots.join(ids, "root").select(F.col("node").alias("id"), "cluster_id", "cluster_size")
    if max_fraction is not None:
        inside, total = out.count(), everything.count()
        if total and inside > max_fraction * total:
            raise ValueError(f"{inside} of {total} texts are in clusters, more than the share {max_fraction}")
    return out


def frequent_texts(df: DataFrame, key: str, cap: int) -> DataFrame:
    """(text, n, over): the texts that occur more than `cap` times and how many rows lie over the cap; null is no text."""
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("text")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cap).withColumn("over", F.col("n") - cap)


def cap_report(df: DataFrame, key: str, caps: list[int]) -> DataFrame:
    """(cap, texts_over, rows_over) for each cap, from one count per text."""
    n = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    each = n.select(F.explode(F.array(*map(F.lit, caps))).alias("cap"), "n")
    return each.groupBy("cap").agg(F.count_if(F.col("n") > F.col("cap")).alias("texts_over"), F.sum(F.greatest(F.col("n") - F.col("cap"), F.lit(0))).alias("rows_over"))


def chaining_diagnosis(sizes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row on how far clusters are chains: percentiles of sizes (index floor(q * n), not interpolated), the rows in
    clusters above 10, 50, 100 and 1000, and the share that the links have of all links of full clusters.

    `sizes`: (cluster_size) a cluster; `edges`: any rows, one a link. Sizes are counted per value first; a percentile is
    taken from the running count over the distinct sizes.
    """
    by = sizes.groupBy("cluster_size").agg(F.count(F.lit(1)).alias("c"))
    run = by.withColumn("upto", F.sum("c").over(Window.orderBy("cluster_size"))).withColumn("n", F.sum("c").over(Window.partitionBy(F.lit(1))))
    pick = [F.min(F.when(F.col("upto") > F.least(F.floor(F.col("n") * q), F.col("n") - 1), F.col("cluster_size"))).alias(f"p{int(q * 100)}") for q in (0.5, 0.9, 0.99)]
    mass = [F.sum(F.when(F.col("cluster_size") > m, F.col("cluster_size") * F.col("c")).otherwise(0)).alias(f"rows_above_{m}") for m in (10, 50, 100, 1000)]
    full = F.sum(F.col("c") * F.col("cluster_size") * (F.col("cluster_size") - 1) / 2).alias("full_edges")
    one = run.agg(F.sum("c").alias("clusters"), F.max("cluster_size").alias("largest"), *pick, *mass, full)
    return one.crossJoin(F.broadcast(edges.agg(F.count(F.lit(1)).alias("edges")))).withColumn("density", F.round(F.col("edges") / F.col("full_edges"), 6))
