"""Joins whose broadcast side has a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows and bytes up to which a side may be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 16 << 20


def bounded(small: DataFrame, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """`small` with a broadcast hint if it has at most `limit` rows and about `most` bytes, which are counted; else as it is, for
    a shuffle join. Strings and arrays count by their length as JSON, everything else as eight bytes.

    Give it a table that is cheap to read twice (a checkpoint or a written table).
    """
    wide = [c for c, kind in small.dtypes if kind == "string"]
    nested = [c for c, kind in small.dtypes if kind.startswith(("array", "map", "struct"))]
    size = F.lit(8 * len(small.columns))
    for c in wide:
        size = size + F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0))
    if nested:
        size = size + F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in nested])))
    rows, total = small.limit(limit + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    return F.broadcast(small) if rows <= limit and (total or 0) <= most else small


def full_outer_slots(slots: dict[str, DataFrame], key: list[str], meta: list[str]) -> DataFrame:
    """Tables of several sources by key, none lost: one column `has_<slot>` each, a map slot -> text, and of `meta` the first
    non-null value in the order of the slots. Each table has key, meta and `text`, one row a key.

    It is one union and one grouped aggregate, not a chain of outer joins, so rows are shuffled once whatever the slots.
    """
    parts = [df.select(*key, F.lit(i).alias("_i"), F.lit(name).alias("_slot"), "text", *meta) for i, (name, df) in enumerate(slots.items())]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    first = [F.min(F.when(F.col(m).isNotNull(), F.struct("_i", m)))[m].alias(m) for m in meta]
    has = [F.max(F.col("_slot") == n).alias(f"has_{n}") for n in slots]
    entries = F.sort_array(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("_slot", "text"))))
    return rows.groupBy(*key).agg(*first, *has, F.map_from_entries(entries).alias("hypotheses"))


def first_per_key(df: DataFrame, key: str, order: list[str], last: bool = False) -> DataFrame:
    """One row per key: the first (or last) in `order`, by one aggregate combined before the shuffle."""
    rest = [c for c in df.columns if c not in (key, *order)]
    pick = (F.max if last else F.min)(F.struct(*order, *rest)).alias("_r")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(pick).select(key, *[F.col(f"_r.{c}").alias(c) for c in (*order, *rest)])


def fallback_lookup(df: DataFrame, lookup: DataFrame, path: str, name: str, value: str, extension: str) -> DataFrame:
    """Add `value` and `matched_by` of the first of these names that `lookup` (name, value) knows: the path itself, its last
    part, and both with the extension appended. `df` needs a unique column `row_id`; the last duplicate name wins upstream.
    """
    base = F.substring_index(path, "/", -1)
    names = F.array(*[F.struct(F.lit(i).alias("p"), c.alias("n")) for i, c in enumerate((F.col(path), base, F.concat(F.col(path), F.lit(extension)), F.concat(base, F.lit(extension))))])
    tries = df.select("row_id", F.explode(names).alias("x")).select("row_id", "x.p", F.col("x.n").alias("n"))
    hits = tries.join(lookup.select(F.col(name).alias("n"), F.col(value).alias("v")), "n").groupBy("row_id").agg(F.min(F.struct("p", "v")).alias("h"))
    return df.join(hits, "row_id", "left").select(*df.columns, F.col("h.v").alias(value), F.col("h.p").alias("matched_by"))


def overridden(df: DataFrame, text: str, custom: str, new_text: str, new_custom: str) -> DataFrame:
    """`text` replaced where there is a new one, and the maps merged, the new entries winning."""
    old, new = F.coalesce(custom, F.create_map().cast("map<string,string>")), F.coalesce(new_custom, F.create_map().cast("map<string,string>"))
    kept = F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k))
    return df.withColumn(text, F.coalesce(new_text, text)).withColumn(custom, F.map_concat(kept, new))


def three_way(metadata: DataFrame, languages: DataFrame, spans: DataFrame, key: str) -> DataFrame:
    """Inner join on the key of metadata (first `_order` wins), languages (last wins) and spans (first wins)."""
    a = first_per_key(metadata, key, ["m_order"])
    b = first_per_key(languages, key, ["l_order"], last=True)
    c = first_per_key(spans, key, ["s_order"])
    return a.join(b, key).join(c, key)


def unmatched(df: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is not among those done."""
    return df.join(done.select(*key).distinct(), key, "left_anti")


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """(key..., n) of keys that stand more than once; empty if the key is unique."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def assert_unique(df: DataFrame, key: list[str]) -> None:
    some = repeated_keys(df, key).limit(5).collect()
    if some:
        raise ValueError(f"{key} is not unique, for example {[tuple(r) for r in some]}")
