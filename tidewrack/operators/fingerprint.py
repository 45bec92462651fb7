"""Constellation fingerprints and their matching, over rows instead of tensors: (clip, t, f, energy) in, groups out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.operators.components import connected_components
from tidewrack.session import cut

# Frames per second, key point bins, partner distances, and the five fields of a signature with their widths.
FRAME_RATE, BIN_RATE = 40.0, 12.5
NEAREST, FARTHEST = 4, 20
FIELDS = {"fb": 6, "fk": 6, "ff": 6, "dtb": 4, "dtf": 4}
#: Groups above this size are first parted by shared hashes, of which two clips need so many.
LARGE_GROUP, MIN_SHARED = 200, 5
#: A hash that more postings of a group hold is met in several shards.
SHARD = 500


def packed(fb: Column, fk: Column, ff: Column, dtb: Column, dtf: Column) -> Column:
    """26 bits: three bands of 6 and two distances of 4; what does not fit is cut off, so 16 to 19 look like 0 to 3."""
    out = F.lit(0).cast("bigint")
    for c, bits in zip((fb, fk, ff, dtb, dtf), FIELDS.values()):
        out = F.shiftleft(out, bits).bitwiseOR(c.cast("bigint").bitwiseAND((1 << bits) - 1))
    return out


def unpacked(h: Column) -> list[Column]:
    out, shift = [], sum(FIELDS.values())
    for name, bits in FIELDS.items():
        shift -= bits
        out.append(F.shiftright(h, shift).bitwiseAND((1 << bits) - 1).cast("int").alias(name))
    return out


def energy_gate(cells: DataFrame, factor: float, local: int | None = None, floor: float = 0.0) -> DataFrame:
    """Cells louder than `factor` times the clip's mean; with `local` (an odd number of frames) than `factor` times their
    band's centred moving mean (cut off at the ends) and than `floor` times the clip's peak."""
    clip = cells.groupBy("clip").agg(F.avg("energy").alias("_mean"), F.max("energy").alias("_top"))
    rows = cells.join(clip, "clip")
    if local is None:
        return rows.where(F.col("energy") > factor * F.col("_mean")).drop("_mean", "_top")
    w = Window.partitionBy("clip", "f").orderBy("t").rowsBetween(-(local // 2), local // 2)
    rows = rows.withColumn("_local", F.avg("energy").over(w))
    return rows.where((F.col("energy") > factor * F.col("_local")) & (F.col("energy") > floor * F.col("_top"))).drop("_mean", "_top", "_local")


def time_peaks(cells: DataFrame, window: int) -> DataFrame:
    """Cells that are the largest of their band within `window` frames around them."""
    w = Window.partitionBy("clip", "f").orderBy("t").rangeBetween(-(window // 2), window // 2)
    return cells.withColumn("_m", F.max("energy").over(w)).where((F.col("energy") == F.col("_m")) & (F.col("energy") > 0)).drop("_m")


def top_bands(cells: DataFrame, k: int) -> DataFrame:
    """The `k` loudest bands of each frame; those level with the k-th stay."""
    w = Window.partitionBy("clip", "t").orderBy(F.col("energy").desc())
    return cells.withColumn("_r", F.rank().over(w)).where(F.col("_r") <= k).drop("_r")


def keypoints(peaks: DataFrame, k: int) -> DataFrame:
    """(clip, t, f, r): the `k` loudest peaks of each time bin floor(t * 12.5 / 40), numbered from 0 by falling energy."""
    bins = peaks.withColumn("bin", F.floor(F.col("t") * (BIN_RATE / FRAME_RATE)).cast("int"))
    w = Window.partitionBy("clip", "bin").orderBy(F.col("energy").desc(), "f", "t")
    return bins.withColumn("r", F.row_number().over(w) - 1).where(F.col("r") < k).select("clip", F.col("bin").alias("t"), "f", "r")


def signatures(points: DataFrame, m: int = NEAREST, far: int = FARTHEST) -> DataFrame:
    """(clip, hash, t_hash, n_hashes_total): each key point with its nearest partner in [t + m, t + far) and in (t - far, t - m].

    A point without both partners gives none. Within one time bin points stand in the order `r`; the forward partner is the
    first of its bin, the backward one the last. A clip without any signature gives one row with null hash and t_hash -1.
    """
    p = F.struct("t", "r", "f")
    w = Window.partitionBy("clip").orderBy("t")
    rows = points.withColumn("_next", F.min(p).over(w.rangeBetween(m, far - 1))).withColumn("_before", F.max(p).over(w.rangeBetween(-(far - 1), -m)))
    both = rows.where(F.col("_next").isNotNull() & F.col("_before").isNotNull())
    h = packed(F.col("_before.f"), F.col("f"), F.col("_next.f"), F.col("t") - F.col("_before.t"), F.col("_next.t") - F.col("t"))
    found = both.select("clip", h.alias("hash"), F.col("t").alias("t_hash"))
    total = found.groupBy("clip").agg(F.count(F.lit(1)).alias("n"))
    clips = points.select("clip").distinct().join(total, "clip", "left")
    return clips.join(found, "clip", "left").select("clip", "hash", F.coalesce("t_hash", F.lit(-1)).alias("t_hash"), F.coalesce("n", F.lit(0)).cast("int").alias("n_hashes_total"))


def large_groups(members: DataFrame, above: int) -> DataFrame:
    """(grp, n): groups of more than `above` clips. Members: (grp, clip), distinct."""
    return members.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > above)


def subgroups(members: DataFrame, postings: DataFrame, above: int = LARGE_GROUP, min_shared: int = MIN_SHARED) -> DataFrame:
    """(grp, clip, sub): the parts in which a large group is compared; smaller groups are one part.

    In a group of more than `above` clips two clips belong together that share `min_shared` hashes, counted with
    multiplicity, directly or through others; `sub` is the smallest clip of the part. Clips that share fewer cannot match.
    """
    big = cut(large_groups(members, above).select("grp"))
    some = members.join(big, "grp", "left_semi")
    n = postings.where("hash is not null").groupBy("clip", "hash").agg(F.count(F.lit(1)).alias("v"))
    shared = meetings(some, n).groupBy("grp", "a", "b").agg(F.sum(F.least("va", "vb")).alias("shared")).where(F.col("shared") >= min_shared)
    ends = shared.select(*[F.struct("grp", F.col(c).alias("clip")).alias(c) for c in "ab"])
    roots = connected_components(ends).select("node.grp", "node.clip", F.col("root.clip").alias("sub"))
    large = some.join(roots, ["grp", "clip"], "left").select("grp", "clip", F.coalesce("sub", "clip").alias("sub"))
    rest = members.join(big, "grp", "left_anti")
    first = rest.groupBy("grp").agg(F.min("clip").alias("sub"))  # groups of at most `above` clips
    return large.union(rest.join(first, "grp").select("grp", "clip", "sub"))


def meetings(members: DataFrame, postings: DataFrame, shard: int = SHARD) -> DataFrame:
    """(grp, a, b, hash, va, vb), a < b: every two postings of one hash by two clips of one group, in groups of any size.

    Members: (grp, clip), distinct; postings: (clip, hash, v). Clips are never paired off, they meet where they share a hash;
    hashes of one clip only are left out first, and a frequent one is cut into shards of `shard` postings of `a`.
    """
    rows = members.join(postings.where("hash is not null"), "clip")
    n = rows.groupBy("grp", "hash").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"), F.min("clip").alias("_lo"), F.max("clip").alias("_hi")).where("_lo < _hi").drop("_lo", "_hi")
    both = rows.join(n, ["grp", "hash"])
    x = both.select("grp", "hash", F.pmod(F.xxhash64("clip", "v"), "shards").cast("int").alias("shard"), F.col("clip").alias("a"), F.col("v").alias("va"))
    y = both.select("grp", "hash", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), F.col("clip").alias("b"), F.col("v").alias("vb"))
    return x.join(y, ["grp", "hash", "shard"]).where("a < b").drop("shard")


def _votes(hits: DataFrame, *by: str) -> DataFrame:
    return hits.groupBy(*by, "a", "b", (F.col("ta") - F.col("tb")).alias("delta")).agg(
        F.count(F.lit(1)).alias("n"), (F.max("ta") - F.min("ta") + 1).alias("span_a"), (F.max("tb") - F.min("tb") + 1).alias("span_b"))


def _best(votes: DataFrame, tolerance: int) -> DataFrame:
    w = Window.partitionBy("a", "b").orderBy("delta").rangeBetween(-tolerance, tolerance)
    wide = votes.withColumn("score", F.sum("n").over(w) if tolerance else F.col("n"))
    best = wide.groupBy("a", "b").agg(F.max(F.struct("score", (-F.col("delta")).alias("d"), "span_a", "span_b")).alias("x"))
    return best.select("a", "b", "x.score", (-F.col("x.d")).alias("delta"), "x.span_a", "x.span_b")


def hough(pairs: DataFrame, postings: DataFrame, tolerance: int = 0) -> DataFrame:
    """(a, b, score, delta, span_a, span_b): votes of equal hashes for each time offset of b against a.

    With a tolerance an offset also counts its neighbours' votes; equal scores go to the smallest offset; the spans, from
    the first to the last matched time inclusive, are measured at the exact offset only. Postings: (clip, hash, t_hash).
    """
    p = postings.where("hash is not null and t_hash >= 0")
    left = pairs.join(p.select(F.col("clip").alias("a"), "hash", F.col("t_hash").alias("ta")), "a")
    hits = left.join(p.select(F.col("clip").alias("b"), "hash", F.col("t_hash").alias("tb")), ["b", "hash"])
    return _best(_votes(hits), tolerance)


def group_hough(members: DataFrame, postings: DataFrame, tolerance: int = 0) -> DataFrame:
    """`hough` of all pairs a < b of clips that share a group. Members: (grp, clip), distinct."""
    hits = meetings(members, postings.where("t_hash >= 0").select("clip", "hash", F.col("t_hash").alias("v"))).withColumnsRenamed({"va": "ta", "vb": "tb"})
    votes = _votes(hits, "grp").groupBy("a", "b", "delta").agg(F.max("n").alias("n"), F.max("span_a").alias("span_a"), F.max("span_b").alias("span_b"))  # the same in each group of both
    return _best(votes, tolerance)


def shared_hashes(pairs: DataFrame, postings: DataFrame) -> DataFrame:
    """(a, b, shared): hashes that both clips hold, with multiplicity."""
    n = postings.where("hash is not null").groupBy("clip", "hash").agg(F.count(F.lit(1)).alias("c"))
    both = pairs.join(n.select(F.col("clip").alias("a"), "hash", F.col("c").alias("ca")), "a").join(n.select(F.col("clip").alias("b"), "hash", F.col("c").alias("cb")), ["b", "hash"])
    return both.groupBy("a", "b").agg(F.sum(F.least("ca", "cb")).alias("shared"))


def group_shared_hashes(members: DataFrame, postings: DataFrame) -> DataFrame:
    """`shared_hashes` of all pairs a < b of clips that share a group. Members: (grp, clip), distinct."""
    n = postings.where("hash is not null").groupBy("clip", "hash").agg(F.count(F.lit(1)).alias("v"))
    return meetings(members, n).groupBy("grp", "a", "b").agg(F.sum(F.least("va", "vb")).alias("shared")).groupBy("a", "b").agg(F.max("shared").alias("shared"))


def confirmed(votes: DataFrame, clips: DataFrame, min_points: int = 3, min_score: int = 5, fraction: float = 0.1, span_ratio: float = 0.5, strong: float = 0.5) -> DataFrame:
    """Votes that are a match. Clips: (clip, n, frames), their hashes and length (0 or less: unknown).

    Both need `min_points` hashes; the score must reach the larger of `min_score` and the whole part of `fraction` times the
    smaller number; the matched span must be `span_ratio` of the shorter clip, unless a length is unknown or the match
    is strong.
    """
    a, b = (clips.select(F.col("clip").alias(x), F.col("n").alias(f"n{x}"), F.col("frames").alias(f"f{x}")) for x in "ab")
    rows = votes.join(a, "a").join(b, "b")
    least = F.least("na", "nb")
    share = F.col("score") / least
    long_enough = (F.least("fa", "fb") <= 0) | (share >= strong) | (F.least("span_a", "span_b") / F.least("fa", "fb") >= span_ratio)
    return rows.where((least >= min_points) & (F.col("score") >= F.greatest(F.lit(min_score), F.floor(least * fraction))) & long_enough).select(*votes.columns)


def match_groups(members: DataFrame, matches: DataFrame, seconds_per_frame: float = 1 / BIN_RATE) -> DataFrame:
    """(clip, group, max_match_score, matched_span_secs): components of the matches; a clip without one is its own group."""
    ends = matches.select(F.col("a").alias("clip"), "score", F.col("span_a").alias("span")).union(matches.select("b", "score", "span_b"))
    best = ends.groupBy("clip").agg(F.max("score").cast("int").alias("max_match_score"), F.max(F.col("span") * seconds_per_frame).alias("matched_span_secs"))
    roots = connected_components(matches)
    out = members.select("clip").distinct().join(roots, F.col("clip") == F.col("node"), "left").join(best, "clip", "left")
    return out.select("clip", F.coalesce("root", "clip").alias("group"), F.coalesce("max_match_score", F.lit(0)).alias("max_match_score"), F.coalesce("matched_span_secs", F.lit(0.0)).alias("matched_span_secs"))


def threshold_grid(labelled: DataFrame, scores: list[int], ratios: list[float]) -> DataFrame:
    """(min_score, span_ratio, tp, fp, fn, tn, precision, recall, f1) of every setting over labelled votes
    (score, ratio, is_match); neither the strong-match bypass nor the minimum of hashes counts here."""
    grid = F.array(*[F.struct(F.lit(s).alias("min_score"), F.lit(r).alias("span_ratio")) for s in scores for r in ratios])
    each = labelled.select("is_match", "score", "ratio", F.explode(grid).alias("g")).withColumn("hit", (F.col("score") >= F.col("g.min_score")) & (F.col("ratio") >= F.col("g.span_ratio")))
    is_ = F.col("is_match")
    n = each.groupBy("g.min_score", "g.span_ratio").agg(
        F.count_if(F.col("hit") & is_).alias("tp"), F.count_if(F.col("hit") & ~is_).alias("fp"), F.count_if(~F.col("hit") & is_).alias("fn"), F.count_if(~F.col("hit") & ~is_).alias("tn"))
    p, r = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    return n.select("*", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.try_divide(2 * p * r, p + r), 6).alias("f1"))
