"""Word and character error rates, changes between transcripts, confidences."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.text import error_key


def edits(a: list[str], b: list[str]) -> int:
    """Edit distance of two token lists, bit-parallel: one step a token of `b`, whatever the length of `a`."""
    if not a or not b:
        return max(len(a), len(b))
    at: dict[str, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    all_, last, vp, vn, cost = (1 << len(a)) - 1, 1 << (len(a) - 1), (1 << len(a)) - 1, 0, len(a)
    for w in b:
        eq = at.get(w, 0)
        d = (((eq & vp) + vp) ^ vp) | eq | vn
        hp, hn = vn | (all_ & ~(d | vp)), d & vp
        cost += (1 if hp & last else 0) - (1 if hn & last else 0)
        hp = (hp << 1) | 1
        vp, vn = ((hn << 1) | (all_ & ~(d | hp))) & all_, d & hp & all_
    return cost


def word_edits(a: Column, b: Column) -> Column:
    """Edit distance between the words of two texts (Arrow-batched; SQL has none over words)."""

    @F.pandas_udf("int")
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([edits((p or "").split(), (q or "").split()) for p, q in zip(x, y)], dtype="int32")

    return run(a, b)


def with_errors(df: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """Add word_edits, words, wer, char_edits, chars, cer of the compared forms; rates are null where the reference is empty.

    Characters are compared in the JVM. The compared form keeps a-z and digits only: other scripts have no rate.
    """
    keyed = df.withColumn("_r", error_key(F.col(reference))).withColumn("_h", error_key(F.col(hypothesis)))
    n = F.when(F.col("_r") == "", 0).otherwise(F.size(F.split("_r", " ")))
    rows = keyed.withColumn("words", n).withColumn("chars", F.length("_r")).withColumn("word_edits", word_edits(F.col("_r"), F.col("_h"))).withColumn("char_edits", F.levenshtein("_r", "_h"))
    rate = lambda e, n: F.when(F.col(n) > 0, F.col(e) / F.col(n))
    return rows.withColumn("wer", rate("word_edits", "words")).withColumn("cer", rate("char_edits", "chars")).drop("_r", "_h")


def pooled(errors: DataFrame, by: str) -> DataFrame:
    """(by, cuts, wer, cer, mean_wer): edits over lengths of all texts with a reference, and the mean of the cuts' own rates."""
    some = errors.where("words > 0")
    return some.groupBy(by).agg(
        F.count(F.lit(1)).alias("cuts"), F.round(F.sum("word_edits") / F.sum("words"), 6).alias("wer"), F.round(F.sum("char_edits") / F.sum("chars"), 6).alias("cer"), F.round(F.avg("wer"), 6).alias("mean_wer"))


def change_kind(before: Column, after: Column) -> Column:
    """identical, casing_only or real."""
    return F.when(before.eqNullSafe(after), "identical").when(F.lower(before).eqNullSafe(F.lower(after)), "casing_only").otherwise("real")


def itn_impact(df: DataFrame, before: str, after: str, wer_before: str, wer_after: str) -> DataFrame:
    """One row: how many texts changed, gained digits, and came out better, worse or the same within 1e-6."""
    d = F.col(wer_after) - F.col(wer_before)
    has = lambda c: F.col(c).rlike(r"\d")
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col(before).eqNullSafe(F.col(after))).alias("changed"), F.count_if(has(after) & ~has(before)).alias("digits_introduced"),
        F.count_if(d < -1e-6).alias("better"), F.count_if(d > 1e-6).alias("worse"), F.count_if(F.abs(d) <= 1e-6).alias("same"))


def confidence(segments: Column, tokens: Column) -> Column:
    """Mean log-probability: of segments (start, end, avg_logprob) weighted by duration, else of tokens (logprob), else 0."""
    dur = lambda s: F.greatest(s["end"] - s["start"], F.lit(0.0))
    total = F.aggregate(segments, F.lit(0.0), lambda a, s: a + dur(s))
    weighted = F.aggregate(segments, F.lit(0.0), lambda a, s: a + dur(s) * s["avg_logprob"]) / total
    mean = F.aggregate(tokens, F.lit(0.0), lambda a, t: a + t["logprob"]) / F.size(tokens)
    return F.when(total > 0, weighted).when(F.size(tokens) > 0, mean).otherwise(0.0)


def disagreeing(errors: DataFrame, reference: str, gate: float) -> DataFrame:
    """Rows with a reference that is not blank and a word error rate above the gate."""
    return errors.where((F.trim(F.coalesce(F.col(reference), F.lit(""))) != "") & (F.col("wer") > gate))
