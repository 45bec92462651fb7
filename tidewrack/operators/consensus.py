"""One transcript out of several: alignment to a primary, votes by position, and what is filtered out."""

from __future__ import annotations

from itertools import combinations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.functions.text import excess_repetition, words

RESULT = "text string, fallbacks int, ambiguous array<struct<position:int,primary:string,default:string,candidates:array<string>>>, words array<string>"


def align(primary: list[str], other: list[str]) -> list[str | None]:
    """For each primary word the word of `other` in its place, by edit distance; None where `other` has none.

    On equal cost a match or replacement is preferred to dropping the primary's word, and that to an added word. The table of
    distances is held as the differences of neighbours, one bit a cell, a column made in one step of whole-number arithmetic.
    """
    n, m = len(primary), len(other)
    places: dict[str, int] = {}
    for k, w in enumerate(reversed(primary)):
        places[w] = places.get(w, 0) | 1 << k
    full = (1 << n) - 1
    up, down = full, 0  # by word of the primary, from the last: where the distance grows and falls along the column
    columns = [(up, down, 0, 0)]
    for w in reversed(other):
        eq = places.get(w, 0)
        d = (((eq & up) + up) ^ up) | eq | down
        right, left = down | full & ~(d | up), d & up  # where it grows and falls against the column before
        shifted = right << 1 | 1
        up, down = (left << 1 | full & ~(d | shifted)) & full, d & shifted & full
        columns.append((up, down, right, left))
    out: list[str | None] = []
    i = j = 0
    while i < n:
        p = n - i
        if j < m:
            up, down, right, left = columns[m - j]
            step = (up >> p - 1 & 1) - (down >> p - 1 & 1)
            before = (right >> p - 2 & 1) - (left >> p - 2 & 1) if p > 1 else 1
            if step + before == (primary[i] != other[j]):
                out.append(other[j])
                i, j = i + 1, j + 1
                continue
            if step != 1:
                j += 1
                continue
        out.append(None)
        i += 1
    return out


def vote(hypotheses: dict[str, str | None], primary: str, weights: dict[str, float] | None) -> dict:
    """The consensus of the slots, given in their order, on the primary's words; case does not count.

    With weights the spelling of the largest sum wins; without, the most frequent one if two voters back it, else the
    primary's word. Equal votes go to the earlier slot, the primary first. The primary's own spelling is kept where it
    wins, else the first seen. `fallbacks` counts, without weights, primary words that nobody shares; a position whose
    top count is shared by several spellings is listed as ambiguous.
    """
    own = (hypotheses.get(primary) or "").split()
    if not own:
        return {"text": "", "fallbacks": 0, "ambiguous": [], "words": []}
    others = {s: align(own, (t or "").split()) for s, t in hypotheses.items() if s != primary}
    out, ambiguous, alone = [], [], 0
    for i, word in enumerate(own):
        ballots = [(primary, word)] + [(s, a[i]) for s, a in others.items() if a[i] is not None]
        tally: dict[str, list] = {}
        for slot, w in ballots:
            t = tally.setdefault(w.casefold(), [0, 0.0, w])
            t[0] += 1
            t[1] += weights.get(slot, 0.0) if weights is not None else 1.0
        most = max(t[0] for t in tally.values())
        if weights is not None:
            chosen = max(tally.values(), key=lambda t: t[1])[2]
        else:
            chosen = next(t[2] for t in tally.values() if t[0] == most) if most > 1 else word
            alone += chosen == word and tally[word.casefold()][0] == 1
        tied = [t[2] for t in tally.values() if t[0] == most]
        if len(tied) > 1:
            ambiguous.append({"position": i, "primary": word, "default": chosen, "candidates": sorted(tied)})
        out.append(chosen)
    return {"text": " ".join(out), "fallbacks": alone, "ambiguous": ambiguous, "words": out}


def check_weights(weights: dict[str, float]) -> None:
    """Raise unless all sums of weights of different slots differ, so that no vote can be a draw."""
    seen: dict[float, tuple] = {}
    for n in range(1, len(weights) + 1):
        for some in combinations(sorted(weights), n):
            total = round(sum(weights[s] for s in some), 9)
            if total in seen:
                raise ValueError(f"{seen[total]} and {some} weigh the same, {total}")
            seen[total] = some


def consensus(df: DataFrame, slots: list[str], primary: str, voting: str = "majority", weights: dict[str, float] | None = None, confidences: dict[str, str] | None = None) -> DataFrame:
    """Add `rover`, a struct of the consensus text, fallbacks, ambiguous places and words.

    `slots`: columns with the hypotheses, in order. voting: majority, weighted (fixed `weights`), or confidence (columns
    with each slot's mean log-probability; as these are not above 0, agreement lowers a sum). A null slot does not vote.
    If the primary is blank, the first other slot with a text takes its place.
    """
    if voting == "weighted":
        check_weights(weights or {})
    order = [primary, *[s for s in slots if s != primary]]
    columns = [F.col(s) for s in slots] + [F.col(confidences[s]) for s in slots if voting == "confidence"]

    @F.pandas_udf(RESULT)
    def run(*cols: pd.Series) -> pd.DataFrame:
        rows = []
        for values in zip(*cols):
            texts = dict(zip(slots, values[: len(slots)]))
            conf = dict(zip(slots, [0.0 if v is None or v != v else v for v in values[len(slots) :]])) if voting == "confidence" else weights if voting == "weighted" else None
            there = {s: t for s, t in texts.items() if isinstance(t, str)}
            lead = next((s for s in order if there.get(s, "").strip()), primary)
            rows.append(vote(there, lead, conf))
        return pd.DataFrame(rows, columns=["text", "fallbacks", "ambiguous", "words"])

    return df.withColumn("rover", run(*columns))


def enhanced(df: DataFrame, slots: list[str], reference: str, weights: dict[str, float]) -> DataFrame:
    """Add `enhanced`: the weighted consensus anchored at the reference; where it is blank, the first slot's text that is not."""
    out = consensus(df, [reference, *slots], reference, "weighted", weights)
    plain = F.coalesce(*[F.when(F.trim(c) != "", F.col(c)) for c in [reference, *slots]])
    return out.withColumn("enhanced", F.coalesce(F.when(F.trim("rover.text") != "", F.col("rover.text")), plain)).drop("rover")


def majority_by_position(rows: DataFrame, key: list[str], position: str, slot: str, word: str) -> DataFrame:
    """(key..., position, word, votes) of words already aligned: the most frequent spelling, equal votes to the earlier slot."""
    by = rows.where(F.col(word).isNotNull()).groupBy(*key, position, F.lower(word).alias("k")).agg(F.count(F.lit(1)).alias("votes"), F.min(F.struct(slot, word)).alias("first"))
    best = by.groupBy(*key, position).agg(F.max(F.struct("votes", (-F.col(f"first.{slot}")).alias("s"), F.col(f"first.{word}").alias("w"))).alias("b"))
    return best.select(*key, position, F.col("b.w").alias("word"), "b.votes")


def filter_reason(texts: list[Column], consensus_text: Column, n: int = 15, times: int = 5) -> Column:
    """all_failed where no slot has a text, excess_repetition where the consensus repeats itself, else null."""
    any_ = F.coalesce(*[F.when(F.trim(t) != "", F.lit(True)) for t in texts], F.lit(False))
    return F.when(~any_, "all_failed").when(excess_repetition(words(consensus_text), n, times), "excess_repetition")


def language_consistency(rows: DataFrame, key: str, order: str, detected: str, expected: str | None = None) -> DataFrame:
    """(key, language, consistent, n): whether all detections of a key agree with the expected language, or else with
    their most frequent one (equal counts: seen first). Null detections do not count; with none, consistent is null."""
    some = rows.where(F.col(detected).isNotNull())
    by = some.groupBy(key, detected).agg(F.count(F.lit(1)).alias("c"), F.min(order).alias("o"))
    modes = by.groupBy(key).agg(F.max(F.struct("c", (-F.col("o")).alias("o"), F.col(detected).alias("lang"))).alias("b"), F.sum("c").alias("n"), F.count(F.lit(1)).alias("kinds"), F.collect_set(detected).alias("all"))
    wanted = rows.groupBy(key).agg(F.max(expected).alias("e") if expected else F.lit(None).cast("string").alias("e"))
    out = wanted.join(modes, key, "left")
    agree = F.when(F.col("e").isNotNull(), (F.col("kinds") == 1) & (F.col("b.lang") == F.col("e"))).otherwise(F.col("kinds") == 1)
    return out.select(key, F.coalesce("e", "b.lang").alias("language"), F.when(F.col("n") > 0, agree).alias("consistent"), F.coalesce("n", F.lit(0)).alias("n"))
