"""Speech spans: clean-up, merging, packing into chunks, overlap, runs by gaps, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.functions.text import let, universal_id
from tidewrack.operators.ordering import here, spread, with_carry

SAMPLE_RATE = 16000  # time stamps are always in this domain
SPAN = "array<struct<start:double,end:double>>"


def normalised(spans: Column) -> Column:
    """Spans of an array of [start, end] pairs as whole numbers; those that do not end after their start go; sorted by start."""
    whole = F.transform(spans, lambda p: F.struct(p[0].cast("bigint").alias("start"), p[1].cast("bigint").alias("end")))
    return F.sort_array(F.filter(whole, lambda s: s["end"] > s["start"]))


def seconds(spans: Column, limit: Column, rate: int = SAMPLE_RATE) -> Column:
    """Sample spans as seconds, clamped to 0 and `limit`; what is empty after that goes."""
    def one(s):
        return F.struct(F.greatest(s["start"] / rate, F.lit(0.0)).alias("start"), F.least(s["end"] / rate, limit).alias("end"))

    return F.filter(F.transform(spans, one), lambda s: s["end"] > s["start"])


def _fold(spans: Column, gap: float, longest: float) -> Column:
    """Join a span to the one before where the gap and the joint length allow; the joint end is that of the last span."""
    empty = F.array().cast(SPAN)

    def step(done, s):
        last = F.element_at(done, -1)
        fits = (F.size(done) > 0) & (s["start"] - last["end"] <= gap) & (s["end"] - last["start"] <= longest)
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), s["end"].alias("end"))))
        return F.when(fits, joined).otherwise(F.concat(done, F.array(F.struct(s["start"].cast("double").alias("start"), s["end"].cast("double").alias("end")))))

    return F.aggregate(spans, empty, step)


def packed(spans: Column, gap: float, longest: float, shortest: float, longest_span: float | None = None) -> Column:
    """Chunks of the sorted spans: spans over `longest_span` (by default `longest`) go, the rest are merged and packed in
    two passes (nested spans can make the second one matter), and chunks under `shortest` go."""
    some = F.filter(spans, lambda s: s["end"] - s["start"] <= (longest_span or longest))
    return F.filter(_fold(_fold(some, gap, longest), gap, longest), lambda s: s["end"] - s["start"] >= shortest)


def split_outcome(duration: Column, spans: Column, chunks: Column, shortest: float) -> Column:
    """Why a recording gave chunks or none. `spans` null: no entry; `chunks` of its clamped spans."""
    return (F.when(duration < shortest, "too_short").when(spans.isNull(), "missing_vad").when(F.size(spans) == 0, "empty_vad")
            .when(F.size(seconds(spans, duration)) == 0, "invalid_vad_after_clamp").when(F.size(chunks) == 0, "chunks_below_min_duration").otherwise("chunked"))


def _numbered(rows: DataFrame, order: list[Column], flag: str, into: str) -> DataFrame:
    """Add the running sum of `flag`, over the parts of `spread` rows."""
    rows = with_carry(rows, F.sum(flag), "sum", "_carried")
    total = F.sum(flag).over(here(order).rowsBetween(Window.unboundedPreceding, 0)) + F.coalesce("_carried", F.lit(0))
    return rows.withColumn(into, total).drop("_carried")


def merged_rows(df: DataFrame, key: str, start: str, end: str, gap: float) -> DataFrame:
    """(key, start, end, n): rows joined where a start is at most `gap` after the largest end before it; a running maximum.

    A key's rows are spread over tasks by their order; each part is told the largest end and the number of runs before it.
    """
    order = [F.col(start), F.col(end), F.xxhash64(*df.columns)]
    rows = with_carry(spread(df, [key], order), F.max(end), "max", "_top")
    before = F.greatest(F.max(end).over(here(order).rowsBetween(Window.unboundedPreceding, -1)), F.col("_top"))
    flagged = rows.withColumn("_new", F.coalesce((F.col(start) > before + gap).cast("int"), F.lit(1)))
    runs = _numbered(flagged, order, "_new", "_run")
    return runs.groupBy(key, "_run").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count(F.lit(1)).alias("n")).drop("_run")


def runs_and_numbers(df: DataFrame, source: str, start: str, end: str, order: list[str], max_gap: float) -> DataFrame:
    """Add run, clip_num, source_run and universal_id: a run ends where the gap to the row before exceeds `max_gap`.

    The gap is to the end of the previous row, not to the largest end so far; numbers start from 0 in every run, and from
    the second run on the source's name takes the suffix _R{run}. A source's rows are spread over tasks by their order; each
    part is told the last end, the rows and runs before it, and where the last run began.
    """
    by = [F.col(start), *[F.col(c) for c in order]]
    last = F.max_by(end, F.struct(start, *order))
    rows = with_carry(spread(df, [source], by), last, "last", "_end")
    gap = F.col(start) - F.coalesce(F.lag(end).over(here(by)), F.col("_end"))
    rows = rows.withColumn("_cut", F.coalesce((gap > max_gap).cast("int"), F.lit(0))).withColumn("_one", F.lit(1))
    rows = _numbered(_numbered(rows, by, "_cut", "run"), by, "_one", "_i")
    rows = with_carry(rows, F.max(F.when(F.col("_cut") == 1, F.col("_i"))), "max", "_began")
    began = F.max(F.when(F.col("_cut") == 1, F.col("_i"))).over(here(by).rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("clip_num", F.col("_i") - F.coalesce(began, F.col("_began"), F.lit(1)))
    name = F.when(F.col("run") > 0, F.concat(F.col(source).cast("string"), F.lit("_R"), F.col("run").cast("string"))).otherwise(F.col(source).cast("string"))
    out = rows.withColumn("source_run", name).withColumn("universal_id", universal_id(F.col("source_run"), F.col("clip_num")))
    return out.select(*df.columns, "run", "clip_num", "source_run", "universal_id")


def overlap_seconds(chunks: DataFrame, spans: DataFrame, key: str, width: float) -> DataFrame:
    """(key, chunk, seconds): speech inside each chunk (key, chunk, c_start, c_end) by the spans (key, s_start, s_end).

    Both sides are cut into time buckets of `width`, so the join is an equi-join on (key, bucket) and no key's spans meet
    all of its chunks; a pair is counted in the bucket of its later start only.
    """
    def cells(a: str, b: str):
        return F.explode(F.sequence(F.floor(F.col(a) / width), F.floor(F.col(b) / width)))

    c = chunks.withColumn("_cell", cells("c_start", "c_end"))
    s = spans.withColumn("_cell", cells("s_start", "s_end"))
    both = c.join(s, [key, "_cell"]).where(F.floor(F.greatest("c_start", "s_start") / width) == F.col("_cell"))
    part = F.greatest(F.least("c_end", "s_end") - F.greatest("c_start", "s_start"), F.lit(0.0))
    got = both.groupBy(key, "chunk").agg(F.sum(part).alias("seconds"))
    return chunks.select(key, "chunk").join(got, [key, "chunk"], "left").na.fill(0.0, ["seconds"])


def frames_to_spans(frames: DataFrame, key: str, frame: str, probability: str, threshold: float, min_silence: int, min_speech: int) -> DataFrame:
    """(key, first, last): stretches of speech frames; gaps under `min_silence` frames are closed, stretches under `min_speech` go."""
    speech = frames.where(F.col(probability) >= threshold).select(key, F.col(frame).alias("f"), (F.col(frame) + 1).alias("f1"))
    runs = merged_rows(speech, key, "f", "f1", min_silence - 1)
    return runs.where(F.col("end") - F.col("start") >= min_speech).select(key, F.col("start").alias("first"), (F.col("end") - 1).alias("last"))


def interleave_key(*columns: Column) -> Column:
    """The columns joined by '_'; null when any is missing."""
    there = columns[0].isNotNull()
    for c in columns[1:]:
        there = there & c.isNotNull()
    return F.when(there, F.concat_ws("_", *columns))


def language_breakdown(df: DataFrame, lang: str, raw: str, kept: str) -> DataFrame:
    """(lang, recordings, raw_hours, kept_hours, kept_pct), to be shown by falling number of recordings."""
    out = df.groupBy(F.col(lang).alias("lang")).agg(F.count(F.lit(1)).alias("recordings"), (F.sum(raw) / 3600).alias("raw_hours"), (F.sum(kept) / 3600).alias("kept_hours"))
    return out.select("lang", "recordings", F.round("raw_hours", 6).alias("raw_hours"), F.round("kept_hours", 6).alias("kept_hours"), F.round(100 * F.try_divide("kept_hours", "raw_hours"), 4).alias("kept_pct"))


def sweep(df: DataFrame, spans: str, shortest: list[float], gaps: list[float], longest: float) -> DataFrame:
    """(min_chunk, gap, chunks, hours) for every pair of parameters; the grid is small, so each row is unfolded by it."""
    grid = F.array(*[F.struct(F.lit(m).alias("min_chunk"), F.lit(g).alias("gap"), let(packed(F.col(spans), g, longest, m), lambda c: F.struct(
        F.size(c).alias("n"), F.aggregate(c, F.lit(0.0), lambda a, x: a + x["end"] - x["start"]).alias("s"))).alias("r")) for m in shortest for g in gaps])
    each = df.select(F.explode(grid).alias("x"))
    return each.groupBy("x.min_chunk", "x.gap").agg(F.sum("x.r.n").alias("chunks"), F.round(F.sum("x.r.s") / 3600, 6).alias("hours"))


def one_language_per_session(rows: DataFrame, session: str, lang: str, weight: str, seed: int = 0) -> DataFrame:
    """(session, lang): one language for each session, hours balanced between languages greedily in a seeded order.

    The order is sequential by nature; its state is one number per language. Sessions, not their rows, are sent to one
    task, already summed per language.
    """
    import pandas as pd

    per = rows.groupBy(session, lang).agg(F.sum(weight).alias("w"))
    each = per.groupBy(session).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(lang, "w")))).alias("m")).withColumn("o", F.xxhash64(F.lit(seed), session))

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        total: dict[str, float] = {}
        out = []
        for _, r in pdf.sort_values(["o", session]).iterrows():
            best = min(sorted(r.m), key=lambda x: (total.get(x, 0.0), x))
            total[best] = total.get(best, 0.0) + r.m[best]
            out.append((r[session], best))
        return pd.DataFrame(out, columns=[session, "lang"])

    kind = rows.schema[session].dataType.simpleString()
    return each.groupBy().applyInPandas(choose, f"`{session}` {kind}, lang string")
