"""Queries on spans, runs, error rates and consensus."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewrack.functions import text as T
from tidewrack.operators import consensus as C
from tidewrack.operators import errorrate as E
from tidewrack.operators import spans as S
from tidewrack.session import table, widened

GAP, LONGEST, SHORTEST = 600.0, 3600.0, 60.0


def _spans(spark, sf):
    """Events as spans: from their second, as long as a deterministic function of their value."""
    e = table(spark, sf, "events")
    start = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("bigint")
    return e.select("event_id", "user_id", start.alias("start"), (start + F.floor(F.abs(F.coalesce("value", F.lit(0.0)))).cast("bigint") % 900 + 1).alias("end"))


def _by_day(spark, sf):
    """Spans of a user and day as one bounded array."""
    s = _spans(spark, sf).withColumn("day", F.floor(F.col("start") / 86400))
    return s.groupBy("user_id", "day").agg(F.sort_array(F.collect_list(F.struct(F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end")))).alias("spans"))


def vad_merge(spark, sf):
    return S.merged_rows(_spans(spark, sf), "user_id", "start", "end", GAP)


def runs_and_clip_num(spark, sf):
    return S.runs_and_numbers(_spans(spark, sf), "user_id", "start", "end", ["event_id"], 43200).select("event_id", "user_id", "run", "clip_num", "source_run", "universal_id")


def speech_overlap(spark, sf):
    s = _spans(spark, sf)
    chunks = s.select("user_id", F.floor(F.col("start") / 3600).alias("chunk")).distinct().select("user_id", "chunk", (F.col("chunk") * 3600).alias("c_start"), (F.col("chunk") * 3600 + 3600).alias("c_end"))
    return S.overlap_seconds(chunks, s.select("user_id", F.col("start").alias("s_start"), F.col("end").alias("s_end")), "user_id", 3600)


def vad_pack(spark, sf):
    c = F.explode(S.packed(F.col("spans"), GAP, LONGEST, SHORTEST))
    return _by_day(spark, sf).select("user_id", "day", c.alias("c")).select("user_id", "day", "c.start", "c.end")


def vad_outcome(spark, sf):
    pairs = F.transform("spans", lambda s: F.array(s["start"] * S.SAMPLE_RATE, s["end"] * S.SAMPLE_RATE))
    rows = _by_day(spark, sf).withColumn("raw", S.normalised(pairs)).withColumn("length", (F.col("day") + 1) * 86400.0)
    chunks = S.packed(S.seconds(F.col("raw"), F.col("length")), GAP, LONGEST, SHORTEST)
    return rows.withColumn("chunks", chunks).select("user_id", "day", F.size("chunks").alias("chunks"), S.split_outcome(F.col("length"), F.col("raw"), F.col("chunks"), SHORTEST).alias("outcome"))


def chunk_sweep(spark, sf):
    return S.sweep(_by_day(spark, sf), "spans", [60.0, 300.0], [0.0, 600.0, 3600.0], LONGEST)


def frame_spans(spark, sf):
    f = table(spark, sf, "events").select("user_id", F.hour("ts").alias("hour"), F.dayofyear("ts").alias("d"))
    frames = f.groupBy("user_id", (F.col("d") * 24 + F.col("hour")).alias("frame")).agg(F.least(F.count(F.lit(1)) / 2, F.lit(1.0)).alias("p"))
    return S.frames_to_spans(frames, "user_id", "frame", "p", 0.5, 3, 2)


def lang_breakdown(spark, sf):
    kept = table(spark, sf, "assignments").groupBy("dataset", "cut_id").agg(F.max_by("is_kept", F.struct("decided_at", "run_no")).alias("k"))
    m = table(spark, sf, "manifest").join(kept, ["dataset", "cut_id"], "left")
    secs = F.when(~F.isnan("duration_secs"), F.col("duration_secs"))
    rows = m.select(T.base_language(F.col("language")).alias("lang"), F.coalesce(secs, F.lit(0.0)).alias("raw"), F.when(F.col("k"), F.coalesce(secs, F.lit(0.0))).otherwise(0.0).alias("kept"))
    return S.language_breakdown(rows, "lang", "raw", "kept")


def interleave_keys(spark, sf):
    return table(spark, sf, "manifest").select("line_no", S.interleave_key(F.col("dataset"), F.col("recording_id"), F.regexp_extract("cut_id", r"(\d+)$", 1)).alias("key"), F.regexp_extract("cut_id", r"(\d+)$", 1).cast("bigint").alias("clip_num"))


def session_languages(spark, sf):
    m = table(spark, sf, "manifest").where("recording_id is not null and language is not null and not isnan(duration_secs) and duration_secs is not null")
    return S.one_language_per_session(m.select("recording_id", T.base_language(F.col("language")).alias("l"), "duration_secs"), "recording_id", "l", "duration_secs")


def _errors(spark, sf):
    return E.with_errors(widened(table(spark, sf, "manifest").select("line_no", "dataset", "language", "text", "normalized_text")), "text", "normalized_text")


def cer(spark, sf):
    return _errors(spark, sf).select("line_no", "chars", "char_edits", F.round("cer", 6).alias("cer"))


def wer(spark, sf):
    return _errors(spark, sf).select("line_no", "words", "word_edits", F.round("wer", 6).alias("wer"))


def wer_summary(spark, sf):
    return E.pooled(_errors(spark, sf), "dataset")


def wer_gate(spark, sf):
    return E.disagreeing(_errors(spark, sf), "text", 0.1).select("line_no")


def change_kinds(spark, sf):
    m = table(spark, sf, "manifest").where("text is not null")
    return m.groupBy("dataset", E.change_kind(F.col("text"), F.col("normalized_text")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def itn_impact(spark, sf):
    e = _errors(spark, sf).withColumn("before", F.col("wer")).withColumn("after", F.col("wer") / 2)
    return E.itn_impact(e.where("words > 0"), "text", "normalized_text", "before", "after")


def confidences(spark, sf):
    seg = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), (-(s["end"] - s["start"]) / 1000).alias("avg_logprob")))
    none = F.array().cast("array<struct<logprob:double>>")
    return _by_day(spark, sf).select("user_id", "day", F.round(E.confidence(seg, none), 8).alias("confidence"))


def _slots(spark, sf):
    m = table(spark, sf, "manifest").where("text is not null and trim(text) <> ''")
    return widened(m.select("line_no", "text", "normalized_text")).select("line_no", "text", F.col("normalized_text").alias("a"), F.regexp_replace("text", r"^(\S+) ", "$1 $1 ").alias("b"), F.regexp_replace("text", r"[aeiou](?=\s)", "").alias("c"))


def rover_majority(spark, sf):
    out = C.consensus(_slots(spark, sf), ["text", "a", "b", "c"], "text")
    return out.select("line_no", "rover.text", "rover.fallbacks", F.size("rover.ambiguous").alias("ambiguous"), C.filter_reason([F.col("a"), F.col("b")], F.col("rover.text")).alias("filtered"))


def rover_confidence(spark, sf):
    rows = _slots(spark, sf).withColumn("pa", F.lit(-0.2)).withColumn("pb", F.lit(-0.9)).withColumn("pc", F.lit(-0.4)).withColumn("pt", F.lit(-0.3))
    return C.consensus(rows, ["text", "a", "b", "c"], "text", "confidence", confidences={"text": "pt", "a": "pa", "b": "pb", "c": "pc"}).select("line_no", "rover.text")


def enhanced_transcript(spark, sf):
    return C.enhanced(_slots(spark, sf), ["a", "b", "c"], "text", {"text": 1.5, "a": 1.02, "b": 1.01, "c": 1.0}).select("line_no", "enhanced")


def rover_majority_aligned(spark, sf):
    s = _slots(spark, sf)
    rows = s.select("line_no", F.explode(F.array(*[F.struct(F.lit(i).alias("slot"), F.split(c, " ").alias("w")) for i, c in enumerate(("text", "a", "c"))])).alias("x"))
    words = rows.select("line_no", "x.slot", F.posexplode("x.w").alias("position", "word"))
    return C.majority_by_position(words, ["line_no"], "position", "slot", "word")


def language_consensus(spark, sf):
    m = table(spark, sf, "manifest").where("recording_id is not null")
    return C.language_consistency(m.select("recording_id", "line_no", T.base_language(F.col("language")).alias("l")), "recording_id", "line_no", "l")


_SP = "(select event_id, user_id, s as start, s + floor(abs(coalesce(value, 0)))::bigint % 900 + 1 as \"end\" from (select *, floor(epoch(ts))::bigint as s from events))"
_KEY = r"trim(regexp_replace(regexp_replace(lower(coalesce({}, '')), '[^a-z0-9''\s]', ' ', 'g'), '\s+', ' ', 'g'))"
_WKEY = r"trim(regexp_replace(regexp_replace(lower(coalesce({}, '')), '[^a-z0-9''\s]', ' ', 'g'), '\s+', ' ', 'g'), ' ')"
#: Words as single characters, so that the edit distance over characters is one over words.
WORD_EDITS = f"""(select *, levenshtein(array_to_string(list_transform(wr, lambda w: chr(list_position(u, w)::int)), ''), array_to_string(list_transform(wh, lambda w: chr(list_position(u, w)::int)), '')) as word_edits, len(wr) as words from
 (select *, list_distinct(list_concat(wr, wh)) as u from (select *, case when r = '' then [] else string_split(r, ' ') end as wr, case when h = '' then [] else string_split(h, ' ') end as wh from
 (select *, {_WKEY.format('text')} as r, {_WKEY.format('normalized_text')} as h from manifest))))"""
_ERR = f"(select *, length(r) as chars, levenshtein(r, h) as char_edits from (select line_no, dataset, {_KEY.format('text')} as r, {_KEY.format('normalized_text')} as h from manifest))"

QUERIES = {f.__name__: f for f in (
    vad_merge, runs_and_clip_num, speech_overlap, vad_pack, vad_outcome, chunk_sweep, frame_spans, lang_breakdown, interleave_keys, session_languages, cer, wer, wer_summary, wer_gate,
    change_kinds, itn_impact, confidences, rover_majority, rover_confidence, enhanced_transcript, rover_majority_aligned, language_consensus)}

def _pack(gap, shortest, end='"end"::double'):
    return f"""with recursive s as materialized (select user_id, floor(start / 86400)::bigint as day, start::double as start, {end} as "end", row_number() over (partition by user_id, floor(start / 86400) order by start, "end", event_id) as i from {_SP}),
 f as (select user_id, day, i, start as c0, "end" as c1, 1 as chunk from s where i = 1 union all
 select s.user_id, s.day, s.i, case when s.start - f.c1 <= {gap} and s."end" - f.c0 <= {LONGEST} then f.c0 else s.start end, s."end", case when s.start - f.c1 <= {gap} and s."end" - f.c0 <= {LONGEST} then f.chunk else f.chunk + 1 end
 from f join s on s.user_id = f.user_id and s.day = f.day and s.i = f.i + 1)
 select user_id, day, min(c0) as start, arg_max(c1, i) as "end" from f group by user_id, day, chunk having arg_max(c1, i) - min(c0) >= {shortest}"""


SQL = {
    "vad_outcome": f"""select d.user_id, d.day, coalesce(c.n, 0)::int as chunks, case when coalesce(c.n, 0) > 0 then 'chunked' else 'chunks_below_min_duration' end as outcome from (select distinct user_id, floor(start / 86400)::bigint as day from {_SP}) d
 left join (select user_id, day, count(*) as n from ({_pack(GAP, SHORTEST, 'least("end"::double, (floor(start / 86400) + 1) * 86400.0)')}) group by 1, 2) c on c.user_id = d.user_id and c.day = d.day""",
    "chunk_sweep": " union all ".join(f"select {m} as min_chunk, {g} as gap, count(*) as chunks, round(sum(\"end\" - start) / 3600, 6) as hours from ({_pack(g, m)})" for m in (60.0, 300.0) for g in (0.0, 600.0, 3600.0)),
    "frame_spans": """with fr as (select user_id, d * 24 + h as frame from (select user_id, dayofyear(ts) as d, hour(ts) as h from events) group by 1, 2), s as (select user_id, frame, sum(n) over (partition by user_id order by frame rows unbounded preceding) as run from
 (select *, case when frame - lag(frame) over (partition by user_id order by frame) - 1 < 3 then 0 else 1 end as n from fr)) select user_id, min(frame) as first, max(frame) as last from s group by user_id, run having max(frame) - min(frame) + 1 >= 2""",
    "wer": f"select line_no, words, word_edits, round(word_edits / nullif(words, 0), 6) as wer from {WORD_EDITS}",
    "wer_summary": f"select dataset, count(*) as cuts, round(sum(word_edits) / sum(words), 6) as wer, round(sum(levenshtein(r, h)) / sum(length(r)), 6) as cer, round(avg(word_edits / words), 6) as mean_wer from {WORD_EDITS} where words > 0 group by 1",
    "wer_gate": f"select line_no from {WORD_EDITS} where trim(coalesce(text, ''), ' ') <> '' and words > 0 and word_edits / words > 0.1",
    "itn_impact": f"""select count(*) as rows, count(*) filter (text is distinct from normalized_text) as changed, count(*) filter (regexp_matches(normalized_text, '[0-9]') and not regexp_matches(text, '[0-9]')) as digits_introduced,
 count(*) filter (e / 2 - e < -1e-6) as better, count(*) filter (e / 2 - e > 1e-6) as worse, count(*) filter (abs(e / 2 - e) <= 1e-6) as same from (select *, word_edits / words as e from {WORD_EDITS} where words > 0)""",
    "vad_merge": f"""select user_id, min(start) as start, max("end") as "end", count(*) as n from (select *, sum(new) over (partition by user_id order by start, "end", event_id rows unbounded preceding) as run from
 (select *, case when start > max("end") over (partition by user_id order by start, "end", event_id rows between unbounded preceding and 1 preceding) + {GAP} then 1 when max("end") over (partition by user_id order by start, "end", event_id rows between unbounded preceding and 1 preceding) is null then 1 else 0 end as new from {_SP})) group by user_id, run""",
    "runs_and_clip_num": f"""select event_id, user_id, run, clip_num, source_run, source_run || '@' || lpad(clip_num::varchar, 6, '0') as universal_id from (select *, row_number() over (partition by user_id, run order by start, event_id) - 1 as clip_num,
 user_id::varchar || case when run > 0 then '_R' || run::varchar else '' end as source_run from (select *, sum(c) over (partition by user_id order by start, event_id rows unbounded preceding)::bigint as run from
 (select *, case when start - lag("end") over (partition by user_id order by start, event_id) > 43200 then 1 else 0 end as c from {_SP})))""",
    "speech_overlap": f"""with s as materialized (select * from {_SP}), c as (select distinct user_id, floor(start / 3600)::bigint as chunk from s)
 select c.user_id, c.chunk, coalesce(sum(greatest(least(c.chunk * 3600 + 3600, s."end") - greatest(c.chunk * 3600, s.start), 0)), 0)::double as seconds from c left join s on s.user_id = c.user_id and s."end" >= c.chunk * 3600 and s.start <= c.chunk * 3600 + 3600 group by 1, 2""",
    "vad_pack": _pack(GAP, SHORTEST),
    "lang_breakdown": """select lang, count(*) as recordings, round(sum(raw) / 3600, 6) as raw_hours, round(sum(case when k then raw else 0 end) / 3600, 6) as kept_hours, round(100 * (sum(case when k then raw else 0 end) / 3600) / nullif(sum(raw) / 3600, 0), 4) as kept_pct from
 (select lower(split_part(m.language, '-', 1)) as lang, coalesce(case when not isnan(m.duration_secs) then m.duration_secs end, 0) as raw, a.k from manifest m left join (select dataset, cut_id, arg_max(is_kept, (decided_at, run_no)) as k from assignments group by 1, 2) a using (dataset, cut_id)) group by lang""",
    "interleave_keys": r"""select line_no, case when dataset is not null and recording_id is not null and cut_id is not null then dataset || '_' || recording_id || '_' || regexp_extract(cut_id, '(\d+)$', 1) end as key, regexp_extract(cut_id, '(\d+)$', 1)::bigint as clip_num from manifest""",
    "cer": f"select line_no, chars, char_edits, round(case when chars > 0 then char_edits / chars end, 6) as cer from {_ERR}",
    "change_kinds": """select dataset, case when text is not distinct from normalized_text then 'identical' when lower(text) is not distinct from lower(normalized_text) then 'casing_only' else 'real' end as kind, count(*) as n from manifest where text is not null group by 1, 2""",
    "confidences": f"""select user_id, floor(start / 86400)::bigint as day, round(sum(("end" - start) * (-("end" - start) / 1000)) / sum("end" - start), 8) as confidence from {_SP} group by 1, 2""",
    "language_consensus": """with d as (select recording_id, line_no, lower(split_part(language, '-', 1)) as l from manifest where recording_id is not null), b as (select recording_id, l, count(*) as c, min(line_no) as o from d where l is not null group by 1, 2)
 select r.recording_id, arg_max(l, (c, -o)) as language, case when count(l) > 0 then count(l) = 1 end as consistent, coalesce(sum(c), 0)::bigint as n from (select distinct recording_id from d) r left join b using (recording_id) group by 1""",
    "rover_majority_aligned": r"""with s as (select line_no, text, normalized_text as a, regexp_replace(text, '[aeiou](\s)', '\1', 'g') as c from manifest where text is not null and trim(text) <> ''),
 w as (select line_no, slot, i - 1 as position, ws[i] as word from (select line_no, slot, ws, unnest(range(1, len(ws) + 1)) as i from (select line_no, 0 as slot, string_split(text, ' ') as ws from s union all select line_no, 1, string_split(a, ' ') from s union all select line_no, 2, string_split(c, ' ') from s))),
 b as (select line_no, position, lower(word) as k, count(*) as votes, min((slot, word)) as f from w where word is not null group by 1, 2, 3)
 select line_no, position, arg_max(f[2], (votes, -f[1])) as word, max(votes) as votes from b group by 1, 2""",
}
