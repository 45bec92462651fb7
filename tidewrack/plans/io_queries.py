"""Queries through sources, sinks and streams."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

from tidewrack.plans.pipeline import run_status
from tidewrack.session import mounted, scratch_path, table
from tidewrack.sources import records, shards
from tidewrack.streaming import flows


def _corpus(spark, sf):
    """The documents written as shards, their texts as payloads."""
    d = table(spark, sf, "documents")
    rows = d.select(F.coalesce("source", F.lit("none")).alias("dataset"), F.format_string("doc%09d", "doc_id").alias("cut_id"), "text", F.col("lang").alias("language"), (F.coalesce("n_chars", F.lit(0)) / 15.0).alias("duration_secs"),
                    F.coalesce("text", F.lit("")).cast("binary").alias("payload"))
    folder = mounted(scratch_path(spark, "shards"))
    n = shards.write_shards(rows.repartition("cut_id"), folder, 500).count()
    shards.write_index(folder, n)
    return folder


def shard_round_trip(spark, sf):
    """Documents as shards, found by the index, placed by name, and their payloads read at random."""
    cuts = shards.read_shards(spark, [_corpus(spark, sf)])
    data = shards.read_payloads(cuts)
    return cuts.drop("dataset").join(data, "cut_id").select("cut_id", "dataset", "language", F.md5("payload").alias("content"), F.coalesce(F.col("text") == F.col("payload").cast("string"), F.lit(True)).alias("same"))


def shard_offsets(spark, sf):
    folder = _corpus(spark, sf)
    by_place, by_name = shards.offset_index(spark, [folder]), shards.read_shards(spark, [folder])
    return by_place.join(by_name.select("dataset", "cut_id", F.col("tar_offset").alias("named")), ["dataset", "cut_id"]).where("tar_offset = named").select("cut_id", "tar_size")


def shards_merged(spark, sf):
    folder = _corpus(spark, sf)
    out = mounted(scratch_path(spark, "merged"))
    shards.merged_shards(spark, folder, out, 3)
    return shards.read_shards(spark, [out], positional=True).select("cut_id", "tar_size", F.col("text").isNull().alias("no_text"))


def remaining_work(spark, sf):
    cuts = shards.read_shards(spark, [_corpus(spark, sf)])
    done = table(spark, sf, "documents").where("doc_id % 3 = 0").select(F.format_string("doc%09d", "doc_id").alias("cut_id"))
    return shards.remaining_seconds(cuts, done, 10.0, 200.0).select("cuts", F.round("seconds", 4).alias("seconds"))


def metadata_files(spark, sf):
    """Part of the documents as JSON lines read back as metadata."""
    out = scratch_path(spark, "metadata")
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", "source")
    records.write_json_lines(d, mounted(out))
    files = sorted(str(p) for p in Path(mounted(out)).glob("*.gz"))
    names = [str(Path(p).rename(p.replace(".txt.gz", ".jsonl.gz"))) for p in files]
    return records.metadata(spark, names).select("id", F.md5(F.coalesce("text", F.lit(""))).alias("content"), F.col("custom")["source"].alias("source"))


def json_lines_tolerant(spark, sf):
    out = scratch_path(spark, "lines")
    e = table(spark, sf, "events").select(F.when(F.col("event_id") % 10 == 0, F.lit('{"event_id": 1, "torn')).otherwise(F.to_json(F.struct("event_id", "value"))).alias("value"))
    e.write.text(out)
    return records.json_lines(spark, out, "event_id bigint, value double", "event_id")


def arrow_stream(spark, sf):
    """Embeddings through an Arrow IPC stream."""
    path = mounted(scratch_path(spark, "stream"))
    Path(path).mkdir(parents=True)
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.int32())])

    def run(batches):
        from pyspark import TaskContext

        name = f"{path}/{TaskContext.get().partitionId():05d}"
        with pa.OSFile(f"{name}.tmp", "wb") as f, pa.ipc.new_stream(f, schema) as w:
            for b in batches:
                w.write_batch(b.cast(schema) if b.schema != schema else b)
        Path(f"{name}.tmp").rename(f"{name}.arrow")
        yield pa.RecordBatch.from_pydict({"n": [1]})

    table(spark, sf, "embeddings").select("vec_id", "label").mapInArrow(run, "n bigint").collect()
    return records.read_arrow(spark, [path], "vec_id bigint, label int")


def stream_dedup(spark, sf):
    s = flows.stream_of(spark, f"{sf}/manifest.parquet").select("dataset", "cut_id")
    return flows.appended_once(s, ["dataset", "cut_id"], "dedup")


def stream_dedup_watermark(spark, sf):
    """As `stream_dedup`, with keys forgotten a month after they came."""
    s = flows.stream_of(spark, f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).select("event_id", "ts")
    return flows.drained(flows.once_per_key(s, ["event_id"], "ts", "31 days"), "dedup").select("event_id")


def guarded_dead_letters(spark, sf):
    """A guarded call that fails on every batch with a purchase: its rows come out with the reason."""
    def work(pdf):
        if (pdf.event_type == "purchase").any():
            raise RuntimeError("no purchases")
        return pdf.assign(twice=pdf.value * 2)[["event_id", "twice"]]

    def dead(pdf, error):
        return pdf.assign(twice=None, error=str(error))[["event_id", "twice", "error"]]

    one = table(spark, sf, "events").select("event_id", "value", "event_type")
    by_type = flows.guarded(work, attempts=1, in_a_row=1 << 30, share=1.0, failed=dead)
    return one.groupBy("event_type").applyInPandas(lambda pdf: next(by_type(iter([pdf]))), "event_id bigint, twice double, error string")


def table_ingest(spark, sf):
    """A foreign table as cuts: ids of two columns, no empty payloads, languages filled in."""
    d = table(spark, sf, "documents").withColumn("secs", F.col("n_chars") / 15.0)
    out = records.cuts_from_table(d, "documents", "doc_id", ["source", "doc_id"], "secs", "n_chars", "lang", "und")
    return out.select("cut_id", F.col("lang").alias("language"))


def parquet_sink(spark, sf):
    """A written table appears as a whole and is read back."""
    out = scratch_path(spark, "sink")
    records.write_parquet(table(spark, sf, "documents").select("doc_id", "source"), out)
    return spark.read.parquet(out)


def compressed_lines(spark, sf):
    """JSON lines with zstandard, read back by the metadata reader."""
    out = mounted(scratch_path(spark, "zst"))
    records.write_json_lines(table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), "text"), out, compression="zstd")
    return records.metadata(spark, sorted(map(str, Path(out).glob("*.jsonl.zst")))).select("id", F.md5(F.coalesce("text", F.lit(""))).alias("content"))


def stream_windows(spark, sf):
    s = flows.stream_of(spark, f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).select("ts", "event_type", "value")
    out = flows.drained(flows.windowed(s, "ts", "event_type", "value", "6 hours"), "windows", "complete")
    return out.select(F.unix_timestamp("start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def stream_sessions(spark, sf):
    s = flows.stream_of(spark, f"{sf}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).select("ts", "user_id")
    return flows.drained(flows.sessions(s, "ts", "user_id", "12 hours"), "sessions", "complete").select("user_id", F.unix_micros("start").alias("start"), F.unix_micros("end").alias("end"), "n")


def stream_runs(spark, sf):
    s = flows.stream_of(spark, f"{sf}/events.parquet")
    start = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double")
    rows = s.select("event_id", "user_id", start.alias("start"), (start + 1).alias("end"))
    return flows.drained(flows.numbered_runs(rows, "user_id", "start", "end", "event_id", 43200.0), "runs")


def guarded_map(spark, sf):
    def work(pdf):
        return pdf.assign(twice=pdf.value * 2)[["event_id", "twice"]]

    return table(spark, sf, "events").select("event_id", "value").mapInPandas(flows.guarded(work), "event_id bigint, twice double")


def run_ledger_status(spark, sf):
    """Events as ledger rows: errors are crashes, purchases are ends, the rest starts."""
    e = table(spark, sf, "events")
    rows = e.select((F.col("event_id") % 500).cast("string").alias("run_id"), F.when(F.col("event_type") == "error", "end").otherwise("start").alias("event"), F.lit("c").alias("config"), (F.col("event_id") % 500 % 5).cast("string").alias("stage"), F.lit("xx").alias("language"),
                    F.col("event_id").cast("double").alias("at"), F.when(F.col("event_type") == "error", "crashed").alias("status"), F.when(F.col("event_type") == "error", F.col("event_id")).alias("n_committed"))
    return run_status(rows).drop("last_run")


QUERIES = {f.__name__: f for f in (
    shard_round_trip, shard_offsets, shards_merged, remaining_work, metadata_files, json_lines_tolerant, arrow_stream, table_ingest, parquet_sink, compressed_lines, stream_dedup, stream_dedup_watermark, guarded_dead_letters, stream_windows, stream_sessions, stream_runs, guarded_map, run_ledger_status)}

_ID = "'doc' || lpad(doc_id::varchar, 9, '0')"
SQL = {
    "shard_round_trip": f"select {_ID} as cut_id, coalesce(source, 'none') as dataset, lang as language, md5(coalesce(text, '')) as content, true as same from documents",
    "shard_offsets": f"select {_ID} as cut_id, strlen(coalesce(text, '')) as tar_size from documents",
    "shards_merged": f"select {_ID} as cut_id, strlen(coalesce(text, '')) as tar_size, text is null as no_text from documents",
    "remaining_work": "select count(*) as cuts, round(sum(coalesce(n_chars, 0) / 15.0), 4) as seconds from documents where doc_id % 3 <> 0 and coalesce(n_chars, 0) / 15.0 between 10 and 200",
    "metadata_files": "select doc_id::varchar as id, md5(coalesce(text, '')) as content, source from documents",
    "json_lines_tolerant": "select event_id, value from events where event_id % 10 <> 0",
    "arrow_stream": "select vec_id, label from embeddings",
    "table_ingest": "select concat_ws('_', source, doc_id::varchar) as cut_id, coalesce(lang, 'und') as language from documents where n_chars > 0",
    "parquet_sink": "select doc_id, source from documents",
    "compressed_lines": "select doc_id::varchar as id, md5(coalesce(text, '')) as content from documents",
    "stream_dedup_watermark": "select distinct event_id from events",
    "guarded_dead_letters": "select event_id, case when event_type <> 'purchase' then value * 2 end as twice, case when event_type = 'purchase' then 'no purchases' end as error from events",
    "stream_dedup": "select distinct dataset, cut_id from manifest",
    "stream_windows": "select epoch(time_bucket(interval '6 hours', ts, timestamp '1970-01-01'))::bigint as start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2",
    "stream_sessions": """select user_id, min(t) as start, max(t) + 43200000000 as "end", count(*) as n from (select *, sum(c) over (partition by user_id order by t rows unbounded preceding) as s from (select user_id, t, case when t - lag(t) over (partition by user_id order by t) > 43200000000 then 1 else 0 end as c from (select user_id, epoch_us(ts) as t from events))) group by user_id, s""",
    "stream_runs": """select user_id, event_id, run, row_number() over (partition by user_id, run order by s, event_id) - 1 as clip_num from (select *, sum(c) over (partition by user_id order by s, event_id rows unbounded preceding)::bigint as run from
 (select user_id, event_id, s, case when s - (lag(s) over (partition by user_id order by s, event_id) + 1) > 43200 then 1 else 0 end as c from (select user_id, event_id, floor(epoch(ts)) as s from events)))""",
    "guarded_map": "select event_id, value * 2 as twice from events",
    "run_ledger_status": """select 'c' as config, stage, 'xx' as language, count(*) filter (s = 'running') as running, 0::bigint as ok, count(*) filter (s = 'crashed') as crashed, max(coalesce(n, 0)) as n_committed from (select run_id, max(case when event_type <> 'error' then run_id % 5 end)::varchar as stage, case when bool_or(event_type = 'error') then 'crashed' else 'running' end as s,
 max(case when event_type = 'error' then event_id end) as n from (select *, event_id % 500 as run_id from events) group by 1) group by stage""",
}
