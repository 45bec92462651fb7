"""Streams: append with exactly-once keys, windows under a watermark, sessions, runs numbered as rows arrive, and guards."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewrack.session import scratch_path


def stream_of(spark: SparkSession, path: str, files_at_once: int = 1) -> DataFrame:
    """A table's files as a stream, so many a micro-batch; the back-pressure of the flows."""
    pattern = f"{path[:-1]}[{path[-1]}]"  # a pattern may name a single file, a plain path only a folder; this one names just it
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_at_once).parquet(pattern)


def drained(stream: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None, sink: str | None = None) -> DataFrame:
    """Run a stream over what is there and return what it has written, as a table in the shared folder.

    Given the same checkpoint and sink again, only files not seen before are read: this is how an interrupted run goes on.
    """
    spark = stream.sparkSession
    out, mark = sink or scratch_path(spark, name), checkpoint or scratch_path(spark, f"{name}-mark")
    if mode == "append":
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start()
    else:
        def replace(batch: DataFrame, _: int) -> None:
            batch.write.mode("overwrite").parquet(out)

        q = stream.writeStream.outputMode(mode).foreachBatch(replace).option("checkpointLocation", mark).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.schema(stream.schema).parquet(out)


def once_per_key(stream: DataFrame, key: list[str], time: str, late: str) -> DataFrame:
    """The first arrival of every key; others that come within `late` of it are dropped, after which its state is forgotten."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def appended_once(stream: DataFrame, key: list[str], name: str, checkpoint: str | None = None, sink: str | None = None) -> DataFrame:
    """The rows of a stream, each key once and for all: a batch appends what no earlier batch has committed.

    The keys are those of the sink itself, so no state grows beside it; a batch that runs again replaces its own rows only.
    Of a key's rows in one batch any one stays.
    """
    spark = stream.sparkSession
    out, mark = sink or scratch_path(spark, name), checkpoint or scratch_path(spark, f"{name}-mark")

    def append(batch: DataFrame, number: int) -> None:
        new = batch.dropDuplicates(key)
        if number and _exists(spark, out):
            held = batch.sparkSession.read.option("basePath", out).parquet(out)
            new = new.join(held.where(F.col("batch") < number).select(*key), key, "left_anti")
        new.select(*batch.columns).write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = stream.writeStream.foreachBatch(append).option("checkpointLocation", mark).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return spark.read.option("basePath", out).parquet(f"{out}/batch=*").select(*stream.columns)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def windowed(stream: DataFrame, time: str, by: str, value: str, width: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts and sums per window and key under a watermark."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    return stream.withWatermark(time, late).groupBy(w.alias("w"), by).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("start"), by, "n", "total")


def sessions(stream: DataFrame, time: str, by: str, gap: str, late: str = "1 hour") -> DataFrame:
    """(by, start, end, n) of sessions that end after `gap` without a row; their bounds are those of session windows."""
    s = stream.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("s"), by).agg(F.count(F.lit(1)).alias("n"))
    return s.select(by, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def numbered_runs(stream: DataFrame, key: str, start: str, end: str, row: str, max_gap: float) -> DataFrame:
    """(key, row, run, clip_num) as rows arrive: a new run where the gap to the previous row's end exceeds `max_gap`.

    The state of a key is three numbers. Rows of one micro-batch are taken in the order of their start; a row that arrives
    after a later one has been numbered continues from that one.
    """
    kinds = stream.schema
    out = f"`{key}` {kinds[key].dataType.simpleString()}, `{row}` {kinds[row].dataType.simpleString()}, run bigint, clip_num bigint"

    def step(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(parts)).sort_values([start, row])
        last, run, n = state.get if state.exists else (None, 0, 0)
        got = []
        for s, e, r in zip(rows[start], rows[end], rows[row]):
            if last is not None and s - last > max_gap:
                run, n = run + 1, 0
            got.append((k[0], r, run, n))
            last, n = float(e), n + 1
        state.update((last, run, n))
        yield pd.DataFrame(got, columns=[key, row, "run", "clip_num"])

    return stream.select(key, start, end, row).groupBy(key).applyInPandasWithState(step, out, "last double, run bigint, n bigint", "append", GroupStateTimeout.NoTimeout)


def guarded(work: Callable[[pd.DataFrame], pd.DataFrame], attempts: int = 3, in_a_row: int = 5, share: float = 0.5, wait: float = 0.5,
            failed: Callable[[pd.DataFrame, Exception], pd.DataFrame] | None = None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For mapInPandas: try a batch again after growing pauses. One that keeps failing comes out as what `failed` makes of it and
    of its error (an `error` column of the result is null for the others); without `failed` it ends the task. The task also ends
    after so many failed batches in a row, or when more than this share of at least ten has failed. No row is lost."""
    dead = failed

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        seen = failed = row = 0
        for batch in batches:
            seen += 1
            for i in range(attempts):
                try:
                    out = work(batch)
                    row = 0
                    break
                except Exception as e:  # noqa: BLE001
                    error, out = e, None
                    if i + 1 < attempts:
                        time.sleep(wait * 2**i)
            if out is None:
                failed, row = failed + 1, row + 1
                if dead is None or row >= in_a_row or seen >= 10 and failed > share * seen:
                    raise RuntimeError(f"{failed} of {seen} batches failed, {row} in a row") from error
                out = dead(batch, error)
            elif dead is not None and "error" not in out:
                out = out.assign(error=None)
            yield out

    return run
