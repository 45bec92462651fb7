"""Stages as a graph, run ledger and status."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.sources.records import finish_stage, guard_config


class Pipeline:
    """Named stages over tables, each written once below `root`; a finished stage is read, not run again."""

    def __init__(self, spark: SparkSession, root: str, config: dict):
        self.spark, self.root, self.config = spark, root, config
        self.stages: dict[str, tuple[list[str], Callable[..., DataFrame]]] = {}

    def stage(self, name: str, *needs: str):
        """Decorator: a function of the tables of the stages it needs."""
        def add(f: Callable[..., DataFrame]):
            unknown = [n for n in needs if n not in self.stages]
            if unknown:
                raise ValueError(f"{name} needs {unknown}, which come later or not at all")
            self.stages[name] = (list(needs), f)
            return f

        return add

    def run(self, start: str | None = None, stop: str | None = None) -> dict[str, DataFrame]:
        """Run the stages from `start` to `stop`, both included; those before `start` must be finished."""
        guard_config(self.root, self.config)
        names = list(self.stages)
        first, last = names.index(start) if start else 0, names.index(stop) if stop else len(names) - 1
        done: dict[str, DataFrame] = {}
        for i, name in enumerate(names[: last + 1]):
            needs, f = self.stages[name]
            folder = Path(self.root, name)
            if not Path(folder, "_SUCCESS").exists():
                if i < first:
                    raise ValueError(f"stage {name} is not finished")
                f(self.config, *[done[n] for n in needs]).write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/data")
                finish_stage(str(folder), name, self.config, {"rows": self.spark.read.parquet(f"{folder}/data").count()})
            done[name] = self.spark.read.parquet(f"{folder}/data")
        return done


def rendered(template, values: dict[str, str]):
    """A nested template with every {name} replaced; an unknown name stays as it is."""
    if isinstance(template, str):
        return re.sub(r"\{(\w+)\}", lambda m: str(values.get(m[1], m[0])), template)
    if isinstance(template, dict):
        return {k: rendered(v, values) for k, v in template.items()}
    return [rendered(v, values) for v in template] if isinstance(template, list) else template


class Ledger:
    """Append-only JSON lines of run starts and ends."""

    def __init__(self, path: str):
        self.path = Path(path)

    def _append(self, record: dict) -> None:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        with self.path.open("a") as f:
            f.write(json.dumps(record) + "\n")

    def start(self, config: str, stage: str, language: str) -> str:
        run = uuid.uuid4().hex
        self._append({"event": "start", "run_id": run, "config": config, "stage": stage, "language": language, "at": time.time()})
        return run

    def end(self, run: str, status: str, committed: int) -> None:
        self._append({"event": "end", "run_id": run, "status": status, "n_committed": committed, "at": time.time()})


def run_status(events: DataFrame) -> DataFrame:
    """(config, stage, language, running, ok, crashed, n_committed, last_run) from ledger rows; a run without an end is running."""
    one = events.groupBy("run_id").agg(*[F.max(F.when(F.col("event") == "start", F.col(c))).alias(c) for c in ("config", "stage", "language")], F.max(F.when(F.col("event") == "start", F.col("at"))).alias("started"),
                                       F.coalesce(F.max(F.when(F.col("event") == "end", F.col("status"))), F.lit("running")).alias("status"), F.max("n_committed").alias("n"))
    count = [F.count_if(F.col("status") == s).alias(s) for s in ("running", "ok", "crashed")]
    return one.groupBy("config", "stage", "language").agg(*count, F.max(F.coalesce("n", F.lit(0))).alias("n_committed"), F.max_by("run_id", F.struct(F.coalesce("n", F.lit(0)), "started")).alias("last_run"))


def last_crashes(events: DataFrame, k: int = 10) -> DataFrame:
    return events.where("event = 'end' and status = 'crashed'").orderBy(F.col("at").desc(), "run_id").limit(k).select("run_id", "at")
