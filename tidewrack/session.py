"""Sessions, table access and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

_OWN: dict[str, str] = {}  # by application, where no folder is configured


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", **extra: str) -> SparkSession:
    """A local session with the settings that the operators expect of a cluster."""
    b = SparkSession.builder.master(f"local[{cores}]").appName("tidewrack").config("spark.driver.memory", memory)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**DEFAULTS, **extra}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table `name` below `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir; where it is unset in local mode, as in tests, a folder of our own."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or _OWN.get(sc.applicationId)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        path = _OWN[sc.applicationId] = tempfile.mkdtemp(prefix="tidewrack-checkpoint-")
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` reliably, so that lost executors cost a re-read and not a recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder as a compressed table and read again, for what is read more than once by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def mounted(path: str) -> str:
    """The path of a folder on a file system that all executors mount, for formats that Spark has no writer for."""
    if path.startswith("file:"):
        return "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        raise ValueError(f"{path} is not a mounted folder")
    return path


def widened(df: DataFrame) -> DataFrame:
    """A plain scan in at least as many partitions as there are cores, for work that is dear by row.

    A table of few row groups would else be worked off by few tasks; one that is split widely enough is left as it is. Only
    for scans with projections and filters: asking for the partitions of a plan with a shuffle would run it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
