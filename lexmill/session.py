"""Session helpers shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "lexmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; `conf` overrides any of them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Where the setting is absent in local mode (tests) a temporary folder is made once per session.
    On a cluster its absence is an error: executors would write to disks the others cannot see.
    """
    for key in ("spark.checkpoint.dir", "spark.lexmill.scratch.dir"):
        value = spark.conf.get(key, None)
        if value:
            return value.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master is {master})")
    value = tempfile.mkdtemp(prefix="spark-lexmill-")
    spark.conf.set("spark.lexmill.scratch.dir", value)
    return value


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def read_or_empty(spark: SparkSession, schema: str, path: str, **options):
    """Parquet rows below `path`; none, with the schema, if nothing has been written there yet."""
    try:
        return spark.read.options(**options).schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def materialize(df, label: str = "stage"):
    """Write `df` to the shared folder and read it back.

    Cuts the lineage and keeps the rows when executors are lost.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_measured(df, label: str = "stage"):
    """`materialize` and the size of the rows in bytes, both from one job."""
    size = F.lit(16)
    for name in df.columns:
        size = size + F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) + F.lit(8)
    seen = Observation()
    stored = materialize(df.observe(seen, F.sum(size).alias("bytes")), label)
    return stored, seen.get["bytes"] or 0


def spread(df, key: str):
    """Give a scan at least one partition per core before row-local work on large texts.

    A table with as many splits as cores, which is any large one, is returned as it is; only a
    table in few splits is hashed by `key` over the cores. Call it on plain scans.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def hashed(df, key: str):
    """Hash long texts by `key` for CPU-heavy work.

    The explicit number keeps adaptive execution from merging partitions that are small in bytes
    but costly to process.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return df.repartition(n, key)
