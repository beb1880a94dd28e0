"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "corpusmill", **conf) -> SparkSession:
    """A session with the settings the jobs here expect.

    On a cluster leave ``master`` unset and size the shuffle through AQE: a high
    initial partition number, coalesced at run time to the advisory size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small from here on: texts may be long, and a task's Python worker holds a
    whole batch. Smaller settings of the session stay."""
    for name, most in (("maxRecordsPerBatch", 1000), ("maxBytesPerBatch", 8 << 20)):
        key = f"spark.sql.execution.arrow.{name}"
        held = spark.conf.get(key)
        if not held.isdigit() or not 0 < int(held) <= most:
            spark.conf.set(key, str(most))


_written: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder that driver and executors share, for a table between two jobs.

    It lies below ``spark.checkpoint.dir``, else below the session's warehouse folder. On a
    cluster a warehouse on a machine's own disk is no such place, and an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        alone = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
        if not alone and urlsplit(warehouse).scheme in ("", "file"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = f"{warehouse.rstrip('/')}/_scratch"
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


# From Spark 4.1 on, deletes the shuffle files of a query when it ends, not when the driver collects garbage.
_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """The table, written to a scratch folder and read back: its lineage ends here, and what is
    used twice is computed once. The shuffles it was made by are deleted."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    held = spark.conf.get(_FILE_CLEANUP, None)
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_FILE_CLEANUP) if held is None else spark.conf.set(_FILE_CLEANUP, held)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote to scratch folders. Results that still read from
    there must have been consumed or written before."""
    for path in _written.pop(spark.sparkContext.applicationId, []):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
