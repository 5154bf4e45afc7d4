"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "waybill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for; `conf` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in this application's folder below the one that the cluster
    names for checkpoints.

    Only a local session may fall back to a temporary folder: on a cluster it
    would be machine-local, and lost together with its executor.
    """
    return f"{_run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove all scratch of this application. Results that were not written
    elsewhere are gone afterwards."""
    remove(spark, _run_folder(spark))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path and all below it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _run_folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        base = _local_scratch()
    return f"{base.rstrip('/')}/waybill/{spark.sparkContext.applicationId}"


@functools.cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="waybill-")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to scratch Parquet and read it back, which cuts its lineage.

    Readers prune columns, a lost executor costs a re-read rather than a
    recomputation, and positions tagged before the write can never change.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
