"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Timestamps are rendered from UTC, whatever the machine's zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Bytes of the rows that a Python worker gets at once; a row that is larger comes alone.
PYTHON_BATCH = "4m"
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def get_session(app_name: str = "sievemill", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, fallback: str) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``, else ``fallback``."""
    return (spark.conf.get("spark.checkpoint.dir", None) or fallback).rstrip("/")


def write_and_reread(df: DataFrame, folder: str, partition_by: list[str] | None = None) -> DataFrame:
    """Cut the lineage of ``df`` by writing it as Parquet under ``folder`` and reading it back.

    Several actions follow on the result; a written table survives the loss of executors, and each of the actions
    reads only the columns it needs.
    """
    path = f"{folder}/{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    # The schema is given, not inferred, so that an empty result keeps its columns.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_python_batches(spark: SparkSession) -> None:
    """From here on the session hands rows to Python by ``PYTHON_BATCH``, unless it was given a limit of its own.

    Spark's default is 64 MB, of which every worker holds several copies. Rows and their order stay the same.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, PYTHON_BATCH)


def fill_cores(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a scan that has fewer partitions than the session has cores, for work that costs more than a shuffle.

    A scan of many files or row groups has partitions enough and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
