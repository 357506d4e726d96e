"""Intermediate tables on storage that all executors share.

A table that later steps must read unchanged is written, not cached: what a lost executor held
in a cache would be computed again, and might come out in another order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``. Where that is
    unset, on one machine only, a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is written yet."""
    return f"{shared_folder(spark)}/servery-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The table written once and read back, and its path, to be deleted when it is done with."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete stored tables, wherever Spark can reach them."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
