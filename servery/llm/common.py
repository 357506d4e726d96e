"""Helpers that several operators share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space, and tab to carriage return.
WORD_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as make it no column of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, or where that is unset (tests,
    one machine) a folder in the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_staging"
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The table written once to the shared folder and read back: it is not computed again, and
    a lost executor takes nothing of it away."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def buckets_for(rows: int, rows_per_bucket: int = 4096, most: int = 65536) -> int:
    """A power of two of buckets of about ``rows_per_bucket`` rows. Beyond ``most`` buckets it
    is the buckets that grow, so that a table with a row for each bucket stays bounded."""
    wanted = max(1, -(-rows // rows_per_bucket))
    return min(most, 1 << (wanted - 1).bit_length())


def hash_bucket(h: Column, buckets: int) -> Column:
    """The leading bits of a 64-bit hash; buckets are contiguous ranges of the unsigned hash."""
    bits = buckets.bit_length() - 1
    return F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("long")
