"""Stored tables: parquet folders, or a database reached over JDBC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from servery.functions.payload import encode
from servery.operators.quality import require_rows


def scan_table(
    spark: SparkSession,
    location: str,
    schema: StructType | str | None = None,
    where: Column | str | None = None,
    fmt: str = "parquet",
    required: bool = False,
    **options: str,
) -> DataFrame:
    """A table, filtered in the scan where the format can do so; ``required``: no row is an
    error.

    For ``fmt="jdbc"`` the location is the table name and the options carry ``url`` and, for
    a parallel read, ``partitionColumn``, ``lowerBound``, ``upperBound``, ``numPartitions``.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        table = reader.option("dbtable", location).load()
    else:
        table = (reader.schema(schema) if schema is not None else reader).load(location)
    table = table if where is None else table.where(where)
    return require_rows(table, location) if required else table


def as_json_rows(table: DataFrame) -> DataFrame:
    """Each row as one JSON object in column ``value``."""
    return table.select(encode().alias("value"))


def query_tables(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """SQL text over DataFrames, which the text names as ``{orders}``, ``{users}``, ..."""
    return spark.sql(query, **tables)
