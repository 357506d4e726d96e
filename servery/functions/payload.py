"""JSON payloads of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt"


def decode(value: Column, schema: StructType) -> Column:
    """Message text to a struct; a field that does not parse is NULL on its own."""
    return F.from_json(value.cast("string"), schema)


def decode_marked(value: Column, schema: StructType) -> Column:
    """As :func:`decode`, with the text kept in ``_corrupt`` where some of it did not parse."""
    marked = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    return F.from_json(value.cast("string"), marked, {"columnNameOfCorruptRecord": CORRUPT})


def encode(*columns: str | Column) -> Column:
    """Columns to message text; NULL fields are left out."""
    return F.to_json(F.struct(*(columns or ("*",))))


def with_parsed(df: DataFrame, parsed: Column, name: str) -> DataFrame:
    """Adds a column that is costly to compute and read by later filters.

    A plain column would be computed again inside every filter that Catalyst moves below it; it
    does not move filters below a generated one.
    """
    return df.select("*", F.explode_outer(F.array(parsed)).alias(name))
