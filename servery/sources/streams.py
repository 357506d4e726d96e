"""Inbound JSON topics: Kafka, or a folder of text files replayed in the same way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from servery.functions.payload import decode, with_parsed


def topic_stream(
    spark: SparkSession, topic: str, fmt: str = "kafka", **options: str
) -> DataFrame:
    """Unbounded stream of message texts in column ``value``, from the earliest on.

    ``topic`` is a topic name for ``fmt="kafka"`` (pass ``kafka.bootstrap.servers``) and a
    folder for ``fmt="text"``.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options = {"subscribe": topic, "startingOffsets": "earliest", **options}
        stream = reader.options(**options).load()
    else:
        stream = reader.options(**options).load(topic)
    return stream.select(F.col("value").cast("string").alias("value"))


def decode_messages(messages: DataFrame, schema: StructType, *keep: str) -> DataFrame:
    """Message texts to the schema's columns, after the columns to keep. Works on streams and
    on batches; each text is parsed once, whatever is selected or filtered later."""
    parsed = with_parsed(messages, decode(F.col("value"), schema), "_data")
    return parsed.select(*keep, "_data.*")
