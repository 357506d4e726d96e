"""Keyed JSON messages, and files of names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servery.functions.payload import encode


def keyed_messages(rows: DataFrame, key: str) -> DataFrame:
    """Message key and JSON value of each row."""
    return rows.select(F.col(key).cast("string").alias("key"), encode(*rows.columns).alias("value"))


def publish_to_kafka(messages: DataFrame, topic: str, **options: str) -> None:
    """Options carry ``kafka.bootstrap.servers``."""
    messages.write.format("kafka").option("topic", topic).options(**options).save()


def publish_to_files(messages: DataFrame, folder: str) -> None:
    """The file twin of a topic: one message per line, to be replayed as a stream."""
    messages.select("value").write.mode("append").text(folder)


def write_names(names: DataFrame, folder: str, column: str = "restaurant_name") -> None:
    """One JSON object per name, spread over as many files as there are tasks."""
    names.select(F.col(column).alias("restaurant_name")).write.json(folder)
