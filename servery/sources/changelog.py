"""Bounded reads of a published changelog."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from servery.operators.latest import compact_changelog
from servery.sources.streams import decode_messages
from servery.versions import current_version

# The column that orders the rows of one key: micro-batch number, or offset in the topic.
FILE_SEQUENCE = "batch_id"
KAFKA_SEQUENCE = "offset"


def read_parts(spark: SparkSession, path: str, schema: StructType, parts: Iterable[str]) -> DataFrame:
    """The rows of some parts of a folder; only these are listed."""
    paths = [f"{path}/{part}" for part in parts]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read_file_changelog(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The last snapshot, if one was made, and all rows published since, with their ``batch_id``;
    none if nothing was published.

    The parts are those the folder's pointer names, as many as a snapshot has buckets and as there
    are batches between two snapshots, however many batches there were.
    """
    full = StructType([*schema.fields, StructField(FILE_SEQUENCE, LongType(), True)])
    _, state = current_version(spark, path)
    return read_parts(spark, path, full, [*state.get("parts", {}).values(), *state.get("live", {}).values()])


def read_current(spark: SparkSession, path: str, schema: StructType, key: str) -> DataFrame:
    """Current statistics: each key's last published row."""
    return compact_changelog(read_file_changelog(spark, path, schema), key, FILE_SEQUENCE)


def view_rows(spark: SparkSession, path: str, schema: StructType) -> list[Row]:
    """The few rows that :func:`~servery.sinks.changelog.publish_view` published last; none before that."""
    _, state = current_version(spark, path)
    return [Row(*schema.names)(*values) for values in state.get("rows", [])]


def read_view(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The same as a table, in their order."""
    return few_rows(spark, view_rows(spark, path, schema), schema)


def few_rows(spark: SparkSession, rows: Iterable[Iterable], schema: StructType) -> DataFrame:
    """A table of a few rows written out in the plan, so that no Python worker hands them over."""
    structs = [
        F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for value, field in zip(row, schema.fields)])
        for row in rows
    ]
    kind = ArrayType(StructType(schema.fields))
    return spark.range(1).select(F.inline((F.array(*structs) if structs else F.array()).cast(kind)))


def read_kafka_changelog(
    spark: SparkSession, topic: str, schema: StructType, **options: str
) -> DataFrame:
    """The whole topic as of now, with each message's ``offset``.

    Offsets order one key's messages because the changelog is keyed by its group key, which
    keeps a key inside one partition.
    """
    options = {"startingOffsets": "earliest", "endingOffsets": "latest", **options}
    messages = spark.read.format("kafka").option("subscribe", topic).options(**options).load()
    return decode_messages(messages, schema, KAFKA_SEQUENCE)


def read_kafka_current(
    spark: SparkSession, topic: str, schema: StructType, key: str, **options: str
) -> DataFrame:
    """Current statistics out of a topic that ``order_stats --publish kafka`` writes."""
    return compact_changelog(read_kafka_changelog(spark, topic, schema, **options), key, KAFKA_SEQUENCE)
