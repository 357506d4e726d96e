"""Running statistics with another number of state partitions.

How many parts the state of a query has is fixed in its checkpoint. To change it, the totals are
read out of the last committed state and given to a new query, with a checkpoint of its own, as one
more input: a row for each key that adds all that was counted before. The new query takes up the topics
where the old one ended, and goes on with the same changelog.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StructField, StructType

from servery.functions.money import amount, money, total
from servery.schemas import MENU_ITEM_STATS, ORDER_EVENT
from servery.sinks.changelog import start_file_changelog
from servery.streaming.running import counted_items, counted_orders
from servery.versions import current_version, file_names, publish_version, read_text

#: What the state of each statistic holds for a key, in order, by the aggregates' buffers.
_REVENUE_STATE = "struct<revenue: decimal(38,2), none: boolean, ratings: double, rated: bigint>"
_COUNT_STATE = "struct<item_quantity: bigint, none: boolean>"


@dataclass(frozen=True)
class Carried:
    """What a stopped query had counted, stored in ``folder``, where it stopped, and the number
    in its changelog that comes next."""

    folder: str
    checkpoint: str
    batch_id: int
    next_batch: int

    def totals(self, spark: SparkSession, schema: StructType) -> DataFrame:
        """A stream of the stored rows."""
        return spark.readStream.schema(schema).parquet(self.folder)


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last micro-batch that was completed."""
    done = [int(name) for name in file_names(spark, f"{checkpoint}/commits") if name.isdigit()]
    if not done:
        raise ValueError(f"no batch of {checkpoint} was completed")
    return max(done)


def read_carried(spark: SparkSession, folder: str) -> Carried:
    """What was stored there: for starting the new query again from its own checkpoint."""
    _, noted = current_version(spark, folder)
    return Carried(folder, noted["checkpoint"], noted["batch_id"], noted["next_batch"])


def _carried(
    spark: SparkSession, checkpoint: str, changelog: str, folder: str, kind: str, key: StructField, value: str
) -> Carried:
    last = last_batch(spark, checkpoint)
    state = spark.read.format("statestore").option("batchId", last).load(checkpoint)
    rows = state.select(F.element_at(F.array("key.*"), 1).cast(key.dataType).alias(key.name), F.col("value").cast(kind).alias("v"))
    rows = rows.select(key.name, "v.*")
    # A sum that is NULL although something was added went past its type, and cannot be taken up.
    past = F.raise_error(F.lit(f"a total of {checkpoint} is past its type"))
    kept = F.when(F.col(value).isNull() & ~F.col("none"), past).otherwise(F.col(value))
    rows.withColumn(value, kept).drop("none").write.parquet(folder)
    _, log = current_version(spark, changelog)
    published = max([log.get("snapshot", -1), *map(int, log.get("live", {}))])
    publish_version(spark, folder, {"checkpoint": checkpoint, "batch_id": last, "next_batch": published + 1}, [])
    return read_carried(spark, folder)


def carry_revenue(
    spark: SparkSession, checkpoint: str, changelog: str, folder: str, key: str = "restaurant_name"
) -> Carried:
    """Store the totals of a stopped query of restaurant statistics."""
    return _carried(spark, checkpoint, changelog, folder, _REVENUE_STATE, ORDER_EVENT[key], "revenue")


def carry_counts(spark: SparkSession, checkpoint: str, changelog: str, folder: str) -> Carried:
    """Store the totals of a stopped query of item counts."""
    return _carried(spark, checkpoint, changelog, folder, _COUNT_STATE, MENU_ITEM_STATS["fk_menu_item"], "item_quantity")


def remaining_files(session: SparkSession, topic: str, carried: Carried, **options: str) -> DataFrame:
    """The messages of a topic of files that were not counted yet. Files are told apart by their
    names in the old query's log; those it had are listed and read once more, and left out."""
    log = session.read.text(f"{carried.checkpoint}/sources/0").where("value LIKE '{%'")
    entry = F.from_json("value", "path string, batchId bigint")
    seen = log.select(entry.alias("e")).where(F.col("e.batchId") <= carried.batch_id).select(_plain(F.col("e.path")).alias("_path"))
    stream = session.readStream.format("text").options(**options).load(topic)
    named = stream.select("value", _plain(F.col("_metadata.file_path")).alias("_path"))
    return named.join(seen.distinct(), "_path", "left_anti").select("value")


def _plain(path: Column) -> Column:
    """A path with one slash after its scheme, however it was written."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def starting_offsets(spark: SparkSession, carried: Carried) -> str:
    """Where a topic of a broker is taken up: the option ``startingOffsets`` of its stream."""
    # A line for the format, one for the batch, and then one for each source.
    lines = read_text(spark, f"{carried.checkpoint}/offsets/{carried.batch_id}").splitlines()
    return json.dumps(json.loads(lines[2]))


def resumed_restaurant_stats(messages: DataFrame, carried: Carried, key: str = "restaurant_name") -> DataFrame:
    """As :func:`~servery.streaming.running.running_restaurant_stats`, going on from stored totals."""
    rating = F.col("cust_restaurant_rating")
    orders = counted_orders(messages, key).usable.select(
        key, _as(money(F.col("total_cost")), "revenue", "decimal(38,2)"), rating.alias("ratings"), F.when(rating.isNotNull(), 1).cast("bigint").alias("rated")
    )
    before = carried.totals(messages.sparkSession, _schema(ORDER_EVENT[key], revenue="decimal(38,2)", ratings="double", rated="bigint"))
    return orders.unionByName(before).groupBy(key).agg(
        amount(total(F.col("revenue"))).alias("total_revenue"),
        F.try_divide(F.sum("ratings"), F.sum("rated")).alias("avg_rate"),
    )


def resumed_item_counts(messages: DataFrame, carried: Carried) -> DataFrame:
    """As :func:`~servery.streaming.running.running_item_counts`, going on from stored totals."""
    items = counted_items(messages).usable.select("fk_menu_item", "item_quantity")
    before = carried.totals(messages.sparkSession, _schema(MENU_ITEM_STATS["fk_menu_item"], item_quantity="bigint"))
    both = items.unionByName(before)
    return both.groupBy("fk_menu_item").agg(F.try_sum("item_quantity").alias("item_quantity"))


def _as(column: Column, name: str, kind: str) -> Column:
    return column.cast(kind).alias(name)


def _schema(key: StructField, **others: str) -> StructType:
    kinds = {name: DataType.fromDDL(kind) for name, kind in others.items()}
    return StructType([key, *[StructField(name, kind, True) for name, kind in kinds.items()]])


def start_resumed(stats: DataFrame, carried: Carried, path: str, checkpoint: str, key: str, **options) -> StreamingQuery:
    """Go on with the changelog of the old query. Its numbers go on as well, and the first batch
    publishes each carried key once."""
    return start_file_changelog(stats, path, checkpoint, key=key, first_batch=carried.next_batch, **options)
