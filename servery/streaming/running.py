"""Running statistics over the order streams.

Totals are kept per key for ever, as the statistics are defined over all orders; state grows
with the number of restaurants and menu items, not with the number of orders.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from servery.operators.aggregates import item_counts, restaurant_stats
from servery.operators.joins import labelled_item_counts
from servery.operators.quality import Split, check_messages, not_money, split
from servery.operators.topk import top_k
from servery.schemas import (
    LABELLED_ITEM_STATS,
    MENU_ITEM_STATS,
    ORDER_EVENT,
    ORDER_ITEM_EVENT,
    fields,
    restaurant_stats_schema,
)
from servery.sinks.changelog import SNAPSHOT_EVERY, AfterBatch, publish_view, start_file_changelog
from servery.sources.changelog import few_rows, read_current, read_view, view_rows
from servery.streaming.rejects import RejectCounts, await_counts, counting_rejects, read_rejects, reject_metrics

RESTAURANT_TOPIC, ITEM_TOPIC = "restaurant_stats", "menu_item_stats"
ORDER_REJECTS, ITEM_REJECTS = "orders", "order_items"
#: How many rows are shown first to find one of a top-k.
_SHOWN_FIRST = 10


def order_events(
    messages: DataFrame,
    key: str = "restaurant_name",
    schema: StructType = ORDER_EVENT,
    observed: str | None = None,
) -> Split:
    """Typed order events, and the messages that cannot be counted under ``key``.

    An amount that is no number would spoil a running total for good, so its message is kept
    apart. A rating that is no number costs the rating only.
    """
    checked = check_messages(
        messages, schema, required=[key], checks={"amount_not_finite": not_money("total_cost")}
    )
    rating = F.col("cust_restaurant_rating")
    finite = F.when(F.abs(rating) < float("inf"), rating)
    return split(counting_rejects(checked.withColumn("cust_restaurant_rating", finite), observed))


def order_item_events(
    messages: DataFrame, schema: StructType = ORDER_ITEM_EVENT, observed: str | None = None
) -> Split:
    return split(counting_rejects(check_messages(messages, schema, required=["fk_menu_item"]), observed))


def counted_orders(messages: DataFrame, key: str, observed: str | None = None) -> Split:
    """Only the fields the statistics need are parsed out of a message."""
    return order_events(messages, key, fields(ORDER_EVENT, key, "total_cost", "cust_restaurant_rating"), observed)


def counted_items(messages: DataFrame, observed: str | None = None) -> Split:
    return order_item_events(messages, fields(ORDER_ITEM_EVENT, "fk_menu_item", "item_quantity"), observed)


def running_restaurant_stats(messages: DataFrame, key: str = "restaurant_name", observed: str | None = None) -> DataFrame:
    """``observed`` names the metrics in which each batch's unusable messages are counted."""
    return restaurant_stats(counted_orders(messages, key, observed).usable, key)


def running_item_counts(messages: DataFrame, observed: str | None = None) -> DataFrame:
    return item_counts(counted_items(messages, observed).usable)


def start_quarantine(
    bad_messages: DataFrame, path: str, checkpoint: str, name: str | None = None, **trigger
) -> StreamingQuery:
    """Keep unusable messages and the reason in a parquet folder."""
    writer = (
        bad_messages.select("value", "reason")
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_quarantines(
    root: str, order_messages: DataFrame, item_messages: DataFrame, key: str, **trigger
) -> list[StreamingQuery]:
    """Keep the unusable messages of both topics below ``root``."""
    bad = {
        ORDER_REJECTS: counted_orders(order_messages, key).quarantined,
        ITEM_REJECTS: counted_items(item_messages).quarantined,
    }
    return [
        start_quarantine(
            messages, f"{root}/quarantine/topic={topic}", f"{root}/checkpoints/quarantine_{topic}", **trigger
        )
        for topic, messages in bad.items()
    ]


@dataclass(frozen=True)
class OrderStatsJob:
    """The two running statistics below a root folder, each with its own changelog and checkpoint,
    and the top of each as of the last batch."""

    root: str
    key: str = "restaurant_name"
    files: int | None = None  # files per changelog batch
    snapshot_every: int = SNAPSHOT_EVERY  # batches
    top: int = 10

    def changelog(self, topic: str) -> str:
        return f"{self.root}/{topic}"

    def view(self, topic: str) -> str:
        return f"{self.root}/top/{topic}"

    def start(
        self,
        order_messages: DataFrame,
        item_messages: DataFrame,
        quarantine: bool = True,
        menu: Callable[[], DataFrame] | None = None,
        **trigger,
    ) -> list[StreamingQuery]:
        """Messages that are not counted are numbered by reason in the same read, see
        :meth:`rejects`; ``quarantine`` keeps them as well, at the cost of a second read of each
        topic. ``menu`` reads the menu items as they are; without it no top items are published."""
        order_messages.sparkSession.streams.addListener(RejectCounts(order_messages.sparkSession, self.root))
        restaurants = running_restaurant_stats(order_messages, self.key, reject_metrics(self.root, ORDER_REJECTS))
        items = running_item_counts(item_messages, reject_metrics(self.root, ITEM_REJECTS))
        top_restaurants = self._top(RESTAURANT_TOPIC, self.key, "total_revenue")
        top_items = [] if menu is None else [self._top(ITEM_TOPIC, "fk_menu_item", "item_quantity", labelled_by(menu))]
        queries = [
            self._start(restaurants, RESTAURANT_TOPIC, self.key, [top_restaurants], trigger),
            self._start(items, ITEM_TOPIC, "fk_menu_item", top_items, trigger),
        ]
        if quarantine:
            queries += start_quarantines(self.root, order_messages, item_messages, self.key, **trigger)
        return queries

    def _top(self, topic: str, key: str, value: str, shown: Callable[[DataFrame], DataFrame] | None = None) -> AfterBatch:
        return live_top_k(self.view(topic), key, value, self.changelog(topic), k=self.top, shown=shown)

    def _start(self, stats: DataFrame, topic: str, key: str, after: list[AfterBatch], trigger: dict) -> StreamingQuery:
        return start_file_changelog(
            stats,
            self.changelog(topic),
            f"{self.root}/checkpoints/{topic}",
            after_batch=after,
            files=self.files,
            key=key,
            snapshot_every=self.snapshot_every,
            **trigger,
        )

    def restaurant_stats(self, spark: SparkSession) -> DataFrame:
        """Current statistics per restaurant."""
        return read_current(spark, self.changelog(RESTAURANT_TOPIC), restaurant_stats_schema(self.key), self.key)

    def item_counts(self, spark: SparkSession) -> DataFrame:
        """Current quantities per menu item."""
        return read_current(spark, self.changelog(ITEM_TOPIC), MENU_ITEM_STATS, "fk_menu_item")

    def rejects(self, spark: SparkSession, after: list[StreamingQuery] = ()) -> DataFrame:
        """``topic``, ``reason`` and ``n`` messages that were not counted up to now. The numbers are
        noted a moment after a batch ends; with ``after``, only when those of all its batches are."""
        for topic in (ORDER_REJECTS, ITEM_REJECTS):
            await_counts(spark, self.root, topic, after)
        return read_rejects(spark, self.root, (ORDER_REJECTS, ITEM_REJECTS))

    def top_restaurants(self, spark: SparkSession) -> DataFrame:
        """The top restaurants as published after the last batch."""
        return read_view(spark, self.view(RESTAURANT_TOPIC), restaurant_stats_schema(self.key))

    def top_items(self, spark: SparkSession) -> DataFrame:
        """The top menu items, labelled, as published after the last batch."""
        return read_view(spark, self.view(ITEM_TOPIC), LABELLED_ITEM_STATS)


def labelled_by(menu: Callable[[], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Item statistics joined to the menu as it is when they are shown. An item that the menu
    does not have is not shown."""
    return lambda stats: labelled_item_counts(stats, menu(), "fk_menu_item").select(LABELLED_ITEM_STATS.names)


def await_all(queries: list[StreamingQuery]) -> None:
    """Wait until every query has ended. The first to fail stops the others and is raised:
    waiting for one to end before looking at the next would not see a failure in a later one."""
    try:
        while any(query.isActive for query in queries):
            for query in queries:
                query.awaitTermination(1)
        for query in queries:
            query.awaitTermination()
    except StreamingQueryException:
        for query in queries:
            query.stop()
        raise


def live_top_k(
    path: str,
    key: str,
    value: str,
    changelog: str,
    k: int = 10,
    shown: Callable[[DataFrame], DataFrame] | None = None,
) -> AfterBatch:
    """Publishes the top-k after each batch to a folder, read by
    :func:`~servery.sources.changelog.read_view`; pass it as ``after_batch``.

    ``shown`` makes rows of statistics into what is published, which keeps ``key`` and ``value``: a
    join with a static table, say. It comes before the cut, so a row that it drops takes no place.

    A batch can only move its own keys. As long as k rows still rank no lower than the previous
    last row, nothing outside the previous top-k and the batch can be among them; if fewer do,
    because totals fell or a row is shown no more, or if there is no full previous top-k, all current
    statistics are read. (A row that comes to be shown without a change of its statistics is seen
    when its statistics change or all are read.)

    Of a batch only rows that rank no lower than the previous last row are shown, and of those, as of
    all statistics, the best few first: a static table meets a few rows, and neither it nor the batch
    is sent to all tasks. More are shown only if that leaves less than k of them, by a join that
    sorts both sides: neither the table nor the statistics go through the driver.
    """
    present = shown or (lambda stats: stats)
    few = k if shown is None else _SHOWN_FIRST * k

    def no_lower(row: Row, schema: StructType) -> Column:
        """Whether a row ranks no lower than ``row``."""
        known, at, after = F.col(value), row[value], F.col(key) <= F.lit(row[key])
        if at is None:
            return known.isNotNull() | after
        at = F.lit(at).cast(schema[value].dataType)
        return (known > at) | ((known == at) & after)

    def best_shown(stats: DataFrame, schema: StructType) -> list[Row]:
        asked = top_k(stats, value, key, few).collect()
        best = top_k(present(few_rows(stats.sparkSession, asked, schema)), value, key, k).collect()
        if len(best) < k and len(asked) == few and shown is not None:
            # Many rows meet the static table, which a broadcast would take through the driver.
            best = top_k(present(stats.hint("merge")), value, key, k).collect()
        return best

    def rank(row: Row) -> tuple:
        return (row[value] is None, -(row[value] or 0), row[key])

    def refresh(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        schema = present(batch.limit(0)).schema
        previous = view_rows(spark, path, schema)
        best: list[Row] = []
        if len(previous) == k and set(batch.columns) <= set(schema.names):
            keys = F.col(key).isin([row[key] for row in previous])
            moved = {row[key] for row in batch.where(keys).select(key).collect()}
            known = [[row[c] for c in batch.columns] for row in previous if row[key] not in moved]
            rising = batch.where(no_lower(max(previous, key=rank), batch.schema))
            best = best_shown(few_rows(spark, known, batch.schema).unionByName(rising), batch.schema)
        if len(best) < k:
            best = best_shown(read_current(spark, changelog, batch.schema, key), batch.schema)
        if best != previous:
            publish_view(spark, best, path)

    return refresh
