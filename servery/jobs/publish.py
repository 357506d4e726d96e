"""Publishes stored orders and order items as messages.

    spark-submit servery/jobs/publish.py --tables /shared/tables --from 3/8/2024 --to 3/9/2024 \\
        --format kafka --servers broker:9092
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from servery.functions.dates import parse_day
from servery.operators.joins import enrich_orders
from servery.operators.quality import check_period, in_period
from servery.schemas import ORDER_ITEM, ORDERS, RESTAURANTS
from servery.session import build_session
from servery.sinks.messages import keyed_messages, publish_to_files, publish_to_kafka
from servery.sources.tables import scan_table


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Publish stored orders")
    parser.add_argument("--tables", required=True, help="folder of the stored tables")
    parser.add_argument("--from", dest="start", required=True, help="first day, month/day/year")
    parser.add_argument("--to", dest="end", required=True, help="last day, included")
    parser.add_argument("--format", choices=["kafka", "text"], default="kafka")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--orders", default="orders_topic")
    parser.add_argument("--items", default="order_items_topic")
    parser.add_argument("--shuffle-bytes", type=int, help="of the largest shuffle")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session("publish-orders", shuffle_bytes=args.shuffle_bytes)
    days = tuple(spark.range(1).select(parse_day(F.lit(args.start)), parse_day(F.lit(args.end))).first())
    if None in days:
        raise ValueError("days are written month/day/year")
    check_period(*days)
    orders = scan_table(spark, f"{args.tables}/orders", ORDERS, in_period("order_datetime", *days))
    restaurants = scan_table(spark, f"{args.tables}/restaurants", RESTAURANTS)
    items = scan_table(spark, f"{args.tables}/order_item", ORDER_ITEM).join(
        orders.select(F.col("order_id").alias("fk_order")), "fk_order", "left_semi"
    )
    topics = {
        args.orders: keyed_messages(enrich_orders(orders, restaurants), "order_id"),
        args.items: keyed_messages(items.select(ORDER_ITEM.names), "order_item_id"),
    }
    for topic, messages in topics.items():
        if args.format == "kafka":
            publish_to_kafka(messages, topic, **{"kafka.bootstrap.servers": args.servers})
        else:
            publish_to_files(messages, topic)


if __name__ == "__main__":
    main()
