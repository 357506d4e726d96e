"""Shows both top-10s and a page of the orders list.

    spark-submit servery/jobs/dashboard.py --tables /shared/tables --root /shared/stats \\
        --sort total_cost --descending --size 25 --page 2

The top-10s are made from the changelogs below the root or, with ``--changelog kafka``, from the topics
that ``order_stats.py --publish kafka`` writes; with ``--live`` they are what that job published
after its last batch.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from servery.operators.paging import PAGE_SIZES
from servery.plans.dashboard import order_listing, top_items, top_restaurants
from servery.schemas import MENU_ITEM_STATS, MENU_ITEMS, ORDERS, RESTAURANTS, USERS, restaurant_stats_schema
from servery.session import build_session
from servery.sources.changelog import few_rows, read_kafka_current
from servery.sources.tables import scan_table
from servery.streaming.running import ITEM_TOPIC, RESTAURANT_TOPIC, OrderStatsJob

COLUMNS = [
    "order_id",
    "user_fullname",
    "order_datetime",
    "restaurant_name",
    "total_cost",
    "cust_restaurant_rating",
]


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Order dashboard")
    parser.add_argument("--tables", required=True, help="folder of the stored tables")
    parser.add_argument("--root", help="folder of the running statistics")
    parser.add_argument("--changelog", choices=["files", "kafka"], default="files")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--live", action="store_true", help="as published by the running job")
    parser.add_argument("--key", default="restaurant_name", help="group key of the statistics")
    parser.add_argument("--sort", choices=COLUMNS, default="order_id")
    parser.add_argument("--descending", action="store_true")
    parser.add_argument("--size", type=int, choices=PAGE_SIZES, default=10)
    parser.add_argument("--page", type=int, default=1)
    parser.add_argument("--after", type=json.loads, help="the cursor that was printed below a page: show the next one")
    parser.add_argument("--before", type=json.loads, help="show the page in front of a cursor")
    parser.add_argument("--shuffle-bytes", type=int, help="of the largest shuffle")
    args = parser.parse_args(argv)
    if (args.changelog == "kafka") == (args.servers is None) or (args.changelog == "files") == (args.root is None):
        parser.error("files need --root, and kafka needs --servers")
    if args.live and args.changelog == "kafka":
        parser.error("--live reads files")
    return args


def tops(spark: SparkSession, args: argparse.Namespace, menu: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both top-10s."""
    if args.changelog == "kafka":
        servers = {"kafka.bootstrap.servers": args.servers}
        schema = restaurant_stats_schema(args.key)
        stats = read_kafka_current(spark, RESTAURANT_TOPIC, schema, args.key, **servers)
        counts = read_kafka_current(spark, ITEM_TOPIC, MENU_ITEM_STATS, "fk_menu_item", **servers)
    else:
        job = OrderStatsJob(args.root, args.key)
        if args.live:
            return job.top_restaurants(spark), job.top_items(spark).drop("fk_menu_item")
        stats, counts = job.restaurant_stats(spark), job.item_counts(spark)
    return top_restaurants(stats, key=args.key), top_items(counts, menu)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session("order-dashboard", shuffle_bytes=args.shuffle_bytes)
    menu = scan_table(spark, f"{args.tables}/menu_items", MENU_ITEMS)
    listing = order_listing(
        scan_table(spark, f"{args.tables}/orders", ORDERS),
        scan_table(spark, f"{args.tables}/restaurants", RESTAURANTS),
        scan_table(spark, f"{args.tables}/users", USERS),
        args.sort,
        not args.descending,
        args.size,
    )
    for top in tops(spark, args, menu):
        top.show(truncate=False)
    if args.after is not None:
        page = listing.next_page(args.after)
    elif args.before is not None:
        page = listing.previous_page(args.before)
    else:
        page = listing.page(args.page)
    rows = page.collect()  # as many as are shown
    few_rows(spark, rows, page.schema).show(args.size, truncate=False)
    if args.after is None and args.before is None:
        print(f"page {args.page} of {listing.total_pages()}")
    if rows:
        print(f"--before '{json.dumps(listing.cursor(rows[0]))}' --after '{json.dumps(listing.cursor(rows[-1]))}'")


if __name__ == "__main__":
    main()
