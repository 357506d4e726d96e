"""Running order statistics as a job: two topics in, two changelogs out.

    spark-submit servery/jobs/order_stats.py --root /shared/stats \\
        --format kafka --servers broker:9092 [--publish kafka]

The topics are Kafka topics or, with ``--format text``, folders of message files. Changelogs go
to parquet folders below the root, with the top ten of each beside them, or, with ``--publish
kafka``, to topics of the same names.
"""

from __future__ import annotations

import argparse

from servery.schemas import MENU_ITEMS
from servery.session import build_session, streaming_session
from servery.sinks.changelog import start_kafka_changelog
from servery.sources.streams import topic_stream
from servery.sources.tables import scan_table
from servery.streaming.running import (
    OrderStatsJob,
    await_all,
    running_item_counts,
    running_restaurant_stats,
    start_quarantines,
)


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Running order statistics")
    parser.add_argument("--root", required=True, help="shared folder of changelogs and checkpoints")
    parser.add_argument("--format", choices=["kafka", "text"], default="kafka")
    parser.add_argument("--publish", choices=["files", "kafka"], default="files")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--orders", default="orders_topic")
    parser.add_argument("--items", default="order_items_topic")
    parser.add_argument("--key", default="restaurant_name", help="or fk_restaurant")
    parser.add_argument("--state-partitions", type=int)
    parser.add_argument("--files-per-batch", type=int, help="of the changelogs")
    parser.add_argument("--snapshot-every", type=int, default=100, help="batches")
    parser.add_argument("--tables", help="folder of the stored tables; with it the top menu items are published")
    parser.add_argument("--max-per-trigger", help="messages (Kafka) or files (text) of a batch")
    parser.add_argument(
        "--quarantine", action=argparse.BooleanOptionalAction, default=True, help="keep unusable messages"
    )
    parser.add_argument("--once", action="store_true", help="end when all present input is read")
    parser.add_argument("--shuffle-bytes", type=int, help="of the largest shuffle")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    session = streaming_session(build_session("order-stats", shuffle_bytes=args.shuffle_bytes), args.state_partitions)
    servers = {"kafka.bootstrap.servers": args.servers} if args.servers else {}
    source = dict(servers) if args.format == "kafka" else {}
    if args.max_per_trigger:
        limit = "maxOffsetsPerTrigger" if args.format == "kafka" else "maxFilesPerTrigger"
        source[limit] = args.max_per_trigger
    orders = topic_stream(session, args.orders, args.format, **source)
    items = topic_stream(session, args.items, args.format, **source)
    trigger = {"availableNow": True} if args.once else {}
    if args.publish == "files":
        job = OrderStatsJob(args.root, args.key, args.files_per_batch, args.snapshot_every)
        menu = (lambda: scan_table(session, f"{args.tables}/menu_items", MENU_ITEMS)) if args.tables else None
        queries = job.start(orders, items, args.quarantine, menu, **trigger)
    else:
        streams = {
            "restaurant_stats": (running_restaurant_stats(orders, args.key), args.key),
            "menu_item_stats": (running_item_counts(items), "fk_menu_item"),
        }
        queries = [
            start_kafka_changelog(
                stats, key, topic, f"{args.root}/checkpoints/{topic}", topic, trigger, **servers
            )
            for topic, (stats, key) in streams.items()
        ]
        if args.quarantine:
            queries += start_quarantines(args.root, orders, items, args.key, **trigger)
    await_all(queries)


if __name__ == "__main__":
    main()
