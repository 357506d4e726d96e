"""Loads placed orders and the items drawn for them into the stored tables.

    spark-submit servery/jobs/load_orders.py --tables /shared/tables --rejects /shared/rejects \\
        --placed /landing/placed --drawn /landing/drawn

Both are folders of JSON lines: ``draft`` (the sender's number of the order), ``fk_restaurant``,
``fk_user``, ``order_datetime`` and ``cust_restaurant_rating`` of each order, and ``draft`` and
``fk_menu_item`` of each item drawn. An order costs what its items do on the stored menu; ids go on
from the stored ones. Lines that cannot be used are kept with a reason.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from servery.jobs.load_documents import Loader
from servery.operators.orders import load_orders
from servery.operators.quality import Split, check_messages, split
from servery.schemas import ORDER_ITEM, ORDERS, fields
from servery.session import build_session

_DRAFT = StructField("draft", LongType(), True)
_ORDER = fields(ORDERS, "fk_restaurant", "fk_user", "order_datetime", "cust_restaurant_rating")
PLACED = StructType([_DRAFT, *_ORDER.fields])
DRAWN = StructType([_DRAFT, *fields(ORDER_ITEM, "fk_menu_item").fields])


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Load placed orders")
    parser.add_argument("--tables", required=True, help="folder of the stored tables")
    parser.add_argument("--rejects", required=True, help="folder for what is not loaded")
    parser.add_argument("--placed", required=True, help="folder of placed orders, JSON lines")
    parser.add_argument("--drawn", required=True, help="folder of drawn items, JSON lines")
    parser.add_argument("--shuffle-bytes", type=int, help="of the largest shuffle")
    return parser.parse_args(argv)


class OrderLoader(Loader):
    def _lines(self, folder: str, schema: StructType, required: list[str]) -> Split:
        return split(check_messages(self.spark.read.text(folder), schema, required))

    def _keep(self, kind: str, bad: DataFrame) -> None:
        bad.select("value", "reason").write.mode("append").parquet(f"{self.rejects}/{kind}")

    def orders(self, placed_folder: str, drawn_folder: str) -> None:
        placed = self._lines(placed_folder, PLACED, ["draft", "fk_restaurant", "fk_user", "order_datetime"])
        drawn = self._lines(drawn_folder, DRAWN, ["draft", "fk_menu_item"])
        tables = load_orders(
            drawn.usable.select(DRAWN.names),
            placed.usable.select(PLACED.names),
            self.stored("menu_items"),
            self.first_free("orders"),
            self.first_free("order_item"),
        )
        self._keep("placed", placed.quarantined)
        self._keep("drawn", drawn.quarantined)
        self.append("orders", tables.orders)
        self.append("order_item", tables.order_items)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = build_session("load-orders", shuffle_bytes=args.shuffle_bytes)
    OrderLoader(spark, args.tables, args.rejects).orders(args.placed, args.drawn)


if __name__ == "__main__":
    main()
