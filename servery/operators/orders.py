"""Orders from the items that were drawn for them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servery.operators.aggregates import order_item_quantities, order_totals
from servery.operators.ids import assign_ids
from servery.schemas import ORDER_ITEM, ORDERS, conform


@dataclass(frozen=True)
class OrderTables:
    orders: DataFrame
    order_items: DataFrame


def load_orders(
    drawn: DataFrame,
    placed: DataFrame,
    menu_items: DataFrame,
    order_start: int | Column = 0,
    item_start: int | Column = 0,
) -> OrderTables:
    """Rows of the two order tables, with ids that go on from the given ones.

    ``placed`` has one row for each order: ``draft``, and what is known of it (fk_restaurant,
    fk_user, order_datetime, cust_restaurant_rating). ``drawn`` has a row, ``draft`` and
    ``fk_menu_item``, each time an item was drawn: an item drawn twice is one order item of
    quantity two. An order costs what its items do; orders without items have no cost. Ids
    follow ``draft``, and the item within it.
    """
    numbered = assign_ids(placed, ["draft"], "order_id", order_start)
    ids = numbered.select("draft", F.col("order_id").alias("fk_order"))
    counted = order_item_quantities(drawn.withColumnRenamed("draft", "fk_order"))
    counted = counted.withColumnsRenamed({"fk_order": "draft", "n": "item_quantity"})
    items = assign_ids(counted.join(ids, "draft"), ["fk_order", "fk_menu_item"], "order_item_id", item_start)
    totals = order_totals(items, menu_items).withColumnRenamed("fk_order", "order_id")
    orders = numbered.drop("total_cost").join(totals, "order_id", "left")
    return OrderTables(conform(orders, ORDERS, missing_ok=()), conform(items, ORDER_ITEM, missing_ok=()))
