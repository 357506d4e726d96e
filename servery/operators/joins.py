"""Lookups of orders in their dimensions.

No side is forced to broadcast: Spark does so for sides it measures below its threshold, and
else shuffles both sides and splits the hot keys of the order side. Each lookup passes only
the columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servery.functions.money import item_label


def enrich_orders(orders: DataFrame, restaurants: DataFrame) -> DataFrame:
    """Orders with their ``restaurant_name``."""
    names = restaurants.select("restaurant_id", "restaurant_name")
    joined = orders.join(names, F.col("fk_restaurant") == F.col("restaurant_id"))
    return joined.select(*orders.columns, "restaurant_name")


def orders_list(orders: DataFrame, restaurants: DataFrame, users: DataFrame, *keep: str) -> DataFrame:
    """The listing of orders with user and restaurant names; ``keep`` adds order columns."""
    joined = enrich_orders(orders, restaurants).join(
        users.select("user_id", "user_fullname"), F.col("fk_user") == F.col("user_id")
    )
    return joined.select(
        "user_fullname",
        "order_datetime",
        "restaurant_name",
        "total_cost",
        "cust_restaurant_rating",
        *keep,
    )


def labelled_item_counts(item_stats: DataFrame, menu_items: DataFrame, *keep: str) -> DataFrame:
    """Item quantities with the item's label and price."""
    menu = menu_items.select("item_id", "item_name", "price")
    joined = item_stats.join(menu, F.col("fk_menu_item") == F.col("item_id"))
    return joined.select(
        item_label(F.col("item_name"), F.col("price")).alias("item_name"),
        "item_quantity",
        "price",
        *keep,
    )


def restaurant_menus(menu_items: DataFrame) -> DataFrame:
    """Size and lowest price of each restaurant's menu."""
    return menu_items.groupBy("fk_restaurant").agg(
        F.count(F.lit(1)).alias("n_items"), F.min("price").alias("min_price")
    )


def order_menus(orders: DataFrame, menu_items: DataFrame) -> DataFrame:
    """What each order could choose from: its restaurant's menu, looked up once per restaurant.

    Menus are summed up before the join, so an order never meets every item of its menu. The
    rebalance hint detaches the summary from its grouping; joined straight from there, the
    join would inherit that partitioning and hot restaurants could not be split.
    """
    menus = restaurant_menus(menu_items).hint("rebalance")
    return orders.select("order_id", "fk_restaurant").join(menus, "fk_restaurant").select(
        "order_id", "n_items", "min_price"
    )
