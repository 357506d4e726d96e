"""Aggregates. Those over one input take batch and streaming DataFrames alike.

All of them combine map-side, so a key that holds a third of the rows sends one row per task
through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from servery.functions.money import amount, money, total


def restaurant_stats(orders: DataFrame, key: str = "restaurant_name") -> DataFrame:
    """Revenue and mean rating per restaurant. Restaurants of one name count as one, unless
    ``key`` names their id."""
    return orders.groupBy(key).agg(
        amount(total(money(F.col("total_cost")))).alias("total_revenue"),
        F.avg("cust_restaurant_rating").alias("avg_rate"),
    )


def restaurant_stats_from_tables(
    orders: DataFrame, restaurants: DataFrame, key: str = "restaurant_name"
) -> DataFrame:
    """As :func:`restaurant_stats` for stored orders that carry only the restaurant id.

    Orders are summed per id before the join, so the join sees one row per restaurant and
    never an order; the totals of equally named restaurants are then added up.
    """
    per_id = orders.groupBy("fk_restaurant").agg(
        total(money(F.col("total_cost"))).alias("revenue"),
        F.sum("cust_restaurant_rating").alias("ratings"),
        F.count("cust_restaurant_rating").alias("rated"),
    )
    named = per_id.join(
        restaurants.select("restaurant_id", key), F.col("fk_restaurant") == F.col("restaurant_id")
    )
    return named.groupBy(key).agg(
        amount(total(F.col("revenue"))).alias("total_revenue"),
        F.try_divide(F.sum("ratings"), F.sum("rated")).alias("avg_rate"),
    )


def item_counts(order_items: DataFrame) -> DataFrame:
    """Quantity ordered per menu item. No quantity can stop a running query: a sum past a long is
    NULL."""
    return order_items.groupBy("fk_menu_item").agg(F.try_sum(F.col("item_quantity").cast("bigint")).alias("item_quantity"))


def order_totals(order_items: DataFrame, menu_items: DataFrame) -> DataFrame:
    """Cost of each order from its items' prices and quantities."""
    priced = order_items.select("fk_order", "fk_menu_item", "item_quantity").join(
        menu_items.select("item_id", money(F.col("price")).alias("price")),
        F.col("fk_menu_item") == F.col("item_id"),
    )
    return priced.groupBy("fk_order").agg(
        amount(total(F.try_multiply(F.col("price"), F.col("item_quantity")))).alias("total_cost")
    )


def order_item_quantities(drawn_items: DataFrame) -> DataFrame:
    """How often each item was drawn within an order."""
    return drawn_items.groupBy("fk_order", "fk_menu_item").agg(F.count(F.lit(1)).alias("n"))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table; an empty one counts 0."""
    counts = [
        table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, table in tables.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("n"))
