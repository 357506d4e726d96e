"""What a dashboard shows, each as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame

from servery.operators.joins import labelled_item_counts, orders_list
from servery.operators.paging import Listing, listing
from servery.operators.topk import top_k


def top_restaurants(stats: DataFrame, k: int = 10, key: str = "restaurant_name") -> DataFrame:
    return top_k(stats, "total_revenue", key, k)


def top_items(item_stats: DataFrame, menu_items: DataFrame, k: int = 10) -> DataFrame:
    """Joined before it is cut: an item missing from the menu must not take a place."""
    labelled = labelled_item_counts(item_stats, menu_items, "fk_menu_item")
    return top_k(labelled, "item_quantity", "fk_menu_item", k).drop("fk_menu_item")


def order_listing(
    orders: DataFrame,
    restaurants: DataFrame,
    users: DataFrame,
    sort_by: str = "order_id",
    ascending: bool = True,
    size: int = 10,
) -> Listing:
    """The orders list, sorted by any of its columns and cut into pages. Rows also carry
    ``order_id``, which settles ties."""
    rows = orders_list(orders, restaurants, users, "order_id")
    return listing(rows, sort_by, "order_id", size, ascending)
