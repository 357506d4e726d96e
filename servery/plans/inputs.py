"""The star-schema tables seen as order-data tables.

Columns the source lacks are derived from its keys, in a way SQL can follow, or are NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from servery.sources.tables import scan_table
from servery.schemas import ADDRESS, MENU_ITEMS, ORDERS, RESTAURANTS, USERS, conform


# Columns of the source tables that are read here, in the types they are stored in.
SOURCE = {
    "nation": "n_nationkey int, n_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double",
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return scan_table(self.spark, f"{self.folder}/{name}.parquet", SOURCE[name])

    def _restaurant_count(self) -> Column:
        return self.table("supplier").agg(F.count(F.lit(1)).alias("n")).scalar()

    def address(self) -> DataFrame:
        nation = self.table("nation").withColumnsRenamed(
            {"n_nationkey": "address_id", "n_name": "address_info"}
        )
        return conform(nation, ADDRESS)

    def restaurants(self) -> DataFrame:
        supplier = self.table("supplier").withColumnsRenamed(
            {"s_suppkey": "restaurant_id", "s_nationkey": "fk_address", "s_name": "restaurant_name"}
        )
        return conform(supplier, RESTAURANTS)

    def users(self) -> DataFrame:
        customer = self.table("customer").withColumnsRenamed(
            {"c_custkey": "user_id", "c_nationkey": "fk_address", "c_name": "user_fullname"}
        )
        return conform(customer, USERS)

    def menu_owner(self) -> Column:
        """The restaurant of a row of the menu items' source."""
        return F.col("p_partkey") % self._restaurant_count()

    def menu_items(self, part: DataFrame | None = None) -> DataFrame:
        """All menu items, or those of some rows of their source."""
        key = F.col("p_partkey")
        category = F.when(key % 3 == 0, "food").when(key % 3 == 1, "beverage").otherwise("dessert")
        part = (self.table("part") if part is None else part).select(
            key.alias("item_id"),
            self.menu_owner().alias("fk_restaurant"),
            F.col("p_name").alias("item_name"),
            category.alias("item_category"),
            F.col("p_retailprice").alias("price"),
        )
        return conform(part, MENU_ITEMS)

    def orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        orders = self.table("orders").select(
            key.alias("order_id"),
            (key % self._restaurant_count()).alias("fk_restaurant"),
            F.col("o_custkey").alias("fk_user"),
            F.col("o_orderdate").alias("order_datetime"),
            F.col("o_totalprice").alias("total_cost"),
            (1 + (key % 9) * F.lit(0.5)).alias("cust_restaurant_rating"),
        )
        return conform(orders, ORDERS)

    def order_items(self) -> DataFrame:
        """Without an item id: the source has no unique key for its lines."""
        return self.table("lineitem").select(
            F.col("l_partkey").alias("fk_menu_item"),
            F.col("l_orderkey").alias("fk_order"),
            F.col("l_quantity").cast("bigint").alias("item_quantity"),
        )

    def events(self) -> DataFrame:
        return self.table("events")
