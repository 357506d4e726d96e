"""Nested and free-text documents to relational tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from servery.functions.payload import with_parsed
from servery.functions.prices import normalized_price, number
from servery.functions.text import document_json, numbered_name, parse_document, text_lines
from servery.operators.ids import assign_ids
from servery.schemas import (
    ADDRESS,
    MENU_ITEMS,
    RESTAURANT_DOCUMENT,
    RESTAURANTS,
    USER_DOCUMENT,
    USER_PROFILE,
    USERS,
    conform,
)

# Menu arrays of a restaurant document and the category each stands for, in menu
# order.
MENU_CATEGORIES = {"foods": "food", "drinks": "beverage", "desserts": "dessert"}


def list_names(texts: DataFrame, *keep: str) -> DataFrame:
    """Names of numbered lists in column ``text``; lines without a number are dropped."""
    lines = texts.select(*keep, F.explode(text_lines(F.col("text"))).alias("line"))
    return lines.select(*keep, numbered_name(F.col("line")).alias("name")).where("name is not null")


def distinct_names(names: DataFrame, column: str) -> DataFrame:
    return names.select(column).distinct()


# --- user profiles -----------------------------------------------------------------------


def parse_users(texts: DataFrame, text: str = "text") -> DataFrame:
    """A row for each profile of each text, in column ``document``; a text that holds none, or
    is no user document, keeps one row with NULL there."""
    parsed = with_parsed(texts, F.from_json(F.col(text), USER_DOCUMENT), "_parsed")
    return parsed.select(*texts.columns, F.explode_outer("_parsed.results").alias("document"))


def flatten_users(profiles: DataFrame) -> DataFrame:
    """Profiles to the users columns plus ``address_info``; other columns are kept."""
    kept = [name for name in profiles.columns if name not in USER_PROFILE.names]
    street = F.concat_ws(" ", "location.street.number", "location.street.name")
    place = F.concat_ws(
        ", ", street, "location.city", "location.state", "location.postcode", "location.country"
    )
    return profiles.select(
        *kept,
        F.concat_ws(" ", "name.first", "name.last").alias("user_fullname"),
        F.col("dob.date").alias("date_of_birth"),
        F.col("gender"),
        F.col("nat").alias("nationality"),
        F.col("login.username").alias("registration_number"),
        F.col("email"),
        F.col("phone").alias("phone_number"),
        F.col("cell").alias("cell_number"),
        F.col("picture.large").alias("picture"),
        place.alias("address_info"),
    )


@dataclass(frozen=True)
class UserTables:
    users: DataFrame
    address: DataFrame


def load_users(
    profiles: DataFrame,
    user_start: int | Column = 0,
    address_start: int | Column = 0,
    order: Sequence[str] | None = None,
) -> UserTables:
    """Users and their addresses, numbered together: one address per user. ``order`` names the
    columns that set the order of the ids; without, profiles are numbered as they lie."""
    numbered = assign_ids(flatten_users(profiles), order, "_place")
    first_user, first_address = _column(user_start), _column(address_start)
    rows = numbered.withColumns(
        {
            "user_id": first_user + F.col("_place"),
            "fk_address": first_address + F.col("_place"),
        }
    )
    return UserTables(
        users=conform(rows, USERS),
        address=conform(rows.withColumnRenamed("fk_address", "address_id"), ADDRESS),
    )


# --- restaurant documents ----------------------------------------------------------------


def parse_restaurants(texts: DataFrame, text: str = "text") -> DataFrame:
    """Adds column ``document``: the restaurant object in the text, NULL if there is none."""
    parsed = parse_document(document_json(F.col(text)), RESTAURANT_DOCUMENT)
    return with_parsed(texts, parsed, "document")


def menu_rows(documents: DataFrame, *keep: str) -> DataFrame:
    """One row per menu entry of the parsed documents, in one pass over all three arrays.

    ``menu_place`` is the entry's place in its document: foods, drinks, desserts.
    """
    entries = [_tagged(array, category) for array, category in MENU_CATEGORIES.items()]
    return documents.select(
        *keep, F.posexplode(F.concat(*entries)).alias("menu_place", "entry")
    ).select(
        *keep,
        "menu_place",
        F.col("entry.name").alias("item_name"),
        F.col("entry.category").alias("item_category"),
        normalized_price(F.col("entry.price")).alias("price"),
        F.col("entry.price").alias("price_text"),
    )


def _tagged(array: str, category: str) -> Column:
    def tag(entry: Column) -> Column:
        return F.struct(
            entry["name"].alias("name"), entry["price"].alias("price"), F.lit(category).alias("category")
        )

    return F.coalesce(F.transform(F.col(f"document.{array}"), tag), F.array())


@dataclass(frozen=True)
class RestaurantTables:
    restaurants: DataFrame
    address: DataFrame
    menu_items: DataFrame


def load_restaurants(
    documents: DataFrame,
    key: str | None = None,
    restaurant_start: int | Column = 0,
    address_start: int | Column = 0,
    item_start: int | Column = 0,
) -> RestaurantTables:
    """Restaurants, addresses and menu items of parsed, valid documents.

    The documents are stored once, numbered, and all three tables read that copy, each only the
    fields it needs. ``key`` names a column that identifies a document and sets the order of the
    ids. Without it documents are numbered as they lie, without a shuffle.
    """
    kept, order = (["document"], None) if key is None else ([key, "document"], [key])
    numbered = assign_ids(documents.select(*kept), order, "_place")
    first_restaurant, first_address = _column(restaurant_start), _column(address_start)
    rows = numbered.withColumns(
        {
            "restaurant_id": first_restaurant + F.col("_place"),
            "fk_address": first_address + F.col("_place"),
        }
    )
    restaurants = rows.select(
        "restaurant_id",
        "fk_address",
        F.col("document.restaurant_name").alias("restaurant_name"),
        F.col("document.phone").alias("phone_number"),
        F.col("document.website").alias("website"),
    )
    address = rows.select(
        F.col("fk_address").alias("address_id"),
        F.col("document.address").alias("address_info"),
        number(F.col("document.longitude")).alias("longitude"),
        number(F.col("document.latitude")).alias("latitude"),
    )
    items = menu_rows(rows, "restaurant_id").withColumnRenamed("restaurant_id", "fk_restaurant")
    items = assign_ids(items, ["fk_restaurant", "menu_place"], "item_id", item_start)
    return RestaurantTables(
        restaurants=conform(restaurants, RESTAURANTS),
        address=conform(address, ADDRESS),
        menu_items=conform(items, MENU_ITEMS),
    )


def _column(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
