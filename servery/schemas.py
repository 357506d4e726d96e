"""Declared schemas of tables, streams and documents. Nothing is inferred."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


# The tables, messages and documents other programs read and write have these
# column names, in this order.
_id, _text, _number = LongType(), StringType(), DoubleType()

ADDRESS = _struct(address_id=_id, address_info=_text, longitude=_number, latitude=_number)

USERS = _struct(
    user_id=_id,
    fk_address=_id,
    user_fullname=_text,
    date_of_birth=_text,
    gender=_text,
    nationality=_text,
    registration_number=_text,
    email=_text,
    phone_number=_text,
    cell_number=_text,
    picture=_text,
)

RESTAURANTS = _struct(
    restaurant_id=_id, fk_address=_id, restaurant_name=_text, phone_number=_text, website=_text
)

MENU_ITEMS = _struct(
    item_id=_id, fk_restaurant=_id, item_name=_text, item_category=_text, price=_number
)

ORDERS = _struct(
    order_id=_id,
    fk_restaurant=_id,
    fk_user=_id,
    order_datetime=TimestampNTZType(),
    total_cost=_number,
    cust_restaurant_rating=_number,
)

ORDER_ITEM = _struct(order_item_id=_id, fk_menu_item=_id, fk_order=_id, item_quantity=_id)

TABLES = {
    "address": (ADDRESS, "address_id"),
    "users": (USERS, "user_id"),
    "restaurants": (RESTAURANTS, "restaurant_id"),
    "menu_items": (MENU_ITEMS, "item_id"),
    "orders": (ORDERS, "order_id"),
    "order_item": (ORDER_ITEM, "order_item_id"),
}

# Inbound topics.
ORDER_EVENT = _struct(
    order_id=_id,
    fk_restaurant=_id,
    restaurant_name=_text,
    fk_user=_id,
    order_datetime=TimestampNTZType(),
    total_cost=_number,
    cust_restaurant_rating=_number,
)
ORDER_ITEM_EVENT = ORDER_ITEM

# Outbound changelogs.
RESTAURANT_STATS = _struct(restaurant_name=_text, total_revenue=_number, avg_rate=_number)
MENU_ITEM_STATS = _struct(fk_menu_item=_id, item_quantity=_id)
# Published beside them: the top items with their label and price.
LABELLED_ITEM_STATS = _struct(fk_menu_item=_id, item_name=_text, item_quantity=_id, price=_number)

# Documents. Numbers arrive quoted as often as not, so they are read as text and cast later.
USER_PROFILE = _struct(
    name=_struct(first=_text, last=_text),
    dob=_struct(date=_text),
    gender=_text,
    nat=_text,
    login=_struct(username=_text),
    email=_text,
    phone=_text,
    cell=_text,
    picture=_struct(large=_text),
    location=_struct(
        street=_struct(number=_text, name=_text),
        city=_text,
        state=_text,
        postcode=_text,
        country=_text,
    ),
)
USER_DOCUMENT = _struct(results=ArrayType(USER_PROFILE))

_priced = ArrayType(_struct(name=_text, price=_text))
RESTAURANT_DOCUMENT = _struct(
    restaurant_name=_text,
    address=_text,
    longitude=_text,
    latitude=_text,
    phone=_text,
    website=_text,
    foods=_priced,
    drinks=_priced,
    desserts=_priced,
)
NAME_LIST = _struct(restaurant_names=ArrayType(_text))


def fields(schema: StructType, *names: str) -> StructType:
    """The named fields of a schema."""
    return StructType([schema[name] for name in names])


def restaurant_stats_schema(key: str = "restaurant_name") -> StructType:
    """Restaurant statistics grouped by the given order column."""
    return StructType([ORDER_EVENT[key], *RESTAURANT_STATS.fields[1:]])


def conform(df: DataFrame, schema: StructType, missing_ok: Collection[str] | None = None) -> DataFrame:
    """Select the schema's columns in order and type. ``missing_ok`` names those that may be
    absent and are then NULL; None: all of them.

    A value that does not fit its declared type is an error, as it is for a database table.
    """
    present = set(df.columns)
    if missing_ok is not None and (missing := set(schema.names) - present - set(missing_ok)):
        raise ValueError(f"columns are missing: {sorted(missing)}")
    return df.select(
        *[
            (
                F.col(f"`{field.name}`").cast(field.dataType)
                if field.name in present
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for field in schema.fields
        ]
    )


def typecast(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast the columns the schema names, leave the others as they are. For untrusted text:
    a value that does not fit becomes NULL."""
    return df.withColumns(
        {
            field.name: F.col(field.name).try_cast(field.dataType)
            for field in schema.fields
            if field.name in df.columns
        }
    )
