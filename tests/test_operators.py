"""Batch operators on small fixtures, against brute force."""

from __future__ import annotations

import json
import os

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from servery.operators.aggregates import (
    item_counts,
    order_totals,
    restaurant_stats,
    restaurant_stats_from_tables,
    table_counts,
)
from servery.operators.ids import assign_ids, next_id, sorted_run
from servery.operators.joins import enrich_orders, orders_list
from servery.operators.latest import latest_per_key
from servery.operators.paging import listing as sorted_listing
from servery.operators.paging import page_index
from servery.operators.quality import (
    check_documents,
    check_messages,
    check_period,
    quarantined,
    reconcile_order_totals,
    require_rows,
    usable,
)
from servery.operators.topk import top_k
from servery.plans.dashboard import order_listing, top_items
from servery.schemas import MENU_ITEMS, ORDER_EVENT, ORDERS, RESTAURANTS, USERS, conform, typecast
from servery.sinks.tables import append_new, create_tables


@pytest.fixture(scope="module")
def orders(spark):
    when = dt.datetime(2024, 3, 8)
    rows = [
        (0, 1, 7, when, 12.34, 4.5),
        (1, 1, 8, when, 10.0, None),
        (2, 2, 7, when, 0.1, 1.0),
        (3, 3, 9, when, None, 5.0),
        (4, 99, 7, when, 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, ORDERS)


@pytest.fixture(scope="module")
def restaurants(spark):
    rows = [(1, 0, "A", None, None), (2, 0, "A", None, None), (3, 0, "B", None, None)]
    return spark.createDataFrame(rows, RESTAURANTS)


def as_set(df):
    return set(map(tuple, df.collect()))


def test_stats_merge_restaurants_of_one_name(orders, restaurants):
    want = {("A", 22.44, 2.75), ("B", None, 5.0)}
    assert as_set(restaurant_stats_from_tables(orders, restaurants)) == want
    assert as_set(restaurant_stats(enrich_orders(orders, restaurants))) == want


def test_stats_by_id(orders):
    got = as_set(restaurant_stats(orders, "fk_restaurant"))
    assert (1, 22.34, 4.5) in got and (2, 0.1, 1.0) in got


def test_inner_joins_drop_orphans(spark, orders, restaurants):
    users = conform(spark.createDataFrame([(7, "U")], "user_id long, user_fullname string"), USERS)
    got = orders_list(orders, restaurants, users, "order_id")
    assert {row["order_id"] for row in got.collect()} == {0, 2}


def test_order_totals_and_reconciliation(spark):
    menu = conform(spark.createDataFrame([(1, 0.1), (2, 19.99)], "item_id long, price double"), MENU_ITEMS)
    items = spark.createDataFrame(
        [(1, 0, 3), (2, 0, 1), (2, 1, 2)], "fk_menu_item long, fk_order long, item_quantity long"
    )
    assert as_set(order_totals(items, menu)) == {(0, 20.29), (1, 39.98)}
    stated = spark.createDataFrame([(0, 20.29), (1, 39.97), (2, 5.0)], "order_id long, total_cost double")
    assert as_set(reconcile_order_totals(stated, items, menu)) == {
        (0, 20.29, 20.29, True),
        (1, 39.97, 39.98, False),
        (2, 5.0, None, False),
    }


def test_item_counts_and_top_items_with_a_tie_at_the_edge(spark):
    items = spark.createDataFrame([(n, 10 if n < 11 else 12) for n in range(12)], "fk_menu_item long, item_quantity long")
    menu = spark.createDataFrame(
        [(n, 0, f"I{n}", "food", 1.0) for n in range(1, 12)], MENU_ITEMS
    )
    got = top_items(item_counts(items), menu, 10).collect()
    assert [row["item_name"] for row in got] == ["I11\n$1.00"] + [f"I{n}\n$1.00" for n in range(1, 10)]


def test_top_k_of_fewer_rows_puts_nulls_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("c", 2.0)], "k string, v double")
    assert [row["k"] for row in top_k(df, "v", "k").collect()] == ["c", "b", "a"]


def test_table_counts_include_empty_tables(spark, orders):
    got = table_counts({"orders": orders, "none": orders.limit(0)})
    assert as_set(got) == {("orders", 5), ("none", 0)}


def test_latest_per_key_takes_the_last_even_if_smaller(spark):
    rows = [("a", 5.0, 1), ("a", 9.0, 2), ("a", 3.0, 3), ("b", None, 2), ("b", 1.0, 1), (None, 4.0, 1)]
    df = spark.createDataFrame(rows, "k string, v double, seq long")
    assert as_set(latest_per_key(df, ["k"], ["seq"]).select("k", "v")) == {
        ("a", 3.0),
        ("b", None),
        (None, 4.0),
    }


# --- ids and pages -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value of g."""
    rng = random.Random(1)
    rows = [(n, 0 if n % 3 == 0 else rng.randrange(500)) for n in range(5000)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "n long, g long").repartition(7)


def test_ids_are_dense_and_follow_the_order(skewed):
    got = assign_ids(skewed, ["g", "n"], "id", 40).collect()
    want = sorted((row["g"], row["n"]) for row in got)
    assert [(row["g"], row["n"]) for row in sorted(got, key=lambda row: row["id"])] == want
    assert sorted(row["id"] for row in got) == list(range(40, 5040))


@pytest.mark.parametrize("copies", [False, True])
def test_a_sorted_run_divides_hot_values_and_exact_copies(spark, skewed, copies):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = skewed.select("g") if copies else skewed
        run = sorted_run(df, ["g"])
        numbered = run.numbered("id").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    sizes = [b - a for a, b in zip(run.offsets, [*run.offsets[1:], run.total], strict=True)]
    assert run.total == 5000 and len(sizes) == 8 and max(sizes) < 5000 / 4
    assert [row["g"] for row in sorted(numbered, key=lambda row: row["id"])] == sorted(
        row["g"] for row in numbered
    )
    assert {row["id"] for row in numbered} == set(range(5000))


def test_ids_without_an_order_are_dense_and_need_no_shuffle(skewed):
    got = assign_ids(skewed, None, "id").select("n", "id").collect()
    assert sorted(row["id"] for row in got) == list(range(5000))
    assert len({row["n"] for row in got}) == 5000


def test_ids_of_nothing(skewed):
    assert assign_ids(skewed.where("n < 0"), ["n"], "id").collect() == []


def test_next_id_has_no_trouble_with_gaps_or_nothing(spark, skewed):
    one = spark.range(1)
    gaps = spark.createDataFrame([(3,), (7,)], "id long")
    assert one.select(next_id(gaps, "id").alias("x")).first()[0] == 8
    assert one.select(next_id(gaps.where("id < 0"), "id").alias("x")).first()[0] == 0


@pytest.mark.parametrize("size", [10, 97, 5000])
@pytest.mark.parametrize("stored", [False, True])
def test_pages_joined_together_are_the_sorted_table(skewed, size, stored):
    rows = skewed.where("n < 300")
    listing = sorted_listing(rows, "g", "n", size, ascending=False)
    total = listing.total_pages()
    listing = listing.stored() if stored else listing
    pages = [listing.page(number + 1).collect() for number in range(min(total, 8))]
    want = sorted(((row["g"], row["n"]) for row in rows.collect()), key=lambda r: (-r[0], r[1]))
    got = [(row["g"], row["n"]) for page in pages for row in page]
    assert got == want[: len(got)] and len(got) == min(len(want), 8 * size)
    assert listing.page(total + 1).collect() == []
    last = listing.last_page().collect()
    assert [(row["g"], row["n"]) for row in last] == want[(total - 1) * size :]
    if stored:
        listing.close()
        assert not os.path.exists(listing._run.path)


@pytest.mark.parametrize("ascending", [True, False])
@pytest.mark.parametrize("kind", ["double", "string", "timestamp_ntz", "date"])
def test_pages_from_cursor_to_cursor_are_the_sorted_table(spark, ascending, kind):
    values = {
        "double": [1.5, None, float("nan"), -0.5, 1.5, None, float("inf"), 7.25, 1.5, float("nan")],
        "string": ["b", None, "a", "", "b", None, "ä", "b", "zz", "a'b"],
        "timestamp_ntz": [dt.datetime(2024, 1, d, 3, 4, 5, d) if d % 4 else None for d in range(1, 11)],
        "date": [dt.date(2024, 1, 1 + d // 3) if d % 4 else None for d in range(10)],
    }[kind]
    rows = spark.createDataFrame([(v, n) for n, v in enumerate(values)], f"v {kind}, n long")
    pages = sorted_listing(rows, "v", "n", 3, ascending)
    first = F.asc_nulls_last("v") if ascending else F.desc_nulls_last("v")
    want = [row["n"] for row in rows.orderBy(first, "n").collect()]
    walked, cursor, cursors = [], None, []
    while page := pages.next_page(cursor).collect():
        walked.append([row["n"] for row in page])
        cursors.append(pages.cursor(page[0]))
        cursor = json.loads(json.dumps(pages.cursor(page[-1])))
    assert [n for page in walked for n in page] == want
    back = [[row["n"] for row in pages.previous_page(c).collect()] for c in cursors]
    assert back == [[]] + walked[:-1]
    with pytest.raises(ValueError, match="cursor"):
        pages.next_page([1])


def test_the_last_page_writes_nothing(skewed):
    plan = sorted_listing(skewed, "g", "n", 10).last_page()._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan and "servery-run" not in plan


def test_a_listing_of_nothing(skewed):
    listing = sorted_listing(skewed.where("n < 0"), "n", "n", 10)
    assert listing.total_pages() == 0 and listing.stored().last_page().collect() == []
    assert listing.page(1).collect() == [] and listing.last_page().collect() == []


def test_page_numbers_and_sizes_are_checked(skewed):
    with pytest.raises(ValueError):
        sorted_listing(skewed, "n", "n", 0)
    with pytest.raises(ValueError):
        sorted_listing(skewed, "n", "n", 10).page(0)


def test_page_index_rounds_up(spark):
    assert as_set(page_index(spark.range(51))) == {(10, 6), (25, 3), (50, 2), (100, 1)}
    assert as_set(page_index(spark.range(0))) == {(10, 0), (25, 0), (50, 0), (100, 0)}


def test_order_listing_sorts_by_any_column(spark, orders, restaurants):
    users = conform(
        spark.createDataFrame([(7, "U"), (8, "V"), (9, "W")], "user_id long, user_fullname string"), USERS
    )
    for column, want in {"user_fullname": [3, 1, 0, 2], "total_cost": [0, 1, 2, 3]}.items():
        page = order_listing(orders, restaurants, users, column, ascending=False).page(1)
        assert [row["order_id"] for row in page.collect()] == want


# --- checks ------------------------------------------------------------------------------


MESSAGES = {
    '{"order_id":0,"restaurant_name":"A","total_cost":12.34,"cust_restaurant_rating":4.5}': None,
    '{"restaurant_name":"A","extra":1}': None,
    '{"restaurant_name":"A","total_cost":"abc"}': None,
    '{"restaurant_name":"A","order_id":99999999999999999999}': None,
    '{"total_cost":1}': "incomplete",
    "{}": "incomplete",
    "not json": "malformed",
    '{"restaurant_name":"A"': "malformed",
    "[1]": "malformed",
    "  ": "empty",
    None: "empty",
}


@pytest.fixture(scope="module")
def messages(spark):
    return spark.createDataFrame([(text,) for text in MESSAGES], "value string")


def test_messages_are_checked(messages):
    checked = check_messages(messages, ORDER_EVENT, ["restaurant_name"])
    assert {row["value"]: row["reason"] for row in checked.collect()} == MESSAGES
    assert usable(checked).count() + quarantined(checked).count() == len(MESSAGES)


def test_strict_messages_must_parse_in_full(messages):
    checked = check_messages(messages, ORDER_EVENT, ["restaurant_name"], strict=True)
    reasons = {row["value"]: row["reason"] for row in checked.collect()}
    assert reasons['{"restaurant_name":"A","total_cost":"abc"}'] == "malformed"
    assert reasons['{"restaurant_name":"A","extra":1}'] is None


def test_payload_timestamps_with_space_and_t(spark):
    texts = [("2024-03-08 05:12:33",), ("2024-03-08T05:12:33",), ("yesterday",)]
    rows = spark.createDataFrame(texts, "t string").selectExpr(
        """concat('{"restaurant_name":"A","order_datetime":"', t, '"}') AS value"""
    )
    got = check_messages(rows, ORDER_EVENT, ["restaurant_name"]).collect()
    moment = dt.datetime(2024, 3, 8, 5, 12, 33)
    assert [row["order_datetime"] for row in got] == [moment, moment, None]


def test_documents_are_checked(spark):
    rows = spark.createDataFrame(
        [(1, {"a": "x"}), (2, {"a": None}), (3, None)], "id int, document struct<a: string>"
    )
    reasons = {row["id"]: row["reason"] for row in check_documents(rows, ["a"]).collect()}
    assert reasons == {1: None, 2: "incomplete", 3: "malformed"}


def test_preconditions(spark, orders):
    assert require_rows(orders, "orders") is orders
    with pytest.raises(ValueError, match="orders is empty"):
        require_rows(orders.limit(0), "orders")
    check_period(dt.date(2024, 3, 8), dt.date(2024, 3, 9))
    for end in (dt.date(2024, 3, 8), dt.date(2024, 3, 7)):
        with pytest.raises(ValueError):
            check_period(dt.date(2024, 3, 8), end)


def test_typecast_turns_bad_text_into_null(spark):
    row = spark.sql("SELECT '7' AS order_id, 'abc' AS total_cost, 'kept' AS other")
    assert tuple(typecast(row, ORDERS).first()) == (7, None, "kept")


# --- appends -----------------------------------------------------------------------------


def test_append_keeps_the_primary_key(spark, tmp_path):
    paths = create_tables(spark, str(tmp_path))
    assert create_tables(spark, str(tmp_path)) == paths
    menu = paths["menu_items"]
    first = spark.createDataFrame([(1, 0, "a", "food", 1.0)], MENU_ITEMS)
    assert append_new(first, menu, MENU_ITEMS, "item_id").rejected.collect() == []
    rows = [
        (1, 0, "again", "food", 2.0),
        (2, 0, "b", "food", 3.0),
        (2, 0, "c", "food", 3.0),
        (3, 0, "d", "food", 4.0),
        (3, 0, "d", "food", 4.0),
        (3, 0, "d", "food", 4.0),
        (4, 0, "e", None, None),
        (None, 0, "f", "food", 5.0),
        (None, 0, "f", "food", 5.0),
    ]
    result = append_new(spark.createDataFrame(rows, MENU_ITEMS), menu, MENU_ITEMS, "item_id")
    stored = spark.read.schema(MENU_ITEMS).parquet(menu)
    assert as_set(stored.select("item_id", "item_name")) == {(1, "a"), (2, "b"), (3, "d"), (4, "e")}
    rejected = result.rejected.select("item_id", "item_name", "reason", "n")
    assert as_set(rejected) == {
        (1, "again", "already_present", 1),
        (2, "c", "duplicate_key", 1),
        (3, "d", "duplicate_key", 2),
        (None, "f", "null_key", 2),
    }
    assert result.accepted.count() + result.rejected.agg(F.sum("n")).first()[0] == len(rows)
