"""The jobs end to end on small files: load, publish, count, show."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from test_documents import profile, restaurant

from servery.jobs import dashboard, load_documents, load_orders, order_stats, publish
from servery.schemas import MENU_ITEMS, ORDER_ITEM, ORDERS, RESTAURANTS, USERS
from servery.sinks.tables import append_new, create_tables


def as_set(df):
    return set(map(tuple, df.collect()))


def test_from_documents_to_the_dashboard(spark, tmp_path, capsys):
    landing, tables = tmp_path / "landing", str(tmp_path / "tables")
    for folder in ("users", "restaurants"):
        (landing / folder).mkdir(parents=True)
    for number, first in enumerate(["Ann", "Bea"]):
        text = json.dumps({"results": [profile(first, number)]})
        (landing / "users" / f"{number}.json").write_text(text)
    (landing / "restaurants" / "a").write_text("Here: " + restaurant("Aroma"))
    (landing / "restaurants" / "b").write_text("Sorry, no.")
    load = [
        "--tables", tables, "--rejects", str(tmp_path / "rejects"),
        "--users", str(landing / "users"), "--restaurants", str(landing / "restaurants"),
    ]
    load_documents.main(load)

    def stored(name, schema):
        return spark.read.schema(schema).parquet(f"{tables}/{name}")

    assert as_set(stored("users", USERS).select("user_id")) == {(0,), (1,)}
    assert as_set(stored("restaurants", RESTAURANTS).select("restaurant_id", "fk_address")) == {(0, 2)}
    assert stored("menu_items", MENU_ITEMS).count() == 5
    assert spark.read.parquet(str(tmp_path / "rejects" / "documents")).count() == 1

    # Loaded once more, ids go on where they ended.
    load_documents.main(load[:6])
    assert as_set(stored("users", USERS).select("user_id", "fk_address")) == {(0, 0), (1, 1), (2, 3), (3, 4)}

    day = dt.datetime(2024, 3, 8, 12)
    orders = [
        (0, 0, 0, day, 14.5, 4.0),
        (1, 0, 1, dt.datetime(2024, 3, 9, 23), 12.0, 3.0),
        (2, 0, 1, dt.datetime(2024, 3, 12), 99.0, 5.0),
    ]
    append_new(spark.createDataFrame(orders, ORDERS), f"{tables}/orders", ORDERS, "order_id")
    items = [(0, 0, 0, 1), (1, 2, 0, 1), (2, 0, 1, 1), (3, 0, 2, 9)]
    append_new(spark.createDataFrame(items, ORDER_ITEM), f"{tables}/order_item", ORDER_ITEM, "order_item_id")
    topics = ["--orders", str(tmp_path / "orders"), "--items", str(tmp_path / "items")]
    publish.main(["--tables", tables, "--from", "3/8/2024", "--to", "03/09/2024", "--format", "text", *topics])

    root = str(tmp_path / "stats")
    order_stats.main(["--root", root, "--format", "text", "--once", "--quarantine", "--state-partitions", "2", "--tables", tables, *topics])
    capsys.readouterr()
    with pytest.raises(SystemExit):
        dashboard.main(["--tables", tables])
    with pytest.raises(SystemExit):
        dashboard.main(["--tables", tables, "--changelog", "kafka", "--servers", "s", "--live"])
    capsys.readouterr()
    dashboard.main(["--tables", tables, "--root", root, "--sort", "total_cost", "--descending"])
    shown = capsys.readouterr().out
    assert "|Aroma          |26.5         |3.5     |" in shown
    assert "Soup\\n$12.00" in shown and "|2            |12.0 |" in shown
    assert shown.index("|99.0 ") < shown.index("|14.5 ") < shown.index("|12.0      |")
    assert "page 1 of 1" in shown

    # What the job published is the same, and a page can be gone on from.
    cursors = shown.splitlines()[-1]
    dashboard.main(["--tables", tables, "--root", root, "--live", "--sort", "total_cost", "--descending", "--after", cursors.split("'")[3]])
    live = capsys.readouterr().out
    assert live.split("+--")[:2] == shown.split("+--")[:2] and "Soup\\n$12.00" in live and "|99.0 " not in live


def test_placed_orders_are_loaded_with_ids_that_go_on(spark, tmp_path):
    tables, rejects = str(tmp_path / "tables"), str(tmp_path / "rejects")
    paths = create_tables(spark, tables)
    menu = [(0, 7, "Tea", "beverage", 2.5), (1, 7, "Pie", "food", 4.25)]
    spark.createDataFrame(menu, MENU_ITEMS).write.mode("append").parquet(paths["menu_items"])
    for turn in (0, 1):
        landing = tmp_path / f"landing-{turn}"
        for name in ("placed", "drawn"):
            (landing / name).mkdir(parents=True)
        placed = [
            {"draft": d, "fk_restaurant": 7, "fk_user": 3, "order_datetime": "2024-03-08 05:12:33", "cust_restaurant_rating": 4.5}
            for d in (20, 10)
        ]
        lines = [*map(json.dumps, placed), "broken", '{"draft":30}']
        (landing / "placed" / "a.json").write_text("\n".join(lines))
        drawn = [(10, 0), (10, 1), (10, 0), (20, 1), (99, 1)]
        text = [json.dumps({"draft": d, "fk_menu_item": i}) for d, i in drawn] + ['{"draft":10}']
        (landing / "drawn" / "a.json").write_text("\n".join(text))
        load_orders.main(
            ["--tables", tables, "--rejects", rejects, "--placed", str(landing / "placed"), "--drawn", str(landing / "drawn")]
        )
    orders = spark.read.schema(ORDERS).parquet(paths["orders"])
    assert as_set(orders.select("order_id", "total_cost")) == {(0, 9.25), (1, 4.25), (2, 9.25), (3, 4.25)}
    items = spark.read.schema(ORDER_ITEM).parquet(paths["order_item"])
    first = {(0, 0, 0, 2), (1, 1, 0, 1), (2, 1, 1, 1)}
    assert as_set(items) == first | {(n + 3, item, order + 2, q) for n, item, order, q in first}
    bad = spark.read.parquet(f"{rejects}/placed").groupBy("reason").count()
    assert as_set(bad) == {("malformed", 2), ("incomplete", 2)}
    assert spark.read.parquet(f"{rejects}/drawn").count() == 2


def test_periods_that_follow_each_other_publish_every_order_once(spark, tmp_path):
    tables = str(tmp_path / "tables")
    paths = create_tables(spark, tables)
    moments = [dt.datetime(2024, 3, 7), dt.datetime(2024, 3, 8, 23, 59), dt.datetime(2024, 3, 9), dt.datetime(2024, 3, 11)]
    rows = [(i, 0, 0, at, 1.0, 1.0) for i, at in enumerate(moments)]
    spark.createDataFrame(rows, ORDERS).write.mode("append").parquet(paths["orders"])
    spark.createDataFrame([(0, 0, "A", None, None)], RESTAURANTS).write.mode("append").parquet(paths["restaurants"])
    topics = ["--format", "text", "--orders", str(tmp_path / "orders"), "--items", str(tmp_path / "items")]
    for start, end in (("3/7/2024", "3/8/2024"), ("3/9/2024", "3/10/2024")):
        publish.main(["--tables", tables, "--from", start, "--to", end, *topics])
    sent = [json.loads(r.value)["order_id"] for r in spark.read.text(str(tmp_path / "orders")).collect()]
    assert sorted(sent) == [0, 1, 2]


def test_a_period_of_one_day_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="after its start"):
        publish.main(["--tables", str(tmp_path), "--from", "3/8/2024", "--to", "3/8/2024"])
    with pytest.raises(ValueError, match="month/day/year"):
        publish.main(["--tables", str(tmp_path), "--from", "2024-03-08", "--to", "3/8/2024"])
