"""Documents, lists and messages through files."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from servery.operators.documents import (
    distinct_names,
    list_names,
    load_restaurants,
    load_users,
    menu_rows,
    parse_restaurants,
    parse_users,
)
from servery.operators.quality import check_documents, quarantined, unreadable_prices, usable
from servery.operators.variants import left_behind
from servery.schemas import (
    ADDRESS,
    MENU_ITEMS,
    NAME_LIST,
    RESTAURANT_DOCUMENT,
    RESTAURANTS,
    USER_DOCUMENT,
    USERS,
    conform,
)
from servery.sinks.messages import keyed_messages, publish_to_files, write_names
from servery.sources.documents import (
    read_document_lines,
    read_list_texts,
    read_name_list,
    read_names,
    read_text_documents,
)
from servery.sources.streams import decode_messages
from servery.sources.tables import as_json_rows, query_tables, scan_table


def as_set(df):
    return set(map(tuple, df.collect()))


def profile(first, number):
    return {
        "name": {"title": "Ms", "first": first, "last": "Doe"},
        "dob": {"date": "1990-01-02T03:04:05Z", "age": 34},
        "gender": "female",
        "nat": "US",
        "login": {"username": f"user{number}"},
        "email": f"{first}@example.com",
        "phone": "1",
        "cell": "2",
        "picture": {"large": "http://example.com/p.jpg"},
        "location": {
            "street": {"number": number, "name": "Elm St"},
            "city": "Troy",
            "state": "Ohio",
            "postcode": 12345,
            "country": "United States",
        },
    }


def test_no_user_document_is_lost(spark, tmp_path):
    whole = json.dumps({"results": [profile("Ann", 0), profile("Bea", 1)]})
    (tmp_path / "many").write_text("\n".join([whole, whole[:40], json.dumps({"results": [{}]}), "[]", "{}"]))
    (tmp_path / "one").write_text(json.dumps({"results": [profile("Cid", 2)]}, indent=1))
    checked = check_documents(parse_users(read_text_documents(spark, str(tmp_path / "one"))), ["name"])
    assert as_set(checked.select("document.name.first", "reason")) == {("Cid", None)}
    checked = check_documents(parse_users(read_document_lines(spark, str(tmp_path / "many"))), ["name", "login.username"])
    got = sorted(map(tuple, checked.select("document.name.first", "reason").collect()), key=str)
    assert got == sorted([("Ann", None), ("Bea", None), *[(None, "malformed")] * 3, (None, "incomplete")], key=str)


def test_users_and_addresses_share_one_numbering(spark, tmp_path):
    for number, first in enumerate(["Ann", "Bea", "Cid"]):
        (tmp_path / f"{number}.json").write_text(json.dumps({"results": [profile(first, number)], "info": {}}))
    checked = check_documents(parse_users(read_document_lines(spark, str(tmp_path))), ["name"])
    profiles = usable(checked).select("document.*")
    tables = load_users(profiles, user_start=5, address_start=20, order=["registration_number"])
    assert (tables.users.schema.names, tables.address.schema.names) == (USERS.names, ADDRESS.names)
    got = tables.users.select("user_id", "fk_address", "user_fullname", "date_of_birth", "nationality")
    born = "1990-01-02T03:04:05Z"
    assert as_set(got) == {
        (5, 20, "Ann Doe", born, "US"),
        (6, 21, "Bea Doe", born, "US"),
        (7, 22, "Cid Doe", born, "US"),
    }
    address = "1 Elm St, Troy, Ohio, 12345, United States"
    assert (21, address, None, None) in as_set(tables.address)
    as_they_lie = load_users(profiles)
    assert as_set(as_they_lie.users.select("user_id")) == {(0,), (1,), (2,)}
    assert as_set(as_they_lie.users.select("user_id", "fk_address")) == {(n, n) for n in range(3)}


def restaurant(name, **changes):
    document = {
        "restaurant_name": name,
        "address": f"1 {name} Road",
        "longitude": -118.25,
        "latitude": "34.05",
        "phone": "555",
        "website": "example.com",
        "foods": [{"name": "Soup", "price": "$12"}, {"name": "Bread", "price": "FREE"}],
        "drinks": [{"name": "Tea", "price": 2.5}],
        "desserts": [{"name": "Pie", "price": "12$-20$"}, {"name": "Ice", "price": "ask"}],
        **changes,
    }
    return json.dumps(document)


@pytest.fixture
def checked(spark, tmp_path):
    texts = {
        "a": "Sure!\n```json\n" + restaurant("A") + "\n```\nEnjoy your meal.",
        "b": restaurant("B", desserts=[], latitude="north"),
        "c": "I am sorry.",
        "d": restaurant("D") + restaurant("E"),
        "e": json.dumps({"restaurant_name": "E"}),
        "f": restaurant("F")[:-30],
        "g": restaurant("G", foods=None),
        "h": restaurant("H", foods="none today"),
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    parsed = parse_restaurants(read_text_documents(spark, str(tmp_path)))
    return check_documents(parsed, ["restaurant_name", "address", "foods", "drinks", "desserts"])


def test_unusable_documents_are_kept_apart(checked):
    name = F.element_at(F.split("document_id", "/"), -1)
    assert as_set(quarantined(checked).select(name, "reason")) == {
        ("c", "malformed"),
        ("d", "malformed"),
        ("e", "incomplete"),
        ("f", "malformed"),
        ("g", "incomplete"),
        ("h", "incomplete"),
    }
    assert as_set(usable(checked).select(name)) == {("a",), ("b",)}


@pytest.mark.parametrize("key", ["document_id", None])
def test_restaurants_addresses_and_menus(checked, key):
    tables = load_restaurants(usable(checked), key, restaurant_start=3, address_start=50, item_start=100)
    for table, schema in (
        (tables.restaurants, RESTAURANTS),
        (tables.address, ADDRESS),
        (tables.menu_items, MENU_ITEMS),
    ):
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in schema]
    menu = tables.menu_items.orderBy("item_id").collect()
    assert [row["item_id"] for row in menu] == list(range(100, 108))
    assert {row["fk_restaurant"] for row in menu} == {3, 4}
    if key is None:
        return
    assert as_set(tables.restaurants) == {
        (3, 50, "A", "555", "example.com"),
        (4, 51, "B", "555", "example.com"),
    }
    assert as_set(tables.address) == {
        (50, "1 A Road", -118.25, 34.05),
        (51, "1 B Road", -118.25, None),
    }
    assert [tuple(row)[2:] for row in menu[:5]] == [
        ("Soup", "food", 12.0),
        ("Bread", "food", 0.0),
        ("Tea", "beverage", 2.5),
        ("Pie", "dessert", 16.0),
        ("Ice", "dessert", None),
    ]


def test_unreadable_prices_are_found(checked):
    bad = unreadable_prices(menu_rows(usable(checked), "document_id"))
    assert as_set(bad.select("item_name", "menu_place", "price_text")) == {("Ice", 4, "ask")}


def test_lists_of_names(spark, tmp_path):
    (tmp_path / "1").write_text("1. The Spice Haven\n2. Dr. Food\nThat is all.\n")
    (tmp_path / "2").write_text("1. The Spice Haven\n")
    lines = read_list_texts(spark, str(tmp_path / "1"), str(tmp_path / "2"))
    names = list_names(lines)
    assert sorted(row["name"] for row in names.collect()) == ["Dr. Food", "The Spice Haven", "The Spice Haven"]
    distinct = distinct_names(names.withColumnRenamed("name", "restaurant_name"), "restaurant_name")
    assert distinct.count() == 2
    write_names(distinct, str(tmp_path / "names"))
    assert as_set(spark.read.schema("restaurant_name string").json(str(tmp_path / "names"))) == as_set(distinct)


def test_name_list_file(spark, tmp_path):
    path = tmp_path / "names.json"
    path.write_text(json.dumps({"restaurant_names": ["A", "B", "A"]}, indent=1))
    assert NAME_LIST.names == ["restaurant_names"]
    assert [row[0] for row in read_name_list(spark, str(path)).collect()] == ["A", "B", "A"]


def test_messages_through_files(spark, tmp_path):
    rows = spark.sql("SELECT id, concat('it\\'s \"', id, '\"\n') AS name, CAST(NULL AS INT) AS gap FROM range(20)")
    messages = keyed_messages(rows.repartition(4), "id")
    assert messages.where("key = '3'").first()["value"] == '{"id":3,"name":"it\'s \\"3\\"\\n"}'
    publish_to_files(messages, str(tmp_path / "topic"))
    assert len(list((tmp_path / "topic").glob("part-*"))) == 4
    back = decode_messages(spark.read.text(str(tmp_path / "topic")), rows.schema)
    assert as_set(back) == as_set(rows)


def test_tables_as_json_and_as_sql(spark, tmp_path):
    spark.createDataFrame([(1, "A"), (2, None)], "id long, name string").write.parquet(str(tmp_path / "t"))
    table = scan_table(spark, str(tmp_path / "t"), where="id > 0")
    assert as_set(as_json_rows(table)) == {('{"id":1,"name":"A"}',), ('{"id":2}',)}
    assert query_tables(spark, "SELECT max(id) FROM {t}", t=table).first()[0] == 2


def test_conform_adds_and_orders_columns(spark):
    got = conform(spark.sql("SELECT 'x' AS address_info, '7' AS address_id, 1 AS other"), ADDRESS)
    assert [tuple(row) for row in got.collect()] == [(7, "x", None, None)]


def test_what_a_schema_leaves_behind_is_told(spark):
    texts = {
        1: '{"results":[{"name":{"first":"A","title":"Dr"},"gender":["x"],"nat":null,"extra":1},{"login":"me"}],"info":{"a":[1,2]}}',
        2: '{"results":{"name":1}}',
        3: "not json",
        4: None,
        5: '[1]',
        6: '{"results":[{"name":{"first":7,"last":true}},null,3]}',
        7: "{}",
    }
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()], "id long, text string")
    assert as_set(left_behind(docs, USER_DOCUMENT)) == {
        (1, "results.name.title", "unknown", '"Dr"'),
        (1, "results.gender", "mistyped", '["x"]'),
        (1, "results.extra", "unknown", "1"),
        (1, "results.login", "mistyped", '"me"'),
        (1, "info", "unknown", '{"a":[1,2]}'),
        (2, "results", "mistyped", '{"name":1}'),
        (5, "", "mistyped", "[1]"),
        (6, "results", "mistyped", "3"),
    }
    menu = '{"foods":[{"name":"Tea","price":{"amount":1}},{"name":"Pie","size":"L"}],"drinks":"none"}'
    docs = spark.createDataFrame([(menu,)], "text string")
    assert as_set(left_behind(docs, RESTAURANT_DOCUMENT)) == {
        ("foods.price", "mistyped", '{"amount":1}'),
        ("foods.size", "unknown", '"L"'),
        ("drinks", "mistyped", '"none"'),
    }
