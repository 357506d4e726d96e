"""Properties over generated inputs; each example is one batch of rows."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from servery.functions.money import amount, money, total
from servery.functions.prices import normalized_price
from servery.functions.text import outermost_json
from servery.operators.ids import assign_ids
from servery.operators.latest import latest_per_key
from servery.operators.quality import check_messages, quarantined, usable
from servery.schemas import ADDRESS, MENU_ITEM_STATS, conform
from servery.session import shuffle_partitions

few = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
number = st.decimals(0, 10_000, places=2).map(str)


def evaluate(spark, values, expression):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string").coalesce(1)
    return [row[0] for row in rows.orderBy("i").select(expression).collect()]


@few
@given(st.lists(st.tuples(number, number, st.sampled_from(["", "$"]), st.sampled_from(["", " "])), min_size=1))
def test_ranges_are_averaged_and_single_prices_kept(spark, rows):
    texts = [f"{sign}{low}{gap}-{gap}{high}{sign}" for low, high, sign, gap in rows]
    means = [(float(low) + float(high)) / 2 for low, high, _, _ in rows]
    assert evaluate(spark, texts, normalized_price(F.col("x"))) == means
    singles = [f"{gap}{low}{sign}" for low, _, sign, gap in rows]
    assert evaluate(spark, singles, normalized_price(F.col("x"))) == [float(r[0]) for r in rows]


@few
@given(st.lists(st.text(alphabet='{}a \n"', max_size=12), min_size=20))
def test_outermost_json_spans_first_to_last_brace(spark, texts):
    want = []
    for text in texts:
        found = re.search(r"\{.*\}", text, re.DOTALL)
        want.append(found.group() if found else None)
    assert evaluate(spark, texts, outermost_json(F.col("x"))) == want


@few
@given(st.lists(st.integers(-(10**11), 10**11), min_size=1))
def test_sums_of_cents_are_exact(spark, values):
    rows = spark.createDataFrame([(value / 100,) for value in values], "x double")
    assert rows.agg(amount(total(money(F.col("x"))))).first()[0] == sum(values) / 100


@few
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), min_size=1))
def test_latest_gives_one_row_per_key(spark, rows):
    rows = [(key, value, place) for place, (key, value) in enumerate(rows)]
    want = {key: value for key, value, _ in rows}
    df = spark.createDataFrame(rows, "k long, v long, seq long").repartition(3)
    for sequence in (["seq"], ["seq", "v"]):
        got = latest_per_key(df, ["k"], sequence).collect()
        assert len(got) == len(want) and {row["k"]: row["v"] for row in got} == want


@few
@given(st.lists(st.integers(-50, 50), unique=True))
def test_ids_are_dense_unique_and_ordered(spark, keys):
    df = spark.createDataFrame([(key,) for key in keys], "k long").repartition(4)
    got = sorted((row["id"], row["k"]) for row in assign_ids(df, [F.desc("k")], "id", 7).collect())
    assert got == list(enumerate(sorted(keys, reverse=True), 7))


@few
@given(st.lists(st.sampled_from(['{"fk_menu_item":1}', "{}", "x", "", '{"fk_menu_item":"a"}', None]), min_size=1))
def test_usable_and_quarantined_messages_make_up_the_input(spark, texts):
    rows = spark.createDataFrame([(text,) for text in texts], "value string")
    checked = check_messages(rows, MENU_ITEM_STATS, ["fk_menu_item"])
    good, bad = usable(checked).collect(), quarantined(checked).collect()
    assert Counter(row["value"] for row in good + bad) == Counter(texts)
    assert {row["value"] for row in good} <= {'{"fk_menu_item":1}'}


def test_a_value_of_the_wrong_type_is_no_table_row(spark):
    with pytest.raises(NumberFormatException):
        conform(spark.sql("SELECT 'x' AS address_id"), ADDRESS).collect()


def test_shuffle_partitions_grow_with_the_shuffle():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(10 << 40) == 40_960
