"""Running statistics that go on with another number of state partitions."""

from __future__ import annotations

import json

import pytest
from test_streaming import Topic, as_set, order, run

from servery.schemas import MENU_ITEM_STATS, RESTAURANT_STATS
from servery.session import streaming_session
from servery.sinks.changelog import start_file_changelog
from servery.sources.changelog import read_current
from servery.streaming import rescale
from servery.streaming.running import await_all, running_item_counts


@pytest.fixture(scope="module")
def session(spark):
    return streaming_session(spark, state_partitions=2)


def resumed(spark, topic, tmp_path, carried, turn, partitions):
    wider = streaming_session(spark, state_partitions=partitions)
    messages = rescale.remaining_files(wider, str(topic.folder), carried)
    stats = rescale.resumed_restaurant_stats(messages, carried)
    checkpoint = str(tmp_path / f"checkpoint-{turn}")
    path = str(tmp_path / "changelog")
    await_all([rescale.start_resumed(stats, carried, path, checkpoint, "restaurant_name", availableNow=True)])
    state = wider.read.format("state-metadata").load(checkpoint).first()
    assert state["numPartitions"] == partitions
    return checkpoint


def test_totals_and_means_go_on_through_two_changes(spark, session, tmp_path):
    topic = Topic(tmp_path / "topic")
    topic.send(order(0, "A", 1.25, 2.0), order(1, "B", 2.0, None), order(2, "gone", 0.01))
    topic.send(order(3, "A", 1e17, 5.0))
    run(session, topic, tmp_path)
    carried = rescale.carry_revenue(session, str(tmp_path / "checkpoint"), str(tmp_path / "changelog"), str(tmp_path / "carried-1"))
    assert (carried.batch_id, carried.next_batch) == (1, 2)
    topic.send(order(4, "A", 0.5, 3.0), order(5, "B", 1.0, 4.0), order(6, "new", 7.0), "broken")
    again = resumed(spark, topic, tmp_path, carried, 1, 5)
    want = {("A", 1e17 + 1.75, 10 / 3), ("B", 3.0, 4.0), ("gone", 0.01, 4.0), ("new", 7.0, 4.0)}
    assert as_set(read_current(session, str(tmp_path / "changelog"), RESTAURANT_STATS, "restaurant_name")) == want

    # The new query's state can be carried as well.
    carried = rescale.carry_revenue(spark, again, str(tmp_path / "changelog"), str(tmp_path / "carried-2"))
    assert (carried.batch_id, carried.next_batch) == (0, 3) and carried == rescale.read_carried(spark, str(tmp_path / "carried-2"))
    topic.send(order(7, "B", 1.0, 1.0))
    # Its own log names the files the first query had as well, so all of them are left out.
    resumed(spark, topic, tmp_path, carried, 2, 3)
    want = {("A", 1e17 + 1.75, 10 / 3), ("B", 4.0, 2.5), ("gone", 0.01, 4.0), ("new", 7.0, 4.0)}
    assert as_set(read_current(session, str(tmp_path / "changelog"), RESTAURANT_STATS, "restaurant_name")) == want


def test_counts_go_on(spark, session, tmp_path):
    topic = Topic(tmp_path / "items")
    topic.send({"fk_menu_item": 1, "item_quantity": 2}, {"fk_menu_item": 2, "item_quantity": 3})
    path, first = str(tmp_path / "log"), str(tmp_path / "c1")
    await_all([start_file_changelog(running_item_counts(topic.stream(session)), path, first, key="fk_menu_item", availableNow=True)])
    carried = rescale.carry_counts(session, first, path, str(tmp_path / "carried"))
    topic.send({"fk_menu_item": 1, "item_quantity": 5}, {"fk_menu_item": 3, "item_quantity": 1})
    wider = streaming_session(spark, state_partitions=6)
    stats = rescale.resumed_item_counts(rescale.remaining_files(wider, str(topic.folder), carried), carried)
    await_all([rescale.start_resumed(stats, carried, path, str(tmp_path / "c2"), "fk_menu_item", availableNow=True)])
    assert as_set(read_current(session, path, MENU_ITEM_STATS, "fk_menu_item")) == {(1, 7), (2, 3), (3, 1)}


def test_a_broker_topic_is_taken_up_where_it_was_left(spark, tmp_path):
    (tmp_path / "commits").mkdir()
    (tmp_path / "offsets").mkdir()
    with pytest.raises(ValueError, match="no batch"):
        rescale.last_batch(spark, str(tmp_path))
    for n in (0, 9, 10):
        (tmp_path / f"commits/{n}").write_text("v1\n{}")
    (tmp_path / "offsets/10").write_text('v1\n{"batchWatermarkMs":0}\n{"orders_topic":{"0":15,"1":7}}')
    (tmp_path / "offsets/11").write_text('v1\n{"batchWatermarkMs":0}\n{"orders_topic":{"0":99,"1":99}}')
    carried = rescale.Carried("", str(tmp_path), rescale.last_batch(spark, str(tmp_path)), 11)
    assert json.loads(rescale.starting_offsets(spark, carried)) == {"orders_topic": {"0": 15, "1": 7}}
