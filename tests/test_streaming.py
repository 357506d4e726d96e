"""Running statistics: replayed files against the batch results."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from servery.operators.aggregates import item_counts, restaurant_stats
from servery.operators.joins import labelled_item_counts
from servery.operators.latest import compact_changelog
from servery.operators.topk import top_k
from servery.plans.dashboard import top_items, top_restaurants
from servery.plans import queries
from servery.plans.inputs import Inputs
from servery.plans.queries import QUERIES
from servery import versions
from servery.schemas import LABELLED_ITEM_STATS, MENU_ITEM_STATS, MENU_ITEMS, ORDER_EVENT, RESTAURANT_STATS
from servery.session import streaming_session
from servery.sinks.changelog import start_file_changelog, write_changelog_batch
from servery.sources.changelog import FILE_SEQUENCE, read_current, read_file_changelog, read_view
from servery.sources.streams import decode_messages, topic_stream
from servery.streaming.running import (
    OrderStatsJob,
    await_all,
    labelled_by,
    live_top_k,
    running_item_counts,
    running_restaurant_stats,
)

from servery.versions import current_version


def order(number, name, cost, rating=4.0):
    return {
        "order_id": number,
        "fk_restaurant": 1,
        "fk_user": 1,
        "order_datetime": "2024-03-08 05:12:33",
        "total_cost": cost,
        "cust_restaurant_rating": rating,
        "restaurant_name": name,
    }


class Topic:
    """A folder of message files, each of which becomes one micro-batch."""

    def __init__(self, folder):
        self.folder, self.files = folder, 0
        folder.mkdir()

    def send(self, *messages):
        lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
        path = self.folder / f"{self.files:04d}.txt"
        path.write_text("\n".join(lines) + "\n")
        # The file source takes files by modification time.
        import os

        os.utime(path, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def stream(self, session):
        return topic_stream(session, str(self.folder), fmt="text", maxFilesPerTrigger="1")


@pytest.fixture(scope="module")
def session(spark):
    return streaming_session(spark, state_partitions=4)


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path / "topic")


def run(session, topic, tmp_path, after_batch=None):
    query = start_file_changelog(
        running_restaurant_stats(topic.stream(session)),
        str(tmp_path / "changelog"),
        str(tmp_path / "checkpoint"),
        after_batch=[after_batch] if after_batch else [],
        availableNow=True,
    )
    await_all([query])
    return read_file_changelog(session, str(tmp_path / "changelog"), RESTAURANT_STATS)


def as_set(df):
    return set(map(tuple, df.collect()))


def test_a_streaming_session_keeps_settings_made_at_run_time(spark):
    spark.conf.set("fs.example.token", "t")
    session = streaming_session(spark, state_partitions=3)
    assert session.conf.get("fs.example.token") == "t"
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_each_batch_publishes_only_the_keys_it_changed(session, topic, tmp_path):
    topic.send(order(0, "A", 12.34), order(1, "B", 1.0, 2.0))
    topic.send(order(2, "A", 10.0, 1.0))
    topic.send(order(3, "C", 5.5, None))
    changelog = run(session, topic, tmp_path)
    assert as_set(changelog.select("batch_id", "restaurant_name", "total_revenue", "avg_rate")) == {
        (0, "A", 12.34, 4.0),
        (0, "B", 1.0, 2.0),
        (1, "A", 22.34, 2.5),
        (2, "C", 5.5, None),
    }
    current = compact_changelog(changelog, "restaurant_name", FILE_SEQUENCE)
    assert as_set(current) == {("A", 22.34, 2.5), ("B", 1.0, 2.0), ("C", 5.5, None)}


def test_a_restart_continues_from_the_checkpoint(session, topic, tmp_path):
    topic.send(order(0, "A", 1.0), order(1, "B", 2.0))
    run(session, topic, tmp_path)
    topic.send(order(2, "A", 3.0))
    changelog = run(session, topic, tmp_path)
    assert as_set(changelog.where("batch_id > 0").select("restaurant_name", "total_revenue")) == {("A", 4.0)}
    current = compact_changelog(changelog, "restaurant_name", FILE_SEQUENCE)
    orders = decode_messages(session.read.text(str(topic.folder)), ORDER_EVENT)
    assert as_set(current) == as_set(restaurant_stats(orders))


@pytest.mark.parametrize("after_writing", [False, True])
def test_a_batch_that_failed_is_counted_once(session, topic, tmp_path, after_writing):
    """The query dies in its second batch, before or after that was published, and goes on."""
    for number in range(3):
        topic.send(order(number, "A", 1.0), order(10 + number, f"B{number}", 2.0))
    log, checkpoint = str(tmp_path / "changelog"), str(tmp_path / "checkpoint")
    write = write_changelog_batch(log)

    def die(batch, batch_id):
        if batch_id == 1 and not after_writing:
            raise RuntimeError("lost")
        write(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("lost")

    stats = running_restaurant_stats(topic.stream(session))
    writer = stats.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    with pytest.raises(StreamingQueryException, match="lost"):
        await_all([writer.foreachBatch(die).trigger(availableNow=True).start()])
    changelog = run(session, topic, tmp_path)
    assert as_set(changelog.select("batch_id", "restaurant_name", "total_revenue")) == {
        (0, "A", 1.0),
        (0, "B0", 2.0),
        (1, "A", 2.0),
        (1, "B1", 2.0),
        (2, "A", 3.0),
        (2, "B2", 2.0),
    }


def test_a_batch_run_again_replaces_itself(session, tmp_path):
    write = write_changelog_batch(str(tmp_path / "log"))
    rows = [[("A", 1.0, 1.0)], [("A", 2.0, 1.0)], [("A", 2.0, 1.0), ("B", 1.0, 1.0)]]
    frames = [session.createDataFrame(batch, RESTAURANT_STATS) for batch in rows]
    write(frames[0], 0)
    write(frames[1], 1)
    write(frames[2], 1)
    log = read_file_changelog(session, str(tmp_path / "log"), RESTAURANT_STATS)
    assert as_set(log.select("restaurant_name", "total_revenue", "batch_id")) == {
        ("A", 1.0, 0),
        ("A", 2.0, 1),
        ("B", 1.0, 1),
    }


def test_unusable_messages_are_kept_apart(session, topic, tmp_path):
    items = Topic(tmp_path / "items")
    topic.send(order(0, "A", 1.0), "not json", "{}", '{"restaurant_name":"A","total_cost":1e300}')
    topic.send('{"restaurant_name":"A","total_cost":"7.5","cust_restaurant_rating":2}')
    topic.send('{"restaurant_name":"A","cust_restaurant_rating":NaN}')
    items.send('{"fk_menu_item":11,"item_quantity":2}', '{"item_quantity":2}')
    items.send(*['{"fk_menu_item":11,"item_quantity":2000000000}'] * 2)
    job = OrderStatsJob(str(tmp_path / "job"))
    queries = job.start(
        topic.stream(session), items.stream(session), availableNow=True
    )
    assert len(queries) == 4
    await_all(queries)
    assert as_set(job.restaurant_stats(session)) == {("A", 1.0, 3.0)}
    assert as_set(job.item_counts(session)) == {(11, 4000000002)}
    bad = session.read.parquet(f"{job.root}/quarantine").groupBy("topic", "reason").count()
    assert as_set(bad) == {
        ("orders", "malformed", 1),
        ("orders", "incomplete", 1),
        ("orders", "amount_not_finite", 1),
        ("order_items", "incomplete", 1),
    }


def test_large_amounts_count_in_streams_as_in_batches(session, topic, tmp_path):
    rows = [("A", 5.0, 1.0), ("A", 2e17, 1.0), ("A", 2e12, 1.0), ("B", 7.0, 1e7)]
    for name, cost, rating in rows:
        topic.send({"restaurant_name": name, "total_cost": cost, "cust_restaurant_rating": rating})
    stats = running_restaurant_stats(topic.stream(session))
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    await_all([start_file_changelog(stats, path, checkpoint, availableNow=True)])
    running = as_set(read_current(session, path, RESTAURANT_STATS, "restaurant_name"))
    orders = session.createDataFrame(rows, "restaurant_name string, total_cost double, cust_restaurant_rating double")
    assert running == as_set(restaurant_stats(orders)) == {("A", 2.00002000000000005e17, 1.0), ("B", 7.0, 1e7)}


def test_item_statistics_join_the_menu_while_streaming(session, tmp_path):
    items = Topic(tmp_path / "items")
    items.send({"fk_menu_item": 1, "item_quantity": 2}, {"fk_menu_item": 9, "item_quantity": 1})
    items.send({"fk_menu_item": 1, "item_quantity": 3})
    menu = session.createDataFrame([(1, 0, "Tea", "beverage", 2.5)], MENU_ITEMS)
    labelled = labelled_item_counts(running_item_counts(items.stream(session)), menu)
    query = start_file_changelog(labelled, str(tmp_path / "log"), str(tmp_path / "c"), availableNow=True)
    await_all([query])
    log = session.read.parquet(str(tmp_path / "log")).select("batch_id", "item_name", "item_quantity")
    assert as_set(log) == {(0, "Tea\n$2.50", 2), (1, "Tea\n$2.50", 5)}


def test_a_failure_of_one_query_stops_the_other(session, topic, tmp_path):
    topic.send(order(0, "A", 1.0))

    def fail(batch, batch_id):
        raise RuntimeError("sink is gone")

    good = start_file_changelog(
        running_restaurant_stats(topic.stream(session)), str(tmp_path / "good"), str(tmp_path / "c1")
    )
    bad = start_file_changelog(
        running_item_counts(topic.stream(session)),
        str(tmp_path / "bad"),
        str(tmp_path / "c2"),
        after_batch=[fail],
    )
    with pytest.raises(StreamingQueryException, match="sink is gone"):
        await_all([good, bad])
    assert not good.isActive


def test_stream_equals_batch_on_many_batches(session, tmp_path):
    items = Topic(tmp_path / "items")
    rng = random.Random(3)
    for _ in range(5):
        # A third of all messages is about item 0.
        keys = [rng.choice([0, rng.randrange(40)]) for _ in range(60)]
        items.send(*[{"fk_menu_item": key, "item_quantity": rng.randrange(1, 9)} for key in keys])
    query = start_file_changelog(
        running_item_counts(items.stream(session)),
        str(tmp_path / "log"),
        str(tmp_path / "checkpoint"),
        availableNow=True,
    )
    await_all([query])
    log = read_file_changelog(session, str(tmp_path / "log"), MENU_ITEM_STATS)
    assert log.select("batch_id").distinct().count() == 5
    batch = session.read.json(str(items.folder), schema="fk_menu_item long, item_quantity long")
    assert as_set(compact_changelog(log, "fk_menu_item", FILE_SEQUENCE)) == as_set(item_counts(batch))


def test_live_top_k_follows_the_changelog(session, topic, tmp_path):
    """Totals that rise, fall, leave the top and come back, checked after every batch."""
    rng = random.Random(5)
    names = [f"R{n}" for n in range(9)]
    top, changelog = str(tmp_path / "top"), str(tmp_path / "changelog")
    refresh = live_top_k(top, "restaurant_name", "total_revenue", changelog, k=3)
    checked = []

    def after(batch, batch_id):
        refresh(batch, batch_id)
        log = read_file_changelog(session, changelog, RESTAURANT_STATS)
        stats = compact_changelog(log, "restaurant_name", FILE_SEQUENCE)
        want = top_k(stats, "total_revenue", "restaurant_name", 3)
        got = read_view(session, top, RESTAURANT_STATS)
        checked.append(as_set(got) == as_set(want))

    for number in range(7):
        topic.send(*[order(number, name, float(rng.randrange(-20, 25))) for name in rng.sample(names, 3)])
    run(session, topic, tmp_path, after)
    assert checked == [True] * 7


def test_dashboards_read_the_changelogs(spark, session, topic, tmp_path):
    none = read_current(spark, str(tmp_path / "none"), RESTAURANT_STATS, "restaurant_name")
    assert top_restaurants(none).collect() == []
    topic.send(*[order(n, f"R{n:02d}", float(n)) for n in range(12)])
    topic.send(order(12, "R00", 50.0))
    run(session, topic, tmp_path)
    stats = read_current(spark, str(tmp_path / "changelog"), RESTAURANT_STATS, "restaurant_name")
    got = [row["restaurant_name"] for row in top_restaurants(stats).collect()]
    assert got == ["R00"] + [f"R{n:02d}" for n in range(11, 2, -1)]
    counts = spark.createDataFrame([(1, 7), (2, 6), (3, 9)], MENU_ITEM_STATS)
    menu = spark.createDataFrame([(1, 0, "Tea", "beverage", 2.5), (2, 0, "Pie", "dessert", 4.0)], MENU_ITEMS)
    shown = top_items(counts, menu).collect()
    assert [tuple(row) for row in shown] == [("Tea\n$2.50", 7, 2.5), ("Pie\n$4.00", 6, 4.0)]


def test_snapshots_stand_for_the_history_before_them(session, topic, tmp_path):
    items = Topic(tmp_path / "items")
    for number in range(5):
        topic.send(order(number, "A", 1.0), order(10 + number, f"B{number}", 2.0))
    items.send({"fk_menu_item": 1, "item_quantity": 2})
    job = OrderStatsJob(str(tmp_path / "job"), key="fk_restaurant", files=1, snapshot_every=2)
    await_all(job.start(topic.stream(session), items.stream(session), availableNow=True))
    assert as_set(job.restaurant_stats(session)) == {(1, 15.0, 4.0)}

    job = OrderStatsJob(str(tmp_path / "named"), snapshot_every=2)
    await_all(job.start(topic.stream(session), items.stream(session), availableNow=True))
    want = {("A", 5.0, 4.0)} | {(f"B{n}", 2.0, 4.0) for n in range(5)}
    assert as_set(job.restaurant_stats(session)) == want
    _, state = current_version(session, job.changelog("restaurant_stats"))
    assert state["snapshot"] == 3 and list(state["live"]) == ["4"]
    # Only the batch after the last snapshot is still read from the changelog.
    log = read_file_changelog(session, job.changelog("restaurant_stats"), RESTAURANT_STATS)
    assert {f.split("/batch_id=")[1][0] for f in log.inputFiles() if "/batch_id=" in f} == {"4"}
    assert log.groupBy("batch_id").count().where("batch_id = 4").first()["count"] == 2


def folders(path):
    return sorted(str(p) for p in path.rglob("*") if p.is_dir())


def test_a_changelog_stays_bounded_and_a_batch_run_again_is_right(session, tmp_path):
    log = tmp_path / "log"
    write = write_changelog_batch(str(log), files=1, key="fk_menu_item", every=6, buckets=4)
    totals, listed, held = {}, [], []

    def publish(batch_id, rows):
        write(session.createDataFrame(rows, MENU_ITEM_STATS), batch_id)

    for batch_id in range(40):
        rows = [(k, batch_id * 10 + k) for k in {batch_id % 7, 100 + batch_id}]
        totals.update(rows)
        publish(batch_id, rows)
        if batch_id % 9 == 0:  # as after a failure: first an attempt with less, now the same again
            publish(batch_id, rows)
        changelog = read_file_changelog(session, str(log), MENU_ITEM_STATS)
        listed.append(len({f.rsplit("/", 1)[0] for f in changelog.inputFiles()}))
        held.append(len(folders(log)))
        if batch_id % 5 == 4:
            assert as_set(read_current(session, str(log), MENU_ITEM_STATS, "fk_menu_item")) == set(totals.items())
    assert max(listed[20:]) <= 6 + 4 and max(held[30:]) <= max(held[10:30])
    # A batch that is in the snapshot already leaves it as it is.
    number, state = current_version(session, str(log))
    publish(state["snapshot"], [(5, -1)])
    assert current_version(session, str(log)) == (number, state)


def test_a_reader_keeps_what_it_began_to_read(session, tmp_path):
    write = write_changelog_batch(str(tmp_path / "log"), files=1, key="fk_menu_item", every=2)
    frame = lambda n: session.createDataFrame([(n, 1)], MENU_ITEM_STATS)
    write(frame(0), 0)
    before = read_file_changelog(session, str(tmp_path / "log"), MENU_ITEM_STATS)
    for n in range(1, 4):
        write(frame(n), n)
    assert as_set(before) == {(0, 1, 0)}


def test_a_snapshot_writes_only_parts_with_changed_keys(session, tmp_path):
    log = str(tmp_path / "log")
    write = write_changelog_batch(log, files=1, key="fk_menu_item", every=1, buckets=16)
    write(session.createDataFrame([(k, 1) for k in range(2000)], MENU_ITEM_STATS), 0)
    _, first = current_version(session, log)
    write(session.createDataFrame([(7, 5), (8, 5)], MENU_ITEM_STATS), 1)
    _, second = current_version(session, log)
    changed = [b for b in first["parts"] if first["parts"][b] != second["parts"][b]]
    assert len(first["parts"]) == 16 and 1 <= len(changed) <= 2
    current = dict(map(tuple, read_current(session, log, MENU_ITEM_STATS, "fk_menu_item").collect()))
    assert len(current) == 2000 and current[7] == current[8] == 5 and current[9] == 1
    # Read with other buckets in mind, the folder keeps its own.
    write_changelog_batch(log, files=1, key="fk_menu_item", every=1, buckets=3)(session.createDataFrame([(9, 9)], MENU_ITEM_STATS), 2)
    assert dict(map(tuple, read_current(session, log, MENU_ITEM_STATS, "fk_menu_item").collect())) == current | {9: 9}


def test_two_writers_of_a_folder_are_noticed(session, tmp_path, monkeypatch):
    folder = str(tmp_path / "f")
    assert current_version(session, folder) == (-1, {})
    assert versions.publish_version(session, folder, {"a": 1}, []) == 0
    stale = (-1, {})
    monkeypatch.setattr(versions, "current_version", lambda *_: stale)
    with pytest.raises(OSError, match="two writers"):
        versions.publish_version(session, folder, {"a": 2}, [])


def test_live_top_items_follow_the_counts_and_the_menu(session, tmp_path):
    """Items leave the menu, and the published items are those of the moment."""
    items = Topic(tmp_path / "items")
    rng = random.Random(11)
    for _ in range(8):
        items.send(*[{"fk_menu_item": rng.randrange(12), "item_quantity": rng.randrange(-15, 20)} for _ in range(6)])
    view, changelog, turn, checked = str(tmp_path / "top"), str(tmp_path / "log"), [0], []

    def menu():
        rows = [(i, 0, f"I{i}", "food", 1.0 + i) for i in range(12) if i % 4 >= turn[0] // 3]
        return session.createDataFrame(rows, MENU_ITEMS)

    shown = labelled_by(menu)
    refresh = live_top_k(view, "fk_menu_item", "item_quantity", changelog, k=3, shown=shown)

    def after(batch, batch_id):
        refresh(batch, batch_id)
        stats = read_current(session, changelog, MENU_ITEM_STATS, "fk_menu_item")
        want = top_k(shown(stats), "item_quantity", "fk_menu_item", 3)
        checked.append(as_set(read_view(session, view, LABELLED_ITEM_STATS)) == as_set(want))
        turn[0] += 1

    stats = running_item_counts(items.stream(session))
    await_all([start_file_changelog(stats, changelog, str(tmp_path / "c"), after_batch=[after], availableNow=True)])
    assert checked == [True] * 8


def test_a_live_top_shows_the_best_of_a_batch_alone(session, tmp_path):
    """The menu meets a few rows of a batch of many, unless most of the best are not on it."""
    items, view, changelog = Topic(tmp_path / "items"), str(tmp_path / "top"), str(tmp_path / "log")
    for turn in range(3):
        items.send(*[{"fk_menu_item": i, "item_quantity": i + turn} for i in range(2000)])
    listed, asked, checked = 2000, [], []

    def shown(stats):
        asked.append(stats.count())
        menu = session.range(listed).select(F.col("id").alias("item_id"), F.lit("I").alias("item_name"), F.lit(1.0).alias("price"))
        return labelled_item_counts(stats, menu, "fk_menu_item").select(LABELLED_ITEM_STATS.names)

    refresh = live_top_k(view, "fk_menu_item", "item_quantity", changelog, k=3, shown=shown)

    def after(batch, batch_id):
        refresh(batch, batch_id)
        checked.append([row["fk_menu_item"] for row in read_view(session, view, LABELLED_ITEM_STATS).collect()])

    stats = running_item_counts(items.stream(session))
    await_all([start_file_changelog(stats, changelog, str(tmp_path / "c"), after_batch=[after], availableNow=True)])
    assert checked == [[1999, 1998, 1997]] * 3
    assert max(asked) <= 30
    # Thousands rank higher but are not on the menu.
    listed, asked[:] = 500, []
    for turn in range(2):
        items.send(*[{"fk_menu_item": i, "item_quantity": 1} for i in range(2000)])
    stats = running_item_counts(items.stream(session))
    await_all([start_file_changelog(stats, changelog, str(tmp_path / "c"), after_batch=[after], availableNow=True)])
    assert checked[3:] == [[499, 498, 497]] * 2


def test_a_menu_without_the_best_items_is_not_broadcast(session, tmp_path):
    """Whether there is a top already, none yet, or one that is not full."""
    view, changelog, plans = str(tmp_path / "top"), str(tmp_path / "log"), []
    menu = session.range(300).select(F.col("id").alias("item_id"), F.lit("I").alias("item_name"), F.lit(1.0).alias("price"))

    def shown(stats):
        joined = labelled_by(lambda: menu)(stats)
        plans.append(joined._jdf.queryExecution().executedPlan().toString())
        return joined

    refresh = live_top_k(view, "fk_menu_item", "item_quantity", changelog, k=3, shown=shown)
    write = write_changelog_batch(changelog, key="fk_menu_item")
    for batch_id in range(3):
        batch = session.createDataFrame([(i, i + batch_id) for i in range(2000)] + [(None, 9999)], MENU_ITEM_STATS)
        plans.clear()
        write(batch, batch_id)
        refresh(batch, batch_id)
        assert [tuple(row) for row in read_view(session, view, LABELLED_ITEM_STATS).select("fk_menu_item", "item_quantity").collect()] == [
            (i, i + batch_id) for i in (299, 298, 297)
        ]
        # The few best alone may be sent to the menu, and then all meet it.
        assert "Broadcast" not in plans[-1] and "SortMergeJoin" in plans[-1]


def test_the_job_publishes_both_tops(session, topic, tmp_path):
    items = Topic(tmp_path / "items")
    for n in range(3):
        topic.send(*[order(10 * n + i, f"R{i:02d}", float(i)) for i in range(12)])
        items.send(*[{"fk_menu_item": i, "item_quantity": i + n} for i in range(15)])
    job = OrderStatsJob(str(tmp_path / "job"), snapshot_every=2)
    assert job.top_items(session).collect() == [] == job.top_restaurants(session).collect()
    menu = session.createDataFrame([(i, 0, f"I{i}", "food", 1.0) for i in range(14)], MENU_ITEMS)
    await_all(job.start(topic.stream(session), items.stream(session), menu=lambda: menu, availableNow=True))
    assert [r[0] for r in job.top_restaurants(session).collect()] == [f"R{i:02d}" for i in range(11, 1, -1)]
    # The fifteenth item sells best but is not on the menu.
    assert [tuple(r)[:3] for r in job.top_items(session).collect()] == [(i, f"I{i}\n$1.00", 3 * i + 3) for i in range(13, 3, -1)]
    assert as_set(job.top_restaurants(session)) == as_set(top_restaurants(job.restaurant_stats(session)))


def test_rejects_are_counted_in_the_same_read_and_once(session, topic, tmp_path):
    items = Topic(tmp_path / "items")
    topic.send(order(0, "A", 1.0), "not json", "{}", " ")
    items.send('{"fk_menu_item":1,"item_quantity":1}', "[")
    job, other = OrderStatsJob(str(tmp_path / "job")), OrderStatsJob(str(tmp_path / "other"))

    def run_job(some):
        queries = some.start(topic.stream(session), items.stream(session), quarantine=False, availableNow=True)
        assert len(queries) == 2
        await_all(queries)
        return as_set(some.rejects(session, after=queries))

    assert job.rejects(session).collect() == []
    first = {("orders", "malformed", 1), ("orders", "incomplete", 1), ("orders", "empty", 1), ("order_items", "malformed", 1)}
    assert run_job(job) == first
    # Started again with nothing new, and beside another job over the same topics: nothing is counted twice.
    assert run_job(job) == first == run_job(other)
    topic.send('{"restaurant_name":"A","total_cost":1e300}', "no")
    assert run_job(job) == first - {("orders", "malformed", 1)} | {("orders", "malformed", 2), ("orders", "amount_not_finite", 1)}
    assert as_set(job.restaurant_stats(session)) == {("A", 1.0, 4.0)}


def test_batches_grow_with_the_keys_and_their_number_with_the_messages_to_a_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "_FILE_MESSAGES", 100)
    source = "/root/testdata/sf0.001"
    (tmp_path / "supplier.parquet").symlink_to(f"{source}/supplier.parquet")
    part = spark.range(1000).selectExpr(
        "id AS p_partkey", "'P' AS p_name", "'B' AS p_brand", "'T' AS p_type", "1 AS p_size", "1D AS p_retailprice"
    )
    part.write.parquet(str(tmp_path / "part.parquet"))
    items = spark.range(5000).selectExpr("id AS l_orderkey", "id % 1000 AS l_partkey", "2D AS l_quantity")
    items.write.parquet(str(tmp_path / "lineitem.parquet"))
    root = queries._replayed_items(Inputs(spark, str(tmp_path)))
    assert sorted(current_version(spark, f"{root}/changelog")[1]["live"]) == ["0", "1", "2", "3", "4"]
    counts = read_current(spark, f"{root}/changelog", MENU_ITEM_STATS, "fk_menu_item")
    assert as_set(counts) == {(i, 10) for i in range(1000)}


def test_the_quarantine_query_checks_the_items_of_every_order(spark, tmp_path):
    source = "/root/testdata/sf0.001"
    for name in ("orders", "supplier"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{source}/{name}.parquet")
    items = spark.read.parquet(f"{source}/lineitem.parquet")
    broken = items.where("l_linenumber = 1").withColumn("l_partkey", F.lit(None).cast("long"))
    broken.write.parquet(str(tmp_path / "lineitem.parquet"))
    rows = QUERIES["stream_quarantine"](spark, str(tmp_path)).where("topic = 'order_items'").collect()
    # The query itself cuts the messages of every eleventh order short.
    cut = broken.where("l_orderkey % 11 = 1").count()
    assert {r.reason: r.n for r in rows} == {"incomplete": broken.count() - cut, "malformed": cut}
