"""Named queries over a folder of star-schema tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from servery.functions.dates import parse_day, plus_seconds
from servery.functions.prices import normalized_price
from servery.functions.text import document_json
from servery.operators import aggregates, documents, joins, quality
from servery.operators.calendar import day_series
from servery.operators.ids import assign_ids, next_id
from servery.operators.orders import load_orders
from servery.operators.latest import latest_per_key
from servery.operators.paging import Listing, listing, page_index
from servery.operators.variants import left_behind
from servery.plans import dashboard
from servery.plans.inputs import Inputs
from servery.schemas import (
    LABELLED_ITEM_STATS,
    MENU_ITEM_STATS,
    ORDER_EVENT,
    ORDERS,
    RESTAURANT_STATS,
    RESTAURANTS,
    TABLES,
    USER_DOCUMENT,
    typecast,
)
from servery.session import streaming_session
from servery.staging import scratch_path
from servery.sinks.changelog import start_file_changelog
from servery.sinks.messages import keyed_messages, publish_to_files, write_names
from servery.sinks.tables import append_new, create_tables
from servery.sources.changelog import read_current, read_view
from servery.sources.documents import read_document_lines, read_list_texts, read_names
from servery.sources.streams import decode_messages, topic_stream
from servery.sources.tables import as_json_rows, query_tables, scan_table
from servery.streaming import rescale
from servery.streaming.running import (
    ITEM_TOPIC,
    OrderStatsJob,
    await_all,
    labelled_by,
    live_top_k,
    running_item_counts,
    running_restaurant_stats,
)
from servery.versions import current_version

Plan = Callable[[Inputs], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(plan: Plan) -> Plan:
    """Register a plan under its function's name; a leading ``q_`` only keeps the name free."""
    name = plan.__name__.removeprefix("q_")
    QUERIES[name] = lambda spark, folder: plan(Inputs(spark, folder))
    return plan


# --- statistics --------------------------------------------------------------------------


@query
def restaurant_revenue(inputs: Inputs) -> DataFrame:
    return aggregates.restaurant_stats_from_tables(inputs.orders(), inputs.restaurants())


@query
def item_counts(inputs: Inputs) -> DataFrame:
    return aggregates.item_counts(inputs.order_items())


@query
def top10_restaurants(inputs: Inputs) -> DataFrame:
    return dashboard.top_restaurants(restaurant_revenue(inputs))


@query
def top10_items(inputs: Inputs) -> DataFrame:
    return dashboard.top_items(item_counts(inputs), inputs.menu_items())


@query
def latest_stats(inputs: Inputs) -> DataFrame:
    events = inputs.events().select("user_id", "event_type", "value", "ts", "event_id")
    return latest_per_key(events, ["user_id"], ["ts", "event_id"]).drop("ts", "event_id")


# --- running statistics ------------------------------------------------------------------


#: Messages in a file of a replayed topic, files in a micro-batch at least, and keys in a part of the state.
_FILE_MESSAGES, _BATCH_FILES, _STATE_KEYS = 100_000, 2, 500_000


def _key_count(inputs: Inputs) -> int:
    return max(inputs.restaurants().count(), inputs.menu_items().count())


def _batch_files(keys: int) -> int:
    """Files of a micro-batch. What a batch costs by the keys there are, a snapshot or a lookup in
    the menu, is shared by as many messages at least: over all batches it grows with the messages."""
    return max(_BATCH_FILES, -(-keys // _FILE_MESSAGES))


def _state_parts(keys: int) -> int:
    return max(8, -(-keys // _STATE_KEYS))


def _topic(rows: DataFrame, key: str, folder: str, batch_files: int) -> None:
    """Publish rows as a topic of files, which make two micro-batches at least."""
    files = max(2 * batch_files, -(-rows.count() // _FILE_MESSAGES))
    # Dealt out before they are encoded: rows are smaller than their messages.
    publish_to_files(keyed_messages(rows.repartition(files), key), folder)


def _replayed_job(inputs: Inputs, snapshot_every: int = 100) -> OrderStatsJob:
    """The job over both topics. Micro-batches grow with the keys, their number with the messages
    to a key; the parts of the state grow with the keys."""
    job = OrderStatsJob(scratch_path(inputs.spark, "stream"), snapshot_every=snapshot_every)
    keys = _key_count(inputs)
    files = _batch_files(keys)
    _topic(joins.enrich_orders(inputs.orders(), inputs.restaurants()), "order_id", f"{job.root}/orders", files)
    _topic(inputs.order_items(), "fk_order", f"{job.root}/items", files)
    session = streaming_session(inputs.spark, state_partitions=_state_parts(keys))
    topics = [
        topic_stream(session, f"{job.root}/{name}", fmt="text", maxFilesPerTrigger=str(files))
        for name in ("orders", "items")
    ]
    await_all(job.start(*topics, quarantine=False, menu=inputs.menu_items, availableNow=True))
    return job


def _replayed(inputs: Inputs, rows: DataFrame, key: str, running, stats_key: str, after=()) -> str:
    """One running statistic over a topic; returns the folder of the run."""
    root = scratch_path(inputs.spark, "stream")
    keys = _key_count(inputs)
    files = _batch_files(keys)
    _topic(rows, key, f"{root}/topic", files)
    session = streaming_session(inputs.spark, state_partitions=_state_parts(keys))
    messages = topic_stream(session, f"{root}/topic", fmt="text", maxFilesPerTrigger=str(files))
    job = start_file_changelog(
        running(messages), f"{root}/changelog", f"{root}/checkpoint", key=stats_key,
        after_batch=[make(f"{root}/top", f"{root}/changelog") for make in after], availableNow=True,
    )
    await_all([job])
    return root


def _replayed_orders(inputs: Inputs, after=()) -> str:
    orders = joins.enrich_orders(inputs.orders(), inputs.restaurants())
    return _replayed(inputs, orders, "order_id", running_restaurant_stats, "restaurant_name", after)


def _replayed_items(inputs: Inputs, after=()) -> str:
    return _replayed(inputs, inputs.order_items(), "fk_order", running_item_counts, "fk_menu_item", after)


@query
def restaurant_revenue_stream(inputs: Inputs) -> DataFrame:
    root = _replayed_orders(inputs)
    return read_current(inputs.spark, f"{root}/changelog", RESTAURANT_STATS, "restaurant_name")


@query
def item_counts_stream(inputs: Inputs) -> DataFrame:
    root = _replayed_items(inputs)
    return read_current(inputs.spark, f"{root}/changelog", MENU_ITEM_STATS, "fk_menu_item")


@query
def top10_restaurants_live(inputs: Inputs) -> DataFrame:
    """What the stream published as its top ten after the last batch."""
    root = _replayed_orders(inputs, [lambda top, log: live_top_k(top, "restaurant_name", "total_revenue", log)])
    return dashboard.top_restaurants(read_view(inputs.spark, f"{root}/top", RESTAURANT_STATS))


@query
def top10_items_live(inputs: Inputs) -> DataFrame:
    """Labelled and cut in the micro-batches; only the published folder is read."""
    shown = labelled_by(inputs.menu_items)
    root = _replayed_items(inputs, [lambda top, log: live_top_k(top, "fk_menu_item", "item_quantity", log, shown=shown)])
    return read_view(inputs.spark, f"{root}/top", LABELLED_ITEM_STATS).drop("fk_menu_item")


@query
def top10_job(inputs: Inputs) -> DataFrame:
    """Both top tens as one job publishes them."""
    job = _replayed_job(inputs)
    restaurants = job.top_restaurants(inputs.spark).select(
        F.lit("restaurant").alias("kind"), F.col("restaurant_name").alias("name"), F.col("total_revenue").alias("value")
    )
    items = job.top_items(inputs.spark).select(
        F.lit("item").alias("kind"), F.col("item_name").alias("name"), F.col("item_quantity").cast("double").alias("value")
    )
    return restaurants.unionByName(items)


@query
def snapshot_current(inputs: Inputs) -> DataFrame:
    """Quantities out of snapshots alone: one after each batch, made from the one before."""
    job = _replayed_job(inputs, snapshot_every=1)
    _, state = current_version(inputs.spark, job.changelog(ITEM_TOPIC))
    if state["live"]:
        raise ValueError("a batch is not in the snapshot")
    return job.item_counts(inputs.spark)


@query
def revenue_after_restart(inputs: Inputs) -> DataFrame:
    """Half of the orders, then a new start from the same checkpoint for the rest."""
    orders = joins.enrich_orders(inputs.orders(), inputs.restaurants())
    root = scratch_path(inputs.spark, "restart")
    session = streaming_session(inputs.spark)
    for half in (0, 1):
        publish_to_files(keyed_messages(orders.where(F.col("order_id") % 2 == half), "order_id"), f"{root}/topic")
        stats = running_restaurant_stats(topic_stream(session, f"{root}/topic", fmt="text"))
        await_all([start_file_changelog(stats, f"{root}/changelog", f"{root}/checkpoint", availableNow=True)])
    return read_current(inputs.spark, f"{root}/changelog", RESTAURANT_STATS, "restaurant_name")


@query
def revenue_after_rescale(inputs: Inputs) -> DataFrame:
    """Half of the orders with 8 parts of the state, and the rest with 32."""
    orders = joins.enrich_orders(inputs.orders(), inputs.restaurants())
    root = scratch_path(inputs.spark, "rescale")
    publish_to_files(keyed_messages(orders.where("order_id % 2 = 0"), "order_id"), f"{root}/topic")
    session = streaming_session(inputs.spark, state_partitions=8)
    stats = running_restaurant_stats(topic_stream(session, f"{root}/topic", fmt="text"))
    await_all([start_file_changelog(stats, f"{root}/changelog", f"{root}/first", key="restaurant_name", availableNow=True)])
    carried = rescale.carry_revenue(inputs.spark, f"{root}/first", f"{root}/changelog", f"{root}/carried")
    publish_to_files(keyed_messages(orders.where("order_id % 2 = 1"), "order_id"), f"{root}/topic")
    session = streaming_session(inputs.spark, state_partitions=32)
    stats = rescale.resumed_restaurant_stats(rescale.remaining_files(session, f"{root}/topic", carried), carried)
    await_all([rescale.start_resumed(stats, carried, f"{root}/changelog", f"{root}/second", "restaurant_name", availableNow=True)])
    return read_current(inputs.spark, f"{root}/changelog", RESTAURANT_STATS, "restaurant_name")


def _job(
    inputs: Inputs, orders: DataFrame, items: DataFrame, quarantine: bool = True
) -> tuple[OrderStatsJob, list[StreamingQuery]]:
    """Both statistics and the quarantine from one job over two topics of files."""
    job = OrderStatsJob(scratch_path(inputs.spark, "job"))
    session = streaming_session(inputs.spark)
    publish_to_files(orders, f"{job.root}/orders")
    publish_to_files(items, f"{job.root}/items")
    topics = [topic_stream(session, f"{job.root}/{name}", fmt="text") for name in ("orders", "items")]
    queries = job.start(*topics, quarantine, availableNow=True)
    await_all(queries)
    return job, queries


@query
def order_stats_job(inputs: Inputs) -> DataFrame:
    orders = keyed_messages(joins.enrich_orders(inputs.orders(), inputs.restaurants()), "order_id")
    job, _ = _job(inputs, orders, keyed_messages(inputs.order_items(), "fk_order"))
    revenue = job.restaurant_stats(inputs.spark).select(
        F.lit("restaurant").alias("kind"), F.col("restaurant_name").alias("key"), F.col("total_revenue").alias("value")
    )
    counts = job.item_counts(inputs.spark).select(
        F.lit("item").alias("kind"),
        F.col("fk_menu_item").cast("string").alias("key"),
        F.col("item_quantity").cast("double").alias("value"),
    )
    return revenue.unionByName(counts)


def _broken_messages(inputs: Inputs) -> tuple[DataFrame, DataFrame]:
    """Of every seven orders one lost its name, one its end, and one costs no number; of every
    eleven the items of one lost their menu item, and those of another their end."""
    orders = keyed_messages(joins.enrich_orders(inputs.orders(), inputs.restaurants()), "order_id")
    kind = F.col("key").cast("bigint") % 7
    broken = (
        F.when(kind == 0, F.replace("value", F.lit("restaurant_name"), F.lit("name")))
        .when(kind == 1, F.expr("left(value, 10)"))
        .when(kind == 2, F.regexp_replace("value", '"total_cost":[^,]*', '"total_cost":1e400'))
        .otherwise(F.col("value"))
    )
    items = keyed_messages(inputs.order_items(), "fk_order")
    kind = F.col("key").cast("bigint") % 11
    cut = (
        F.when(kind == 0, F.replace("value", F.lit("fk_menu_item"), F.lit("item")))
        .when(kind == 1, F.expr("left(value, 10)"))
        .otherwise(F.col("value"))
    )
    return orders.withColumn("value", broken), items.withColumn("value", cut)


@query
def stream_quarantine(inputs: Inputs) -> DataFrame:
    """What was kept of the unusable messages, which are read a second time for it."""
    job, _ = _job(inputs, *_broken_messages(inputs))
    kept = inputs.spark.read.schema("topic string, value string, reason string").parquet(f"{job.root}/quarantine")
    return kept.groupBy("topic", "reason").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_rejects(inputs: Inputs) -> DataFrame:
    """The numbers alone, out of the queries that count the others."""
    job, queries = _job(inputs, *_broken_messages(inputs), quarantine=False)
    return job.rejects(inputs.spark, after=queries)


# --- orders and their dimensions ---------------------------------------------------------


@query
def orders_list(inputs: Inputs) -> DataFrame:
    return joins.orders_list(inputs.orders(), inputs.restaurants(), inputs.users())


@query
def orders_list_sql(inputs: Inputs) -> DataFrame:
    return query_tables(
        inputs.spark,
        """
        SELECT user_fullname, restaurant_name, count(*) AS n_orders
        FROM {orders}
        JOIN {restaurants} ON fk_restaurant = restaurant_id
        JOIN {users} ON fk_user = user_id
        GROUP BY user_fullname, restaurant_name
        """,
        orders=inputs.orders(),
        restaurants=inputs.restaurants(),
        users=inputs.users(),
    )


def _listing(inputs: Inputs, size: int) -> Listing:
    return dashboard.order_listing(
        inputs.orders(), inputs.restaurants(), inputs.users(), "total_cost", False, size
    )


@query
def orders_page(inputs: Inputs) -> DataFrame:
    return _listing(inputs, 25).page(3).drop("order_id")


@query
def orders_last_page(inputs: Inputs) -> DataFrame:
    return _listing(inputs, 100).last_page().drop("order_id")


@query
def orders_next_page(inputs: Inputs) -> DataFrame:
    """The fourth page, reached from one to the next."""
    pages = _listing(inputs, 25)
    cursor = None
    for _ in range(3):
        cursor = pages.cursor(pages.next_page(cursor).collect()[-1])
    return pages.next_page(cursor).drop("order_id")


@query
def orders_previous_page(inputs: Inputs) -> DataFrame:
    """The page in front of the last one."""
    pages = _listing(inputs, 100)
    return pages.previous_page(pages.cursor(pages.last_page().first())).drop("order_id")


@query
def orders_deep_page(inputs: Inputs) -> DataFrame:
    """Read from the stored listing, which stays for as long as the result is read."""
    return _listing(inputs, 100).stored().page(120).drop("order_id")


@query
def orders_page_by_user(inputs: Inputs) -> DataFrame:
    rows = joins.orders_list(inputs.orders(), inputs.restaurants(), inputs.users(), "order_id")
    return listing(rows, "user_fullname", "order_id", 50).page(2)


@query
def q_page_index(inputs: Inputs) -> DataFrame:
    return page_index(inputs.orders())


@query
def order_enrich(inputs: Inputs) -> DataFrame:
    return joins.enrich_orders(inputs.orders(), inputs.restaurants())


@query
def restaurant_menu(inputs: Inputs) -> DataFrame:
    return joins.order_menus(inputs.orders(), inputs.menu_items())


@query
def order_totals(inputs: Inputs) -> DataFrame:
    return aggregates.order_totals(inputs.order_items(), inputs.menu_items())


@query
def order_item_quantities(inputs: Inputs) -> DataFrame:
    return aggregates.order_item_quantities(inputs.order_items())


@query
def order_total_reconcile(inputs: Inputs) -> DataFrame:
    return quality.reconcile_order_totals(
        inputs.orders(), inputs.order_items(), inputs.menu_items()
    )


# --- scans and payloads ------------------------------------------------------------------


@query
def table_scan_filtered(inputs: Inputs) -> DataFrame:
    of_one = inputs.menu_owner() == 3
    return inputs.menu_items(scan_table(inputs.spark, f"{inputs.folder}/part.parquet", where=of_one, required=True))


@query
def table_scan_predicate(inputs: Inputs) -> DataFrame:
    users = scan_table(
        inputs.spark,
        f"{inputs.folder}/customer.parquet",
        where="c_nationkey = 3 OR c_name LIKE '%7'",
        required=True,
    )
    return users.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_nationkey").cast("bigint").alias("fk_address"),
        F.col("c_name").alias("user_fullname"),
    )


@query
def table_scan_json(inputs: Inputs) -> DataFrame:
    users = inputs.users().select("user_id", "fk_address", "user_fullname", "email")
    return as_json_rows(users)


@query
def table_counts(inputs: Inputs) -> DataFrame:
    return aggregates.table_counts(
        {
            "address": inputs.address(),
            "users": inputs.users(),
            "restaurants": inputs.restaurants(),
            "menu_items": inputs.menu_items(),
            "orders": inputs.orders(),
            "order_item": inputs.order_items(),
        }
    )


@query
def json_decode(inputs: Inputs) -> DataFrame:
    messages = inputs.events().select("event_id", F.col("props").alias("value"))
    # The message itself carries no id, so it is wrapped together with one.
    text = F.concat(F.lit('{"event_id": '), "event_id", F.lit(', "props": '), "value", F.lit("}"))
    decoded = decode_messages(messages.select(text.alias("value")), _EVENT)
    return decoded.select("event_id", F.col("props.k").alias("k"))


_PROPS = StructType([StructField("k", IntegerType(), True)])
_EVENT = StructType([StructField("event_id", LongType(), True), StructField("props", _PROPS, True)])


@query
def typecast_orders(inputs: Inputs) -> DataFrame:
    orders = inputs.orders()
    texts = orders.select(*[F.col(name).cast("string").alias(name) for name in orders.columns])
    return typecast(texts, ORDERS)


@query
def publish_orders(inputs: Inputs) -> DataFrame:
    messages = keyed_messages(inputs.orders(), "order_id")
    decoded = decode_messages(messages, ORDER_EVENT, "key")
    return decoded.select("key", "order_id", "order_datetime", "total_cost")


@query
def publish_period(inputs: Inputs) -> DataFrame:
    """The messages of a period that is given as text, both days included."""
    bounds = inputs.spark.range(1).select(parse_day(F.lit("3/8/1996")), parse_day(F.lit("04/10/1996")))
    start, end = bounds.first()
    quality.check_period(start, end)
    orders = inputs.orders().where(quality.in_period("order_datetime", start, end))
    return decode_messages(keyed_messages(orders, "order_id"), ORDER_EVENT, "key").select("key", "order_datetime")


@query
def orders_load(inputs: Inputs) -> DataFrame:
    """Each order line counts as one item drawn; ids go on from the stored ones."""
    draft = F.col("order_id").alias("draft")
    placed = inputs.orders().select(draft, "fk_restaurant", "fk_user", "order_datetime", "cust_restaurant_rating")
    drawn = inputs.order_items().select(F.col("fk_order").alias("draft"), "fk_menu_item")
    start = next_id(inputs.orders(), "order_id")
    tables = load_orders(drawn, placed, inputs.menu_items(), start, 500)
    return tables.order_items.join(
        tables.orders.select(F.col("order_id").alias("fk_order"), "fk_user", "total_cost"), "fk_order"
    )


@query
def create_and_load(inputs: Inputs) -> DataFrame:
    """Empty tables are made, one of them is filled, and all are counted."""
    paths = create_tables(inputs.spark, scratch_path(inputs.spark, "tables"))
    append_new(inputs.restaurants(), paths["restaurants"], RESTAURANTS, "restaurant_id")
    create_tables(inputs.spark, paths["restaurants"].rsplit("/", 1)[0])  # leaves what is there
    stored = {name: scan_table(inputs.spark, path, TABLES[name][0]) for name, path in paths.items()}
    return aggregates.table_counts(stored)


# --- text and documents ------------------------------------------------------------------


@query
def distinct_names(inputs: Inputs) -> DataFrame:
    return documents.distinct_names(inputs.menu_items(), "item_name")


@query
def distinct_name_count(inputs: Inputs) -> DataFrame:
    return aggregates.distinct_count(inputs.menu_items(), "item_name")


@query
def numbered_list_parse(inputs: Inputs) -> DataFrame:
    part = inputs.table("part")
    first = F.concat(F.lit("1. "), "p_name", F.lit("\n2.  "), "p_brand", F.lit(" \nand more"))
    second = F.concat(F.lit(" 3. "), "p_type", F.lit("\n\n"), F.col("p_size").cast("string"))
    batches = [part.select(F.col("p_partkey").alias("list_id"), t.alias("text")) for t in (first, second)]
    return documents.list_names(batches[0].unionByName(batches[1]), "list_id")


@query
def name_list_roundtrip(inputs: Inputs) -> DataFrame:
    """Numbered lists in files become a file of distinct names, which is read again."""
    root = scratch_path(inputs.spark, "names")
    part = inputs.table("part")
    line = F.concat(F.col("p_partkey").cast("string"), F.lit(". "), "p_name")
    part.select(line).write.text(f"{root}/lists")
    names = documents.list_names(read_list_texts(inputs.spark, f"{root}/lists"))
    write_names(documents.distinct_names(names, "name"), f"{root}/written", "name")
    return read_names(inputs.spark, f"{root}/written")


def _written_price(key: Column, price: Column) -> Column:
    """Prices as people write them, a different way for each key."""
    text = price.cast("decimal(18,2)").cast("string")
    return (
        F.when(key % 5 == 0, F.concat(F.lit("$"), text))
        .when(key % 5 == 1, F.lit("FREE"))
        .when(key % 5 == 2, F.concat(text, F.lit("$-"), text, F.lit("$")))
        .when(key % 5 == 3, F.lit("on request"))
        .otherwise(text)
    )


@query
def price_normalize(inputs: Inputs) -> DataFrame:
    part = inputs.table("part")
    written = _written_price(F.col("p_partkey"), F.col("p_retailprice"))
    return part.select(F.col("p_partkey").alias("item_id"), normalized_price(written).alias("price"))


@query
def extract_json(inputs: Inputs) -> DataFrame:
    answer = F.concat(F.lit("Sure, here it is:\n"), "props", F.lit("\nAnything   else?"))
    events = inputs.events().select("event_id", document_json(answer).alias("value"))
    return events.select("event_id", F.from_json("value", "k int")["k"].alias("k"))


#: Documents that a task takes apart as variants.
_TASK_DOCUMENTS = 10_000


def _user_texts(inputs: Inputs, customer: DataFrame | None = None) -> DataFrame:
    """A user document for each customer, or for some rows of that table."""
    customer = inputs.table("customer") if customer is None else customer
    text = F.col
    profile = F.struct(
        F.struct(
            F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first"),
            F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last"),
        ).alias("name"),
        F.struct(text("c_name").alias("username")).alias("login"),
        F.struct(
            F.struct(text("c_custkey").alias("number"), text("c_mktsegment").alias("name")).alias("street"),
            F.lit("Springfield").alias("city"),
            text("c_nationkey").alias("postcode"),
        ).alias("location"),
    )
    return customer.select(
        "c_custkey",
        "c_nationkey",
        F.to_json(F.struct(F.array(profile).alias("results"))).alias("value"),
    )


def _user_profiles(inputs: Inputs) -> DataFrame:
    landed = _user_texts(inputs)
    results = F.from_json("value", USER_DOCUMENT)["results"]
    return landed.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_nationkey").cast("bigint").alias("fk_address"),
        F.explode(results).alias("profile"),
    ).select("user_id", "fk_address", "profile.*")


@query
def user_fields_unknown(inputs: Inputs) -> DataFrame:
    """Of every five documents one has a field more, of every seven one has a text for its street,
    and of every eleven one has a list for its user name."""
    key, value = F.col("c_custkey"), F.col("value")
    more = F.replace(value, F.lit('"name":{"first"'), F.lit('"loyalty":{"level":"gold"},"name":{"first"'))
    value = F.when(key % 5 == 0, more).otherwise(value)
    value = F.when(key % 7 == 0, F.regexp_replace(value, '"street":[{][^}]*[}]', '"street":"Main"')).otherwise(value)
    value = F.when(key % 11 == 0, F.regexp_replace(value, '"username":"[^"]*"', '"username":["x"]')).otherwise(value)
    customer = inputs.table("customer")
    # The table is small beside the work on its documents: by its bytes a few tasks would read it all.
    spread = customer.repartition(max(1, -(-customer.count() // _TASK_DOCUMENTS)))
    texts = _user_texts(inputs, spread).select(key.alias("user_id"), value.alias("text"))
    return left_behind(texts, USER_DOCUMENT)


@query
def user_flatten(inputs: Inputs) -> DataFrame:
    users = documents.flatten_users(_user_profiles(inputs))
    return users.select("user_id", "user_fullname", "fk_address", "address_info")


@query
def user_load(inputs: Inputs) -> DataFrame:
    profiles = _user_profiles(inputs).drop("user_id", "fk_address")
    tables = documents.load_users(
        profiles,
        user_start=100,
        address_start=next_id(inputs.address(), "address_id"),
        order=["registration_number"],
    )
    joined = tables.users.join(
        tables.address, F.col("fk_address") == F.col("address_id")
    )
    return joined.select("user_id", "fk_address", "registration_number", "address_info")


def _landed_users(inputs: Inputs) -> DataFrame:
    """The user documents of a folder of files, checked; of every ten one is cut short and one
    has lost its names."""
    path = scratch_path(inputs.spark, "users")
    kind = F.col("c_custkey") % 10
    text = (
        F.when(kind == 3, F.expr("left(value, 20)"))
        .when(kind == 4, F.replace("value", F.lit('"name"'), F.lit('"names"')))
        .otherwise(F.col("value"))
    )
    _user_texts(inputs).select(text).write.text(path)
    parsed = documents.parse_users(read_document_lines(inputs.spark, path))
    return quality.check_documents(parsed, ["name", "login.username"])


@query
def user_documents_file(inputs: Inputs) -> DataFrame:
    profiles = quality.usable(_landed_users(inputs)).select("document.*")
    return documents.flatten_users(profiles).select("registration_number", "user_fullname", "address_info")


@query
def user_quarantine(inputs: Inputs) -> DataFrame:
    return quality.quarantined(_landed_users(inputs)).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def restaurant_documents_file(inputs: Inputs) -> DataFrame:
    path = scratch_path(inputs.spark, "restaurants")
    _restaurant_texts(inputs).select("text").write.text(path)
    parsed = documents.parse_restaurants(read_document_lines(inputs.spark, path))
    checked = quality.check_documents(parsed, ["restaurant_name", "address", "foods", "drinks", "desserts"])
    return quality.usable(checked).select(
        F.col("document.restaurant_name").alias("restaurant_name"), F.size("document.foods").alias("n_foods")
    )


def _restaurant_texts(inputs: Inputs) -> DataFrame:
    """One restaurant answer per part, some of them with no usable document."""
    part = inputs.table("part")
    entry = lambda name, price: F.struct(name.alias("name"), price.alias("price"))
    key, price = F.col("p_partkey"), F.col("p_retailprice")
    document = F.struct(
        F.concat(F.lit("House of "), "p_name").alias("restaurant_name"),
        F.concat_ws(" ", "p_size", F.lit("Main Street")).alias("address"),
        F.lit("-118.25").alias("longitude"),
        F.col("p_size").alias("latitude"),
        F.array(
            entry(F.col("p_name"), _written_price(key, price)),
            entry(F.col("p_brand"), F.lit("12.5")),
        ).alias("foods"),
        F.array(entry(F.col("p_type"), F.lit("$3"))).alias("drinks"),
        F.array(entry(F.concat("p_name", F.lit(" pie")), F.lit("1-2"))).alias("desserts"),
    )
    broken = F.col("p_size")
    text = (
        F.when(broken == 1, F.lit("I cannot help with that."))
        .when(broken == 2, F.concat(F.lit('{"foods": [ '), "p_name", F.lit(" }")))
        .when(broken == 3, F.lit('{"restaurant_name": "Nameless"}'))
        .otherwise(F.concat(F.lit("Here you go: "), F.to_json(document), F.lit(" Enjoy!")))
    )
    return part.select(key.alias("document_id"), text.alias("text"))


def _checked_restaurants(inputs: Inputs) -> DataFrame:
    parsed = documents.parse_restaurants(_restaurant_texts(inputs))
    return quality.check_documents(parsed, ["restaurant_name", "address", "foods", "drinks", "desserts"])


@query
def menu_flatten(inputs: Inputs) -> DataFrame:
    parsed = quality.usable(_checked_restaurants(inputs))
    menu = documents.menu_rows(parsed, "document_id")
    return menu.select(
        F.col("document_id").alias("fk_restaurant"), "item_name", "item_category", "price"
    )


@query
def menu_load(inputs: Inputs) -> DataFrame:
    parsed = quality.usable(_checked_restaurants(inputs))
    tables = documents.load_restaurants(
        parsed, "document_id", address_start=next_id(inputs.address(), "address_id")
    )
    restaurants = tables.restaurants.join(
        tables.address, F.col("fk_address") == F.col("address_id")
    )
    return tables.menu_items.join(
        restaurants, F.col("fk_restaurant") == F.col("restaurant_id")
    ).select("item_id", "fk_restaurant", "fk_address", "restaurant_name", "latitude", "item_name", "price")


@query
def document_quarantine(inputs: Inputs) -> DataFrame:
    bad = quality.quarantined(_checked_restaurants(inputs))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def price_quarantine(inputs: Inputs) -> DataFrame:
    menu = documents.menu_rows(quality.usable(_checked_restaurants(inputs)), "document_id")
    return quality.unreadable_prices(menu).select("document_id", "menu_place", "price_text")


@query
def quarantine(inputs: Inputs) -> DataFrame:
    kind = F.col("event_type")
    value = (
        F.when(kind == "error", F.replace("props", F.lit(":"), F.lit(" ")))
        .when(kind == "signup", F.lit("{}"))
        .when(kind == "view", F.lit(""))
        .otherwise(F.col("props"))
    )
    checked = quality.check_messages(
        inputs.events().select(value.alias("value")), _PROPS, required=["k"]
    )
    status = F.coalesce("reason", F.lit("valid"))
    return checked.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


# --- ids, appends, days ------------------------------------------------------------------


@query
def q_assign_ids(inputs: Inputs) -> DataFrame:
    menu = inputs.menu_items().select("item_id", "fk_restaurant")
    start = next_id(inputs.users(), "user_id")
    return assign_ids(menu, ["fk_restaurant", "item_id"], "new_id", start).select("item_id", "new_id")


@query
def q_append_new(inputs: Inputs) -> DataFrame:
    """Orders before 1998 are stored; then all orders arrive, and those from 2000 on twice, the
    second time at another price."""
    orders = inputs.orders()
    path = scratch_path(inputs.spark, "orders")
    orders.where("order_datetime < '1998-01-01'").write.parquet(path)
    again = orders.where("order_datetime >= '2000-01-01'").withColumn(
        "total_cost", F.col("total_cost") + 1
    )
    append = append_new(orders.unionByName(again), path, ORDERS, "order_id")
    accepted = append.accepted.select(
        "order_id", "total_cost", F.lit("accepted").alias("status"), F.lit(1).cast("bigint").alias("n")
    )
    rejected = append.rejected.select("order_id", "total_cost", F.col("reason").alias("status"), "n")
    return accepted.unionByName(rejected)


@query
def q_day_series(inputs: Inputs) -> DataFrame:
    period = inputs.orders().agg(
        F.date_format(F.min("order_datetime"), "M/d/yyyy").alias("first"),
        F.date_format(F.max("order_datetime"), "MM/dd/yyyy").alias("last"),
    )
    days = day_series(period, parse_day(F.col("first")), parse_day(F.col("last")))
    return days.select(
        "day", plus_seconds(F.col("day").cast("timestamp_ntz"), F.lit(86400)).alias("latest_order")
    )
