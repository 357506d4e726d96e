"""Changelogs of running statistics: the rows that changed, micro-batch by micro-batch."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from servery.functions.payload import encode
from servery.operators.latest import latest_per_key
from servery.sources.changelog import FILE_SEQUENCE, read_parts
from servery.versions import current_version, publish_version

AfterBatch = Callable[[DataFrame, int], None]

#: Parts of a snapshot, and batches between two.
BUCKETS, SNAPSHOT_EVERY = 32, 100


def write_changelog_batch(
    path: str, files: int | None = None, key: str | None = None, every: int = SNAPSHOT_EVERY, buckets: int = BUCKETS
) -> AfterBatch:
    """Writer of one micro-batch to a folder whose pointer names the parts that count.

    A batch that is run again after a failure takes its own place, so the changelog holds each
    batch once. With a ``key``, each ``every`` batches are folded into a snapshot of the current
    rows and deleted a few versions later: neither the folder nor what a reader lists grows with
    the number of batches. Snapshots are kept in ``buckets`` parts by a hash of the key, and only
    parts with changed keys are written anew. The number of buckets of a folder stays as it was first.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _, known = current_version(spark, path)
        if batch_id <= known.get("snapshot", -1):
            return  # it was folded in before the query could note that it was done
        part = f"{FILE_SEQUENCE}={batch_id}/attempt={uuid.uuid4().hex}"
        rows = batch.withColumn(FILE_SEQUENCE, F.lit(batch_id).cast("bigint"))
        (rows if files is None else rows.repartition(files)).write.parquet(f"{path}/{part}")
        live = {int(n): p for n, p in known.get("live", {}).items()}
        unused = [live[batch_id]] if batch_id in live else []
        live[batch_id] = part
        state = {"live": live, "snapshot": known.get("snapshot", -1), "parts": known.get("parts", {})}
        state["buckets"] = known.get("buckets", buckets)
        if key is not None and len(live) >= every:
            state, replaced = _folded(spark, path, rows.schema, key, state)
            # A batch's folder holds nothing but its attempts.
            unused += replaced + [f"{FILE_SEQUENCE}={n}" for n in live]
        publish_version(spark, path, state, unused)

    return write


def _folded(spark: SparkSession, path: str, schema, key: str, state: dict) -> tuple[dict, list[str]]:
    """The state after all live batches went into the snapshot, and the parts they replace."""
    bucket = F.pmod(F.xxhash64(key), F.lit(state["buckets"])).cast("int")
    batches = read_parts(spark, path, schema, state["live"].values()).withColumn("_bucket", bucket)
    changed = sorted(str(row["_bucket"]) for row in batches.select("_bucket").distinct().collect())
    old = [state["parts"][b] for b in changed if b in state["parts"]]
    rows = read_parts(spark, path, schema, old).withColumn("_bucket", bucket).unionByName(batches)
    folder = f"_snapshots/{max(state['live'])}-{uuid.uuid4().hex}"
    latest = latest_per_key(rows, [key, "_bucket"], [FILE_SEQUENCE])
    latest.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{path}/{folder}")
    parts = state["parts"] | {b: f"{folder}/_bucket={b}" for b in changed}
    # A snapshot of which no part is left goes with its folder.
    parents = {part.rpartition("/")[0] for part in parts.values()}
    replaced = {p if (parent := p.rpartition("/")[0]) in parents else parent for p in old}
    return state | {"live": {}, "snapshot": max(state["live"]), "parts": parts}, sorted(replaced)


def start_file_changelog(
    stats: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    after_batch: Sequence[AfterBatch] = (),
    files: int | None = None,
    key: str | None = None,
    snapshot_every: int = SNAPSHOT_EVERY,
    first_batch: int = 0,
    **trigger,
) -> StreamingQuery:
    """Publish changed rows to a parquet folder.

    Each batch is written by as many tasks as there are state partitions; ``files`` deals the
    rows out to that many instead. ``after_batch`` runs once the batch is written. With a ``key``
    the folder stays bounded, see :func:`write_changelog_batch`. ``first_batch`` is the number in
    the changelog of the query's first batch. ``trigger`` is passed on to the writer, for example
    ``availableNow=True``.
    """
    write = write_changelog_batch(path, files, key, snapshot_every)

    def publish(batch: DataFrame, query_batch: int) -> None:
        batch_id = first_batch + query_batch
        if not after_batch:
            write(batch, batch_id)
            return
        # Several actions on one micro-batch: keep its rows, do not update the state again.
        batch.persist()
        try:
            for action in (write, *after_batch):
                action(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stats.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return _started(writer.foreachBatch(publish), name, trigger)


def publish_view(spark: SparkSession, rows: list[Row], path: str) -> None:
    """Replace what a folder shows by these few rows, which are small enough to be part of the
    pointer. Readers see the rows before or these, and never a mixture; see
    :func:`~servery.sources.changelog.read_view`."""
    publish_version(spark, path, {"rows": [list(row) for row in rows]}, [])


def start_kafka_changelog(
    stats: DataFrame,
    key: str,
    topic: str,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Publish changed rows to a topic, keyed by the group key so that one key stays in one
    partition and its offsets follow the micro-batches."""
    messages = stats.select(
        F.col(key).cast("string").alias("key"), encode(*stats.columns).alias("value")
    )
    writer = (
        messages.writeStream.format("kafka")
        .outputMode("update")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .options(**options)
    )
    return _started(writer, name, trigger or {})


def _started(writer, name: str | None, trigger: dict) -> StreamingQuery:
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
