"""Session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the plans in this package were read with. Adaptive execution picks the partition
# count, turns small sides into broadcasts after measuring them, and splits hot join keys.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # Upload only the changes of each micro-batch, not a snapshot of all keys.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Aim for partitions that sort and hash in memory; adaptive execution merges smaller ones.
_PARTITION_BYTES = 256 << 20


def shuffle_partitions(shuffle_bytes: int) -> int:
    """Partitions for a job whose largest shuffle moves so many bytes. Adaptive execution only
    ever lowers the number, so it has to be set for the largest."""
    return max(200, -(-shuffle_bytes // _PARTITION_BYTES))


def build_session(
    app_name: str = "servery",
    master: str | None = None,
    shuffle_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    if shuffle_bytes is not None:
        conf = {"spark.sql.shuffle.partitions": str(shuffle_partitions(shuffle_bytes)), **conf}
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session on the same cluster and with the same settings, but RocksDB state and its own
    query manager.

    The number of state partitions is fixed in the checkpoint when a query first starts, so
    choose it for the largest key count expected, not for today's.
    """
    session = spark.newSession()
    for key, value in {**spark.conf.getAll, **SESSION_CONF, **ROCKSDB_STATE}.items():
        # Spark's own settings that are fixed at its start are the same for all sessions.
        if session.conf.isModifiable(key) or not key.startswith("spark."):
            session.conf.set(key, value)
    if state_partitions is not None:
        session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    return session
