"""Tables as parquet folders, and appends that keep their primary key."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from servery.schemas import TABLES, conform
from servery.staging import discard, stored

#: Ranges of keys in which a table is looked through for those of a batch.
_RANGES = 32


def create_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Create the tables that do not exist yet; returns the folder of each."""
    paths = {name: f"{root.rstrip('/')}/{name}" for name in TABLES}
    for name, (schema, _) in TABLES.items():
        spark.createDataFrame([], schema).write.mode("ignore").parquet(paths[name])
    return paths


@dataclass(frozen=True)
class Append:
    accepted: DataFrame  # rows added to the table
    rejected: DataFrame  # rows left out, with reason and number of copies n
    paths: tuple[str, ...] = ()  # stored clashes, which both are read from

    def close(self) -> None:
        """Delete what was stored to decide; neither table can be read afterwards."""
        discard(self.accepted.sparkSession, *self.paths)


def append_new(rows: DataFrame, path: str, schema: StructType, key: str) -> Append:
    """Append the rows whose key is set, new to the table and met for the first time.

    Of several rows with one key the smallest in column order is taken. One writer at a time,
    and ``rows`` must not read the table itself.

    Of the table only row groups that reach into the batch's ranges of keys are read, and only keys
    are shuffled to find the clashes. They, and the rows taken of those that share a
    key, are stored before the table changes, so that a retry, or a later read of the rejects,
    cannot come to another result; rows without a clash, as a rule nearly all of them, then go
    from their scan to the table.
    """
    rows = conform(rows, schema, missing_ok=())
    keyed = rows.where(F.col(key).isNotNull())
    table = rows.sparkSession.read.schema(schema).parquet(path)
    clashes, clashes_path = stored(_clashes(keyed, table, key), "clashes")

    repeated = keyed.join(clashes.where(~F.col("known")), key, "left_semi")
    first, first_path = stored(_smallest(repeated, key), "first")
    fresh = keyed.join(clashes, key, "left_anti")
    accepted = fresh.unionByName(first)
    accepted.write.mode("append").parquet(path)
    return Append(accepted, _rejected(rows, keyed, clashes, first, key), (clashes_path, first_path))


def _clashes(keyed: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Keys that the table has (``known``) or that occur more than once among the rows."""
    copies = keyed.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    # The batch is the side that is hashed or sent round: of the table only hits move.
    stored_keys = table.select(key).where(_within(key, _ranges(keyed, key)))
    known = stored_keys.join(copies.select(key), key, "left_semi").distinct()
    known = known.withColumn("known", F.lit(True))
    joined = copies.join(known, key, "left")
    return joined.select(key, "copies", F.coalesce("known", F.lit(False)).alias("known")).where(
        "known OR copies > 1"
    ).drop("copies")


def _ranges(keyed: DataFrame, key: str) -> list[tuple]:
    """Smallest and largest key of the rows. Where whole numbers lie far apart, those of each of
    ``_RANGES`` equal stretches between them, so that a few far-off keys do not stretch the rest."""
    low, high, n = keyed.agg(F.min(key), F.max(key), F.count(key)).first()
    if low is None or not isinstance(keyed.schema[key].dataType, IntegralType) or high - low < 4 * n:
        return [(low, high)]
    stretch = F.floor((F.col(key).cast("decimal(20,0)") - F.lit(low)) / F.lit((high - low) // _RANGES + 1))
    found = keyed.groupBy(stretch.alias("stretch")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    return sorted((row["low"], row["high"]) for row in found.collect())


def _within(key: str, ranges: list[tuple]) -> Column:
    """Bare comparisons, by which a scan skips row groups without such keys: as ids go on from batch
    to batch, nearly all of a table."""
    return reduce(Column.__or__, [F.col(key).between(low, high) for low, high in ranges])


def _smallest(rows: DataFrame, key: str) -> DataFrame:
    """One row per key of rows that were joined by that key.

    Grouped by the key as a struct, which takes a shuffle of its own after the join. Grouped by
    the bare key, Spark would reuse the join's partitioning and could not split a hot key there.
    """
    smallest = F.min(F.struct(*rows.columns)).alias("row")
    return rows.groupBy(F.struct(key).alias("group")).agg(smallest).select("row.*")


def _rejected(
    rows: DataFrame, keyed: DataFrame, clashes: DataFrame, first: DataFrame, key: str
) -> DataFrame:
    """Every row that was not accepted, whole; equal ones as one row and their number."""
    reason = F.when(F.col("known"), "already_present").otherwise("duplicate_key")
    arrived = keyed.join(clashes, key).select(_whole(rows), reason.alias("reason"), F.lit(1).alias("n"))
    taken = first.select(_whole(rows), F.lit("duplicate_key").alias("reason"), F.lit(-1).alias("n"))
    unkeyed = rows.where(F.col(key).isNull()).select(
        _whole(rows), F.lit("null_key").alias("reason"), F.lit(1).alias("n")
    )
    balance = arrived.unionByName(taken).unionByName(unkeyed)
    return (
        balance.groupBy("row", "reason")
        .agg(F.sum("n").alias("n"))
        .where("n > 0")
        .select("row.*", "reason", "n")
    )


def _whole(rows: DataFrame) -> Column:
    return F.struct(*rows.columns).alias("row")
