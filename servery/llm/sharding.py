"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source. The rank over the size of the
source is the place a row takes in any well-mixed order; sorted by it, every stretch of the corpus
holds the sources in their overall proportions. That order is cut into shards whose row counts
differ by one at most.

No source, and no shard, is ranked in one task: ranks are taken in buckets of a bounded size and
completed by the running totals of the bucket counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from servery.llm.common import buckets_for, hash_bucket, stored


def interleaved(rows: DataFrame, shards: int, stratum: str, tie: list[str], seed: int = 0) -> DataFrame:
    """``rows`` with ``position`` (long, gapless from 0), ``shard`` (int) and ``slot`` (long).

    ``tie`` names the columns that tell rows apart; together with the seed they decide the
    shuffle. Rows that agree in all of them are copies of each other and may change places. A
    NULL stratum is a stratum of its own. An empty table gives an empty result. ``rows`` should
    be narrow: it is shuffled twice and stored once.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    shuffled = stored(rows.withColumn("_h", F.xxhash64(F.lit(seed), *tie)), "shuffled")
    n = shuffled.count()
    ranked = stored(_ranked(shuffled, stratum, tie, buckets_for(n)), "ranked")
    placed = _placed(ranked, stratum, tie, buckets_for(n), seed)
    # Whole numbers: position * shards // n, and the first position of a shard.
    shard = F.expr(f"(position * {shards}) div {max(n, 1)}")
    first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return (
        placed.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col("position") - first)
        .drop("_h", "_rank", "_of")
    )


def _ranked(rows: DataFrame, stratum: str, tie: list[str], buckets: int) -> DataFrame:
    """Each row's rank (from 1) in the shuffled order of its stratum, and the stratum's size."""
    rows = rows.withColumn("_bucket", hash_bucket(F.col("_h"), buckets))
    counts = rows.groupBy(stratum, "_bucket").agg(F.count("*").alias("_in"))
    before = Window.partitionBy(stratum).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(stratum).alias("_s"),
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"),
        F.sum("_in").over(Window.partitionBy(stratum)).alias("_of"),
    )
    # Buckets are ranges of the unsigned hash, so the order inside them is unsigned as well.
    unsigned = F.col("_h").bitwiseXOR(F.lit(-(2**63)))
    inside = Window.partitionBy(stratum, "_bucket").orderBy(unsigned, *tie)
    return (
        rows.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, F.col(stratum).eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
        .drop("_bucket", "_s", "_b", "_before")
    )


def _placed(rows: DataFrame, stratum: str, tie: list[str], buckets: int, seed: int) -> DataFrame:
    """Each row's place in the order of fractional ranks ``(rank - u) / size``, with a number
    ``u`` between 0 and 1 that a hash gives each stratum. They spread evenly over 0 to 1, those of
    many strata with a row each as well, so equal stretches make even buckets."""
    spread = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit("place"), stratum), 11) + F.lit(0.5)) / F.lit(2.0**53)
    rows = rows.withColumn("_place", (F.col("_rank") - spread) / F.col("_of"))
    rows = rows.withColumn("_part", F.least(F.floor(F.col("_place") * buckets), F.lit(buckets - 1)))
    counts = rows.groupBy("_part").agg(F.count("*").alias("_in"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col("_part").alias("_p"), F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_part").orderBy("_place", stratum, "_h", *tie)
    return (
        rows.withColumn("position", F.row_number().over(inside))
        .join(offsets, F.col("_part") == F.col("_p"))
        .withColumn("position", F.col("position") + F.col("_before") - 1)
        .drop("_place", "_part", "_p", "_before")
    )


def digest_rows(docs: DataFrame) -> DataFrame:
    """Of each document its id, source, size and the check sum of its text. NULL text: no bytes."""
    return docs.select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0).cast("long")).alias("text_crc32"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 0) -> None:
    """The documents themselves in folders ``shard=0`` and so on, each row with its slot.

    The plan is made on digests; texts move once, to the files they end in. Repeated rows are
    written as often as they come.
    """
    keyed = docs.withColumn("_crc", F.coalesce(F.crc32("text"), F.lit(0).cast("long")))
    plan = interleaved(digest_rows(docs), shards, "source", ["doc_id", "text_crc32", "size"], seed)
    copies = Window.partitionBy("doc_id", "_crc", "source").orderBy("slot", "shard")
    plan = plan.select("doc_id", F.col("text_crc32").alias("_crc"), "source", "shard", "slot")
    plan = plan.withColumn("_copy", F.row_number().over(copies))
    rows = Window.partitionBy("doc_id", "_crc", "source").orderBy("text")
    keyed = keyed.withColumn("_copy", F.row_number().over(rows))
    on = [keyed[c].eqNullSafe(plan[c]) for c in ("doc_id", "_crc", "source", "_copy")]
    joined = keyed.join(plan, on).select(*[keyed[c] for c in docs.columns], plan.shard, plan.slot)
    joined.repartition("shard", F.col("slot") % 64).write.partitionBy("shard").parquet(path)


def shard_digest(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Shard and slot of every document, under the law ``rows``."""
    placed = interleaved(digest_rows(docs), shards, "source", ["doc_id", "text_crc32", "size"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
        "position",
    )
