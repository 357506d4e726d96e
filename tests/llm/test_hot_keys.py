"""Joins on a key that half of all rows have are split. Broadcasts are off."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from servery.llm import lines, secrets, simhash

SKEW = "SortMergeJoin(skew=true)"


@pytest.fixture
def no_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def executed(frame) -> str:
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def hot(spark, rows=40_000):
    """Half of the rows have number 0, the others one of their own."""
    number = F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id"))
    return spark.range(rows).repartition(8).select("id", number.alias("k"))


def test_secrets_that_are_everywhere(spark, no_broadcast):
    spans = hot(spark).select(F.col("id").alias("doc_id"), F.concat(F.lit("secret"), "k").alias("secret"), (F.col("id") % 99).alias("source"))
    judged = secrets.judged(spans, "doc_id", "source")
    assert SKEW in executed(judged)
    assert judged.where("example").count() == 20_000


def test_grams_that_are_everywhere(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(lines, "stored", lambda df, label: df)
    index = hot(spark).select(
        F.col("id").alias("doc_id"), F.col("id").alias("_text"), F.array(F.struct(F.col("k").alias("g"), F.lit(0).alias("pos"))).alias("f")
    )
    found = lines.repeats(index)
    assert SKEW in executed(found)
    assert found.count() == 19_999


def test_groups_of_half_of_all_fingerprints(spark, no_broadcast, monkeypatch):
    plans = []

    def kept(df, label):
        path = f"{simhash_folder(spark)}/{label}-{len(plans)}"
        df.write.mode("overwrite").parquet(path)
        plans.append(executed(df))
        return spark.read.schema(df.schema).parquet(path)

    monkeypatch.setattr(simhash, "stored", kept)
    edges = hot(spark).where("id > 0").select(F.col("id").alias("a"), F.when(F.col("k") == 0, 0).otherwise(F.col("id") - 1).cast("long").alias("b"))
    roots = simhash.components(edges)
    assert roots.where("root = 0").count() == 39_999
    assert any(SKEW in p for p in plans)


def simhash_folder(spark) -> str:
    import uuid

    from servery.llm.common import shared_folder

    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"
