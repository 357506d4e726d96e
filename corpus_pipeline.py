"""The corpus pipeline: from ``documents`` to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet to the
shared folder and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servery.llm import contamination, lines, packing, simhash, toxicity
from servery.llm.common import stored, table, unused

#: Documents whose worst passage is toxic with at least this probability go.
TOXIC = 0.3


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not toxic."""
    model = toxicity.fit_on(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "score")
    return toxicity.scored(docs, model, column=score).where(F.col(score) < TOXIC).drop(score)


def novel_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without runs of lines that an earlier one has; those of which nothing is
    left go."""
    return lines.deduplicated(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, as operator 4 links them."""
    return simhash.deduplicated(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a passage of the benchmark."""
    return contamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.packing_digest(docs)


STAGES = [
    ("toxicity", clean),
    ("line dedup", novel_lines),
    ("near dedup", distinct),
    ("decontamination", uncontaminated),
    ("packing", sequences),
]

#: Fitting, hashing and tokenizing have no SQL; tests hold the pipeline against its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
