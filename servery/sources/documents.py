"""Landed documents and lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from servery.schemas import NAME_LIST


def read_document_lines(spark: SparkSession, path: str) -> DataFrame:
    """Many documents to a file, one on each line: ``document_id`` is the file, ``text`` the
    line. Files are split among tasks."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("document_id"), F.col("value").alias("text")
    )


def read_text_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: its path as ``document_id`` and its whole text as ``text``."""
    files = spark.read.text(path, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("document_id"), F.col("value").alias("text")
    )


def read_list_texts(spark: SparkSession, *paths: str) -> DataFrame:
    """Numbered lists as lines in column ``text``, all paths together."""
    return spark.read.text(list(paths)).select(F.col("value").alias("text"))


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    """Names of files that hold one ``{"restaurant_names": [...]}`` object each."""
    lists = spark.read.schema(NAME_LIST).json(path, multiLine=True)
    return lists.select(F.explode("restaurant_names").alias("restaurant_name"))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """Names as :func:`~servery.sinks.messages.write_names` writes them, one object on a line."""
    return spark.read.schema("restaurant_name string").json(path)
