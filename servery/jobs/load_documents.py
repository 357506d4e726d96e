"""Loads landed user profiles and restaurant texts into the stored tables.

    spark-submit servery/jobs/load_documents.py --tables /shared/tables \\
        --users /landing/users --restaurants /landing/restaurants --rejects /shared/rejects

Ids go on from the largest stored ones. Texts without a usable document, and rows whose key is
taken, are written to the rejects folder.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from servery.operators.documents import load_restaurants, load_users, parse_restaurants, parse_users
from servery.operators.ids import next_id
from servery.operators.quality import check_documents, quarantined, usable
from servery.schemas import TABLES
from servery.session import build_session
from servery.sinks.tables import append_new, create_tables
from servery.sources.documents import read_document_lines, read_text_documents
from servery.sources.tables import scan_table

USER_REQUIRED = ["name", "login.username"]
REQUIRED = ["restaurant_name", "address", "foods", "drinks", "desserts"]


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Load landed documents")
    parser.add_argument("--tables", required=True, help="folder of the stored tables")
    parser.add_argument("--users", help="folder of user profile documents")
    parser.add_argument("--restaurants", help="folder of restaurant texts")
    parser.add_argument("--rejects", required=True, help="folder of what could not be loaded")
    parser.add_argument("--lines", action="store_true", help="one document on each line of a file")
    parser.add_argument("--shuffle-bytes", type=int, help="of the largest shuffle")
    return parser.parse_args(argv)


class Loader:
    def __init__(self, spark: SparkSession, tables: str, rejects: str, lines: bool = False):
        self.spark, self.rejects, self.lines = spark, rejects, lines
        self.paths = create_tables(spark, tables)

    def stored(self, table: str) -> DataFrame:
        return scan_table(self.spark, self.paths[table], TABLES[table][0])

    def first_free(self, table: str) -> int:
        """Fixed before anything is appended, so that tables loaded together agree on it."""
        key = TABLES[table][1]
        return self.spark.range(1).select(next_id(self.stored(table), key)).first()[0]

    def append(self, table: str, rows: DataFrame) -> None:
        schema, key = TABLES[table]
        append = append_new(rows, self.paths[table], schema, key)
        append.rejected.write.mode("append").parquet(f"{self.rejects}/{table}")
        append.close()

    def reject(self, kind: str, checked: DataFrame) -> None:
        bad = quarantined(checked).select("document_id", "text", "reason")
        bad.write.mode("append").parquet(f"{self.rejects}/{kind}")

    def users(self, folder: str) -> None:
        texts = (read_document_lines if self.lines else read_text_documents)(self.spark, folder)
        checked = check_documents(parse_users(texts), USER_REQUIRED)
        self.reject("user_documents", checked)
        tables = load_users(
            usable(checked).select("document.*"),
            self.first_free("users"),
            self.first_free("address"),
        )
        self.append("address", tables.address)
        self.append("users", tables.users)

    def restaurants(self, folder: str) -> None:
        texts = (read_document_lines if self.lines else read_text_documents)(self.spark, folder)
        checked = check_documents(parse_restaurants(texts), REQUIRED)
        self.reject("documents", checked)
        tables = load_restaurants(
            usable(checked),
            None,
            self.first_free("restaurants"),
            self.first_free("address"),
            self.first_free("menu_items"),
        )
        self.append("address", tables.address)
        self.append("restaurants", tables.restaurants)
        self.append("menu_items", tables.menu_items)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    loader = Loader(
        build_session("load-documents", shuffle_bytes=args.shuffle_bytes), args.tables, args.rejects, args.lines
    )
    if args.users:
        loader.users(args.users)
    if args.restaurants:
        loader.restaurants(args.restaurants)


if __name__ == "__main__":
    main()
