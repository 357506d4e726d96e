"""Text of documents and lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, " +", " ")


def outermost_json(text: Column) -> Column:
    """From the first ``{`` to the last ``}``; NULL when there is no such span.

    Tied to the start of the text, the pattern is tried once; on its own, ``{.*}`` would scan
    the rest of the text again for every ``{``.
    """
    span = F.regexp_extract(text, r"(?s)\A[^{]*+(\{.*\})", 1)
    return F.nullif(span, F.lit(""))


def document_json(text: Column) -> Column:
    return collapse_spaces(outermost_json(text))


def parse_document(json_text: Column, schema: StructType) -> Column:
    """Struct of exactly one JSON object, else NULL.

    ``from_json`` stops after the first object and ignores what follows. Read as the only
    element of an array, trailing text and a second object are both seen.
    """
    wrapped = F.concat(F.lit("["), json_text, F.lit("]"))
    parsed = F.array(F.from_json(wrapped, ArrayType(schema)))
    single = F.filter(parsed, lambda objects: F.size(objects) == 1)
    return F.get(F.flatten(single), F.lit(0))


def text_lines(text: Column) -> Column:
    return F.split(text, "\n")


def numbered_name(line: Column) -> Column:
    """The text behind a leading ``N.``; NULL for any other line."""
    name = F.regexp_extract(line, r"^\s*\d+\.\s*(.*?)\s*$", 1)
    return F.nullif(name, F.lit(""))
