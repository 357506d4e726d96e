"""Documents as they landed, against the schema that is read out of them.

Reading by a declared schema drops what it does not name, and makes NULL what is of another kind.
Parsed as variants, documents keep both, and can tell which fields were left behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from servery.functions.payload import with_parsed

PROBLEMS = "array<struct<field: string, problem: string, value: string>>"


def _none() -> Column:
    return F.array().cast(PROBLEMS)


def _problem(field: Column, problem: str, value: Column) -> Column:
    return F.struct(field.alias("field"), F.lit(problem).alias("problem"), F.to_json(value).alias("value"))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def _children(node: Column, members: Column, declared: StructType, path: str) -> Column:
    """The problems of an object's fields."""
    prefix = f"{path}." if path else ""
    unknown = F.transform(
        F.filter(F.map_entries(members), lambda e: ~e["key"].isin(declared.names)),
        lambda e: _problem(F.concat(F.lit(prefix), e["key"]), "unknown", e["value"]),
    )
    known = [
        problems(F.try_variant_get(node, F.lit(f"$['{field.name}']"), "variant"), field.dataType, prefix + field.name)
        for field in declared.fields
    ]
    return F.concat(unknown.cast(PROBLEMS), *known)


def _left(node: Column, declared: DataType, path: str) -> Column:
    """The problems of a value that is there. Only its own kind is looked at, not all that is in it."""
    mistyped = F.array(_problem(F.lit(path), "mistyped", node)).cast(PROBLEMS)
    members, items = node.try_cast("map<string, variant>"), node.try_cast("array<variant>")
    if isinstance(declared, StructType):
        return _bound(members, lambda m: F.when(m.isNotNull(), _children(node, m, declared, path)).otherwise(mistyped))
    if isinstance(declared, ArrayType):

        def inner(found: Column) -> Column:
            return F.flatten(F.transform(found, lambda item: problems(item, declared.elementType, path)))

        return _bound(items, lambda found: F.when(found.isNotNull(), inner(found)).otherwise(mistyped))
    return F.when(members.isNotNull() | items.isNotNull(), mistyped).otherwise(_none())


def problems(node: Column, declared: DataType, path: str = "") -> Column:
    """``field``, ``problem`` and the JSON ``value`` of all that the declared type leaves behind:
    fields it does not have (``unknown``), and values that are an object or array where it has
    something else, or the other way round (``mistyped``). What is missing, or null, is none."""
    return _bound(
        node, lambda n: F.when(n.isNull() | F.is_variant_null(n), _none()).otherwise(_left(n, declared, path))
    )


def left_behind(texts: DataFrame, schema: StructType, text: str = "text") -> DataFrame:
    """A row for each problem of each text, with the text's other columns. Texts that are no JSON
    have none: they are set apart as malformed when they are parsed."""
    parsed = with_parsed(texts, F.try_parse_json(F.col(text)), "_variant")
    others = [name for name in texts.columns if name != text]
    found = parsed.select(*others, F.explode(problems(F.col("_variant"), schema)).alias("_problem"))
    return found.select(*others, "_problem.*")
