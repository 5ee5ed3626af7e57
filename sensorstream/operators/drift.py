"""Schema drift: which fields with which types messages carry, against what a reading should have.

Messages are folded to their shapes (the types of all their fields), so one pass with a partial count leaves a
row for each distinct shape; the fields are told apart there. Counts of two sets of messages add up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.schemas import READING

WHOLE, FRACTION, TEXT, TRUTH, NULL = "whole", "fraction", "text", "truth", "null"
OBJECT, ARRAY, MIXED = "object", "array", "mixed"
UNREADABLE, ABSENT = "unreadable", "absent"
# Faults of a (path, type).
UNKNOWN, WRONG_TYPE, MISSING, NO_OBJECT = "unknown field", "wrong type", "missing", "no object"

# The type names of the engine's shapes.
TYPE_NAMES = {
    "BIGINT": WHOLE,
    "DECIMAL": FRACTION,
    "DOUBLE": FRACTION,
    "FLOAT": FRACTION,
    "STRING": TEXT,
    "BOOLEAN": TRUTH,
    "VOID": NULL,
    "VARIANT": MIXED,
    "OBJECT<": OBJECT,
    "OBJECT<>": OBJECT,
    "ARRAY<": ARRAY,
}
NAME = r"`(?:[^`]|``)*`: |\w+: "
TOKENS = rf"{NAME}|OBJECT<>|OBJECT<|ARRAY<|, |>|[A-Z]+"
ELEMENT = "[]"


def shape_of(text: Column) -> Column:
    """The types of all fields of a JSON text, in the engine's notation; null if it is no JSON.

    Numbers with a fraction are one type, whatever their digits.
    """
    shape = F.schema_of_variant(F.try_parse_json(text))
    return F.regexp_replace(shape, r"(?<=^|[ <])DECIMAL\(\d+,-?\d+\)(?=[,>]|$)", "DECIMAL")


def shapes(messages: DataFrame, groups: Sequence[str] = (), *, text: str = "value") -> DataFrame:
    """Distinct shapes of the messages of each group, with their number ``n``."""
    return messages.groupBy(*groups, shape_of(F.col(text)).alias("shape")).agg(F.count(F.lit(1)).alias("n"))


def _fields(shape: Column) -> Column:
    """(path, type) of everything in a shape, the whole first: a fold over its signs that keeps the path so far."""
    names = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
    none = F.array().cast("array<string>")
    start = F.struct(none.alias("path"), F.array().cast("array<struct<path:string,type:string>>").alias("found"))

    def step(state: Column, token: Column) -> Column:
        path, found = state["path"], state["found"]
        above = F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0)))
        name = F.substr(token, F.lit(1), F.length(token) - 2)
        onward = (
            F.when(token.isin(", ", ">"), above)
            .when(token.endswith(": "), F.concat(path, F.array(name)))
            .when(token == "ARRAY<", F.concat(path, F.array(F.lit(ELEMENT))))
            .otherwise(path)
        )
        here = F.struct(
            F.array_join(path, ".").alias("path"), F.coalesce(F.try_element_at(names, token), token).alias("type")
        )
        no_type = token.isin(", ", ">") | token.endswith(": ")
        return F.struct(onward.alias("path"), F.when(no_type, found).otherwise(F.concat(found, F.array(here))).alias("found"))

    return F.aggregate(F.regexp_extract_all(shape, F.lit(TOKENS), 0), start, step)["found"]


def field_types(shapes: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Of each group the number of messages ``n`` in which ``path`` has ``type``.

    The path of the whole message is empty, steps are joined by dots, ``[]`` stands for the elements of an array, and
    names with other signs than letters, digits and ``_`` are in backquotes. An array or field whose values within one
    message differ in type is ``mixed`` and not looked into. A text that is no JSON, or
    names a field twice, counts as ``unreadable`` there, and so does a null.
    """
    unreadable = F.array(F.struct(F.lit("").alias("path"), F.lit(UNREADABLE).alias("type")))
    found = F.when(F.col("shape").isNull(), unreadable).otherwise(_fields(F.col("shape")))
    rows = shapes.select(*groups, "n", F.inline(found))
    return rows.groupBy(*groups, "path", "type").agg(F.sum("n").alias("n"))


def expected_types(schema: T.StructType = READING) -> dict[str, tuple[str, ...]]:
    """The types that a flat schema admits for its fields."""
    kinds = {T.IntegerType: (WHOLE,), T.LongType: (WHOLE,), T.DoubleType: (WHOLE, FRACTION), T.StringType: (TEXT,)}
    return {f.name: kinds[type(f.dataType)] for f in schema}


def drift(
    types: DataFrame, groups: Sequence[str] = (), *, expected: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """:func:`field_types` with the ``fault`` of each, null where all is as expected.

    Fields that messages lack are added as type ``absent``, with the number of objects that lack them.
    """
    expected = expected_types() if expected is None else expected
    admitted = F.create_map(*[x for name, kinds in expected.items() for x in (F.lit(name), F.array(*map(F.lit, kinds)))])
    whole = (F.col("path") == "") & (F.col("type") == OBJECT)
    fields = F.array(*(F.lit(name) for name in expected))
    objects = types.where(whole).select(*groups, F.explode(fields).alias("path"), "n")
    held = types.where(F.col("path").isin(list(expected))).select(*groups, "path", (-F.col("n")).alias("n"))
    lacking = objects.unionByName(held).groupBy(*groups, "path").agg(F.sum("n").alias("n")).where(F.col("n") > 0)
    every = types.unionByName(lacking.withColumn("type", F.lit(ABSENT)))
    kinds = F.try_element_at(admitted, F.col("path"))
    fault = (
        F.when(F.col("path") == "", F.when(F.col("type") != OBJECT, NO_OBJECT))
        .when(kinds.isNull(), UNKNOWN)
        .when(F.col("type") == ABSENT, MISSING)
        .when(~F.array_contains(kinds, F.col("type")), WRONG_TYPE)
    )
    return every.select(*groups, "path", "type", "n", fault.alias("fault"))
