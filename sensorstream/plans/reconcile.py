"""Where two tables that should hold the same rows do not, such as a stream's store and a recomputation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_digests(rows: DataFrame, groups: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Number and two hash sums of the rows of each group; equal whatever the rows' order, and folded map-side."""
    seen = F.struct(*[F.col(c) for c in columns])
    # Null and NaN as text, so that they count as values.
    text = F.to_json(seen, {"ignoreNullFields": "false"})
    return rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(text).cast("decimal(20,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit(1), text)).alias("mixed"),
    )


def reconcile(
    left: DataFrame, right: DataFrame, *, groups: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Rows that the two tables do not hold equally often: ``columns``, ``n_left``, ``n_right``.

    The tables are first compared by one digest for each group (such as day and sensor). Only the rows of groups that
    differ are compared themselves. Nulls are equal to each other. Equal tables give an empty one.
    """
    columns = list(columns or left.columns)
    a, b = (group_digests(t, groups, columns).alias(name) for t, name in ((left, "a"), (right, "b")))
    sums = ("n", "total", "mixed")
    same = _all(F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in sums)
    at = _all(F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}")) for g in groups)
    keys = [F.when(F.col("a.n").isNull(), F.col(f"b.{g}")).otherwise(F.col(f"a.{g}")).alias(g) for g in groups]
    differ = a.join(b, at, "full").where(~same).select(*keys).alias("differ")

    def suspects(rows: DataFrame, mine: int, other: int) -> DataFrame:
        on = _all(F.col(f"rows.{g}").eqNullSafe(F.col(f"differ.{g}")) for g in groups)
        return (
            rows.alias("rows")
            .join(differ, on, "left_semi")
            .select(*columns, F.lit(mine).alias("n_left"), F.lit(other).alias("n_right"))
        )

    both = suspects(left, 1, 0).unionByName(suspects(right, 0, 1))
    counted = both.groupBy(*columns).agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right"))
    return counted.where(F.col("n_left") != F.col("n_right"))


def _all(conditions) -> Column:
    return reduce(lambda x, y: x & y, conditions)
