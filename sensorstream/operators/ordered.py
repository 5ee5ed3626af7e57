"""Window functions over the ordered rows of a window, one slice of rows at a time.

Measures (:mod:`~sensorstream.functions.aggregates`) fold and merge in any order. A function that needs a
window's rows in sequence, such as the longest run of hot readings, cannot be merged. Here the rows are
shuffled once by key and time block, spread to their windows behind that exchange, and sorted by window
and time with Spark's spilling sort; the function is handed each window as slices in that
order and keeps only its own state. So a window may have any number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.functions.intervals import micros
from sensorstream.operators.windows import WINDOWS_PER_BLOCK, window_tasks
from sensorstream.session import require_utc, ship_library


@dataclass(frozen=True)
class OrderedFunction:
    """``add`` takes the state and the next rows (arrays by column name), and gives the state after them."""

    start: Callable[[], Any]
    add: Callable[[Any, dict[str, np.ndarray]], Any]
    result: Callable[[Any], tuple]
    #: Names and types of the result, as DDL.
    schema: str
    #: Columns that ``add`` is given.
    columns: tuple[str, ...]


def longest_run(value: str, above: float, name: str = "longest_run") -> OrderedFunction:
    """Most rows in a row with a value above the threshold; NaN and null end a run."""

    def add(state: tuple[int, int], rows: dict[str, np.ndarray]) -> tuple[int, int]:
        now, most = state
        breaks = np.flatnonzero(~(rows[value].astype(np.float64) > above))
        if not len(breaks):
            return now + len(rows[value]), most
        inner = int(np.diff(breaks).max(initial=1)) - 1
        return len(rows[value]) - 1 - int(breaks[-1]), max(most, now + int(breaks[0]), inner)

    return OrderedFunction(lambda: (0, 0), add, lambda s: (max(s),), f"{name} bigint", (value,))


def ordered_windows(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    size: str,
    slide: str,
    function: OrderedFunction,
    *,
    order: Sequence[str] = (),
) -> DataFrame:
    """One row per key and non-empty sliding window: keys, window bounds, the function's result.

    Rows come by ``time`` and then by the columns ``order``. Windows are those of
    :func:`~sensorstream.operators.windows.sliding_windows`; batch frames only.
    """
    require_utc(df.sparkSession)
    if df.isStreaming:
        raise ValueError("ordered window functions are for batch frames")
    ship_library(df.sparkSession)
    size_us, slide_us = micros(size), micros(slide)
    block_us = slide_us * math.ceil(WINDOWS_PER_BLOCK * max(size_us, slide_us) / slide_us)

    def floor_to(column: Column, unit: int) -> Column:
        return column - F.pmod(column, F.lit(unit))

    at = F.col("__at")
    last, first = floor_to(at, slide_us), floor_to(at - F.lit(size_us), slide_us) + F.lit(slide_us)
    needed = list(dict.fromkeys([*keys, *function.columns, *order]))
    rows = df.where(F.col(time).isNotNull()).select(*needed, F.unix_micros(F.col(time).cast("timestamp")).alias("__at"))
    # Between windows, where the slide is longer than the size, there is none.
    rows = rows.where(first <= last)
    blocks = F.sequence(floor_to(first, block_us), floor_to(last, block_us), F.lit(block_us))
    dealt = rows.withColumn("__block", F.explode(blocks))
    dealt = dealt.repartition(window_tasks(rows, size_us, slide_us), *keys, "__block")
    block = F.col("__block")
    starts = F.sequence(
        F.greatest(first, block), F.least(last, block + F.lit(block_us - slide_us)), F.lit(slide_us)
    )
    spread = dealt.withColumn("__start", F.explode(starts)).drop("__block")
    spread = spread.sortWithinPartitions(*keys, "__start", "__at", *order)
    group = [*keys, "__start"]
    out = spread.select(*group).schema
    for field in T.StructType.fromDDL(function.schema):
        out = out.add(field)
    found = spread.mapInArrow(lambda batches: _fold(batches, group, function, out), out)
    kind = df.schema[time].dataType
    bound = "timestamp_ntz" if isinstance(kind, T.TimestampNTZType) else "timestamp"
    return found.select(
        *keys,
        F.timestamp_micros("__start").cast(bound).alias("window_start"),
        F.timestamp_micros(F.col("__start") + F.lit(size_us)).cast(bound).alias("window_end"),
        *T.StructType.fromDDL(function.schema).names,
    )


def _fold(
    batches: Iterator[pa.RecordBatch], group: list[str], function: OrderedFunction, out: T.StructType
) -> Iterator[pa.RecordBatch]:
    held: pa.RecordBatch | None = None  # one row: the group that may go on
    state: Any = None
    results = [f.name for f in out][len(group) :]

    def rows_of(keys: list[pa.RecordBatch], states: list[Any]) -> pa.RecordBatch:
        table = pa.Table.from_batches(keys).combine_chunks()
        columns = [c.combine_chunks() for c in table.columns]
        values = zip(*(function.result(s) for s in states))
        return pa.RecordBatch.from_arrays([*columns, *(pa.array(list(v)) for v in values)], names=[*group, *results])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.select(group)
        bounds = [0, *(np.flatnonzero(_changes(keys)) + 1).tolist(), batch.num_rows]
        arrays = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in function.columns}
        done_keys, done = [], []
        for begin, end in zip(bounds[:-1], bounds[1:]):
            key = keys.slice(begin, 1)
            if held is None or begin or not key.equals(held):
                if held is not None:
                    done_keys.append(held)
                    done.append(state)
                held, state = key, function.start()
            state = function.add(state, {c: a[begin:end] for c, a in arrays.items()})
        if done:
            yield rows_of(done_keys, done)
    if held is not None:
        yield rows_of([held], [state])


def _changes(keys: pa.RecordBatch) -> np.ndarray:
    """Whether each row's keys differ from those of the row before; nulls are equal."""
    changed = np.zeros(keys.num_rows - 1, bool)
    for column in keys.columns:
        before, after = column.slice(0, len(column) - 1), column.slice(1)
        differ = pc.fill_null(pc.not_equal(before, after), False)
        nulls = pc.not_equal(pc.is_null(before), pc.is_null(after))
        changed |= pc.or_(differ, nulls).to_numpy(zero_copy_only=False)
    return changed
