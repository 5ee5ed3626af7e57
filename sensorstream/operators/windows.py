"""Keyed sliding windows.

Windows start at multiples of the slide, counted from the epoch, and are
half-open. A row belongs to every window that covers it; windows without rows do
not exist. The same function serves batch and streaming frames.

Batch plan ("panes"): rows fold into panes per key (a pane is the greatest common
part of size and slide), are shuffled once by (key, time block) and spread to
their windows only behind that exchange. So the shuffles carry about one row per
pane instead of one per (row, window), a hot key spreads over its time blocks,
and a hot pane is folded map-side first. The rows are counted beforehand, for the
number of tasks: Spark would merge them by the bytes of the panes, and their windows are
ten times as many. Streaming plan ("direct"): `F.window`,
whose state Spark evicts by watermark.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.functions.aggregates import (
    Measure,
    all_above,
    count_rows,
    count_values,
    edge_reading,
    rounded_mean,
)
from sensorstream.functions.intervals import micros
from sensorstream.schemas import (
    CONSTANT_THRESHOLD,
    MEAN_THRESHOLD,
    TIMESTAMP_FORMAT,
    WINDOW_SIZE,
    WINDOW_SLIDE,
)
from sensorstream.session import require_utc
from sensorstream.streaming.state import open_states

WINDOWS_PER_BLOCK = 10
#: Windows for one task, which holds them all; some 300 bytes each.
WINDOWS_PER_TASK = 1_000_000
#: Windows of a whole stream for one partition of its state. A task keeps a batch's windows of its partition in memory three
#: times over, some 600 bytes each.
WINDOWS_PER_STATE = 2_000_000


def sliding_windows(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    size: str,
    slide: str,
    measures: Sequence[Measure],
    *,
    plan: str = "auto",
    open_in: str | None = None,
) -> DataFrame:
    """One row per key and non-empty window: keys, window bounds, measures.

    ``open_in`` names the checkpoint of a stopped stream of the same windows. The rows are
    not read then; the result is the windows that stream still held open.
    """
    require_utc(df.sparkSession)
    if open_in is not None:
        states = open_states(df.sparkSession, open_in, list(keys), measures)
        return _results(states, keys, measures)
    if plan == "auto":
        plan = "direct" if df.isStreaming else "panes"
    if plan not in ("direct", "panes"):
        raise ValueError(f"no such window plan: {plan}")
    if plan == "panes" and df.isStreaming:
        raise ValueError("the pane plan is for batch frames")
    build = _direct if plan == "direct" else _panes
    return _results(build(df, list(keys), time, size, slide, measures), keys, measures)


def _results(states: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    return states.select(
        *keys, "window_start", "window_end", *[m.result.alias(m.name) for m in measures]
    )


def _fold(measures: Sequence[Measure]) -> list[Column]:
    """The states of all measures; measures may share one of the same name."""
    states = {state: agg for m in measures for state, agg in m.fold.items()}
    return [agg.alias(state) for state, agg in states.items()]


def _merge(measures: Sequence[Measure]) -> list[Column]:
    states = {state: agg for m in measures for state, agg in m.merge.items()}
    return [agg.alias(state) for state, agg in states.items()]


def window_tasks(rows: DataFrame, size_us: int, slide_us: int) -> int:
    """Tasks among which the windows of ``rows`` are dealt, so that none holds more than its share. Counts the rows."""
    windows = rows.count() * math.ceil(size_us / slide_us)
    return max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(windows / WINDOWS_PER_TASK))


def state_partitions(rows: int, size: str, slide: str) -> int:
    """Partitions for the state of a stream of so many rows, so that none holds more than its share of windows."""
    return max(1, math.ceil(rows * math.ceil(micros(size) / micros(slide)) / WINDOWS_PER_STATE))


def _direct(df, keys, time, size, slide, measures) -> DataFrame:
    window = F.window(time, size, slide).alias("__window")  # a key may be called window
    grouped = df.groupBy(*keys, window).agg(*_fold(measures))
    return (
        grouped.withColumn("window_start", F.col("__window.start"))
        .withColumn("window_end", F.col("__window.end"))
        .drop("__window")
    )


def _panes(df, keys, time, size, slide, measures) -> DataFrame:
    size_us, slide_us = micros(size), micros(slide)
    pane_us = math.gcd(size_us, slide_us)
    block_us = slide_us * math.ceil(WINDOWS_PER_BLOCK * max(size_us, slide_us) / slide_us)

    def floor_to(column: Column, unit: int) -> Column:
        return column - F.pmod(column, F.lit(unit))

    # Starts of the first and the last window that hold a pane. They are computed
    # on both sides of the exchange rather than shuffled.
    pane = F.col("__pane")
    last_start = floor_to(pane, slide_us)
    first_start = floor_to(pane + F.lit(pane_us - size_us + slide_us - 1), slide_us)
    if pane_us == slide_us:
        last_start, first_start = pane, pane + F.lit(slide_us - size_us)

    instant = F.unix_micros(F.col(time).cast("timestamp"))
    timed = df.where(F.col(time).isNotNull())
    tasks = window_tasks(timed, size_us, slide_us)
    panes = (
        timed.withColumn("__pane", floor_to(instant, pane_us))
        .groupBy(*keys, "__pane")
        .agg(*_fold(measures))
    )
    last_block = floor_to(last_start, block_us)
    if size_us < slide_us:  # some panes lie between windows
        panes = panes.where(first_start <= last_start)
        last_block = floor_to(F.greatest(first_start, last_start), block_us)
    # A window lives in the block that holds its start, so a pane near the start
    # of a block also goes to the block before.
    own_blocks = F.sequence(floor_to(first_start, block_us), last_block, F.lit(block_us))
    blocks = panes.withColumn("__block", F.explode(own_blocks)).repartition(tasks, *keys, "__block")
    # Grouping by (keys, block, start) needs no exchange beyond the one by (keys, block).
    block = F.col("__block")
    own_starts = F.sequence(
        F.greatest(first_start, block),
        F.least(last_start, block + F.lit(block_us - slide_us)),
        F.lit(slide_us),
    )
    windows = (
        blocks.withColumn("__start", F.explode(own_starts))
        .groupBy(*keys, "__block", "__start")
        .agg(*_merge(measures))
    )
    kind = df.schema[time].dataType
    bound_type = "timestamp_ntz" if isinstance(kind, T.TimestampNTZType) else "timestamp"
    return windows.withColumn(
        "window_start", F.timestamp_micros("__start").cast(bound_type)
    ).withColumn("window_end", F.timestamp_micros(F.col("__start") + F.lit(size_us)).cast(bound_type))


def overheat_stats(
    readings: DataFrame,
    *,
    key: str = "sensor_id",
    time: str = "event_time",
    value: str = "value",
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    mean_threshold: float = MEAN_THRESHOLD,
    constant_threshold: float = CONSTANT_THRESHOLD,
    min_count: int = 1,
    arrival: str | Sequence[str] | None = None,
    decimals: int | None = None,
    mean_type: str = "float",
    reading_time: str | None = None,
    plan: str = "auto",
    open_in: str | None = None,
) -> DataFrame:
    """Heat statistics per sensor and sliding window, all windows.

    Columns: key, window_start, window_end, mean_temp, overheat_constant,
    first_ts, last_ts, n, hot. A window is hot if its rounded mean exceeds
    ``mean_threshold`` or all of its values exceed ``constant_threshold``; the
    comparison uses the rounded double, before the cast to ``mean_type``.
    ``arrival`` names the columns that give order of arrival for first_ts and
    last_ts; without it they are the earliest and the latest reading time. That time
    is ``reading_time``, where windows go by another clock than the readings' own.
    ``open_in`` gives the windows left open by a stopped stream, see :func:`sliding_windows`.
    """
    complete = readings.where(F.col(value).isNotNull())
    measures = [
        rounded_mean(value, "mean_temp", decimals=decimals),
        all_above(value, constant_threshold, "overheat_constant"),
        edge_reading(reading_time or time, "first_ts", last=False, order=arrival),
        edge_reading(reading_time or time, "last_ts", last=True, order=arrival),
        count_values(value, "n"),
    ]
    windows = sliding_windows(complete, [key], time, size, slide, measures, plan=plan, open_in=open_in)
    mean = F.col("mean_temp")
    hot = ((mean > F.lit(mean_threshold)) & ~F.isnan(mean)) | F.col("overheat_constant")
    if min_count > 1:
        hot = hot & (F.col("n") >= F.lit(min_count))
    return windows.select(
        key,
        "window_start",
        "window_end",
        mean.cast(mean_type).alias("mean_temp"),
        "overheat_constant",
        F.date_format("first_ts", TIMESTAMP_FORMAT).alias("first_ts"),
        F.date_format("last_ts", TIMESTAMP_FORMAT).alias("last_ts"),
        "n",
        hot.alias("hot"),
    )


def overheat_alerts(stats: DataFrame) -> DataFrame:
    """Only the hot windows of :func:`overheat_stats`."""
    return stats.where("hot")


def window_counts(
    df: DataFrame,
    *,
    key: str = "k",
    time: str = "event_time",
    size: str = "5 milliseconds",
    slide: str = "2 milliseconds",
    plan: str = "auto",
    open_in: str | None = None,
) -> DataFrame:
    """Rows per key and sliding window, bounds as epoch milliseconds."""
    counted = sliding_windows(df, [key], time, size, slide, [count_rows("n")], plan=plan, open_in=open_in)
    return counted.select(
        key,
        F.unix_millis(F.col("window_start").cast("timestamp")).alias("window_start_ms"),
        F.unix_millis(F.col("window_end").cast("timestamp")).alias("window_end_ms"),
        "n",
    )
