"""Regular series per sensor: gap-free grids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstream.functions.intervals import micros

STEPS_PER_BLOCK = 3_600


def series_grid(
    sensors: DataFrame,
    *,
    start: str = "start",
    end: str = "end",
    step: str = "1 second",
    name: str = "event_time",
) -> DataFrame:
    """Every sensor row repeated for each step from ``start`` to ``end`` inclusive.

    Sensors first spread into blocks of steps, which are shuffled, and only then
    into steps, so that no array and no task holds a whole long series.
    """
    step_us = micros(step)
    block_us = step_us * STEPS_PER_BLOCK
    kept = [c for c in sensors.columns if c not in (start, end)]
    kind = sensors.schema[start].dataType.simpleString()
    first = F.unix_micros(F.col(start).cast("timestamp"))
    last = F.unix_micros(F.col(end).cast("timestamp"))
    block_starts = F.when(first <= last, F.sequence(first, last, F.lit(block_us)))
    blocks = (
        sensors.withColumn("last_us", last)
        .withColumn("block_us", F.explode(block_starts))
        .select(*kept, "last_us", "block_us")
        .repartition(*kept, "block_us")
    )
    until = F.least(F.col("last_us"), F.col("block_us") + F.lit(block_us - step_us))
    return blocks.select(
        *kept, F.explode(F.sequence(F.col("block_us"), until, F.lit(step_us))).alias("at_us")
    ).select(*kept, F.timestamp_micros("at_us").cast(kind).alias(name))
