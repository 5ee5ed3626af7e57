"""Heat statistics over stored collections, as a check on and a repair of the stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from sensorstream.operators.quality import good_readings
from sensorstream.operators.windows import overheat_stats
from sensorstream.sources.collections import find


def recompute(
    spark: SparkSession,
    store: str,
    collection: str = "temperature",
    where: Column | None = None,
    **stats,
) -> DataFrame:
    """:func:`overheat_stats` of a whole stored collection."""
    return overheat_stats(good_readings(find(spark, store, collection, where)), **stats)
