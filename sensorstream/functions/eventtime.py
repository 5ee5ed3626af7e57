"""Event time: assignment from reading fields and watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorstream.schemas import OUT_OF_ORDERNESS, TIMESTAMP_FORMAT


def parse_event_time(text: Column, source_tz: str | None = None) -> Column:
    """Reading timestamp text as an instant; NULL where the text does not parse.

    The text has no zone. It is taken as UTC, or as local time in ``source_tz``.
    """
    parsed = F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT))
    return F.to_utc_timestamp(parsed, source_tz) if source_tz else parsed


def event_time_from_millis(ms: Column) -> Column:
    """Epoch milliseconds as an instant."""
    return F.timestamp_millis(ms.cast("bigint"))


def with_event_time(
    df: DataFrame,
    event_time: Column,
    delay: str | None = OUT_OF_ORDERNESS,
    name: str = "event_time",
) -> DataFrame:
    """Add the event-time column and, unless ``delay`` is None, its watermark.

    ``delay="0 seconds"`` suits sources whose timestamps only ascend.
    """
    timed = df.withColumn(name, event_time)
    return timed if delay is None else timed.withWatermark(name, delay)
