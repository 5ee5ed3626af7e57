"""Complete readings versus messages that must be set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorstream.functions.codec import REQUIRED, is_reading


def good_readings(decoded: DataFrame) -> DataFrame:
    """Decoded rows with a sensor, a time and a value."""
    return decoded.where(is_reading())


def missing_fields() -> Column:
    """Names of the required fields that are missing or unusable; empty for a reading."""
    return F.concat_ws(",", *[F.when(F.col(name).isNull(), F.lit(name)) for name in REQUIRED])


def quarantined(decoded: DataFrame) -> DataFrame:
    """The other rows, with the names of the fields that are at fault."""
    return decoded.where(~is_reading()).withColumn("missing", missing_fields())
