"""Readings to and from JSON messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.functions.eventtime import parse_event_time
from sensorstream.schemas import READING

CORRUPT = "_corrupt_record"
REQUIRED = ("sensor_id", "event_time", "value")


def is_reading() -> Column:
    """True for decoded rows that carry everything the window jobs need."""
    checks = [F.col(name).isNotNull() for name in REQUIRED]
    return checks[0] & checks[1] & checks[2]


def decode(
    messages: DataFrame,
    *,
    fields: Sequence[str] = tuple(READING.names),
    corrupt: bool = False,
    mode: str = "PERMISSIVE",
    source_tz: str | None = None,
) -> DataFrame:
    """Parse each message once, before any window sees it.

    The message text stays available as ``raw`` and the log's own time as
    ``log_time``; the reading's ``fields`` become columns, ``id`` as ``sensor_id``,
    and ``timestamp`` gives ``event_time``. Jobs name only the fields they need.
    ``corrupt=True`` adds the parser's ``_corrupt_record``; ``mode="FAILFAST"``
    stops the job at the first message that is not a complete reading.
    """
    missing = {"id", "timestamp", "value"} - set(fields)
    if missing:
        raise ValueError(f"a reading needs {sorted(missing)}")
    schema = T.StructType([f for f in READING.fields if f.name in fields])
    options = {
        "allowSingleQuotes": "false",  # not JSON, though Spark would take it
        "mode": "PERMISSIVE",  # a field of a wrong type is null, the others stay
    }
    if corrupt:
        schema = schema.add(CORRUPT, T.StringType())
        options["columnNameOfCorruptRecord"] = CORRUPT
    if mode != "PERMISSIVE":
        options["mode"] = mode
    renamed = {"value": "raw", "timestamp": "log_time"}
    envelope = [F.col(c).alias(renamed.get(c, c)) for c in messages.columns]
    names = ["sensor_id" if n == "id" else n for n in schema.names]
    # As generators, both parses are evaluated once: Catalyst would copy plain
    # expressions into every filter that it pushes below them.
    reading = F.inline(F.array(F.from_json("value", schema, options)))
    event_time = parse_event_time(F.col("timestamp"), source_tz)
    decoded = messages.select(*envelope, reading.alias(*names)).select(
        "*", F.explode(F.array(event_time)).alias("event_time")
    )
    if mode == "FAILFAST":
        incomplete = F.raise_error(F.concat(F.lit("not a complete reading: "), F.col("raw")))
        decoded = decoded.withColumn(
            "sensor_id", F.when(is_reading(), F.col("sensor_id")).otherwise(incomplete.cast("int"))
        )
    return decoded


def encode(
    readings: DataFrame, *, integral_values: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """Readings as ``(key, value)`` messages: key is the id, value compact JSON.

    Fields keep the record's order. ``integral_values`` writes 95.0 as ``95``,
    the way sensors send it. ``keep`` names columns to carry along.
    """
    head = [F.col(f).cast(READING[f].dataType).alias(f) for f in READING.names if f != "value"]
    value = F.col("value").cast("double")
    text = F.to_json(F.struct(*head, value.alias("value")))
    if integral_values:
        whole = F.to_json(F.struct(*head, value.cast("bigint").alias("value")))
        # Doubles beyond 2^53 no longer count single units.
        fits = (value == F.floor(value)) & (F.abs(value) <= F.lit(float(2**53)))
        text = F.when(fits, whole).otherwise(text)
    key = F.col("id").cast("string")
    return readings.select(key.alias("key"), text.alias("value"), *keep)
