"""The quarantine job: messages that are no complete readings, with their text and fault."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sensorstream.functions.codec import decode
from sensorstream.operators.quality import quarantined
from sensorstream.streaming.runner import start_batches
from sensorstream.streaming.sinks import batch_store

QUARANTINED = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("log_time", T.TimestampType()),
        T.StructField("raw", T.StringType()),
        T.StructField("missing", T.StringType()),
    ]
)


def quarantine(messages: DataFrame, *, source_tz: str | None = None) -> DataFrame:
    """The messages that the heat job passes over, batch or streaming."""
    decoded = decode(messages, fields=("id", "timestamp", "value"), source_tz=source_tz)
    return quarantined(decoded).select(*QUARANTINED.names)


def start_quarantine(
    messages: DataFrame,
    path: str,
    *,
    checkpoint: str,
    name: str = "quarantine",
    every: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Run :func:`quarantine` on a stream into a table."""
    return start_batches(
        quarantine(messages),
        batch_store(path, files_per_batch=files_per_batch),
        name=name,
        checkpoint=checkpoint,
        every=every,
    )
