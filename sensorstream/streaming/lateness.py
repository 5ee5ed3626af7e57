"""What happens to rows behind the watermark, and which rows those were."""

from __future__ import annotations

from contextlib import AbstractContextManager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sensorstream.functions.intervals import micros
from sensorstream.session import settings
from sensorstream.streaming.sinks import BatchWriter, batch_store, read_batches

ALLOW_MULTIPLE = "spark.sql.streaming.statefulOperator.allowMultiple"

#: One row for each batch: its watermark, and how far its source had been read.
LEDGER = T.StructType(
    [T.StructField("watermark_ms", T.LongType()), T.StructField("source_batch", T.LongType())]
)


def strict_lateness(spark: SparkSession, strict: bool = True) -> AbstractContextManager[None]:
    """Start a query inside this block to drop late rows by the current watermark.

    By default Spark drops rows by the previous batch's watermark, so windows that
    are about to close may still take a few late rows. Strict queries cannot chain
    stateful operators. The choice is recorded in the checkpoint.
    """
    return settings(spark, {ALLOW_MULTIPLE: "false"} if strict else {})


def late_rows(query: StreamingQuery) -> list[int]:
    """Dropped rows per recent batch, counted once per window they missed."""
    return [
        sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])
        for progress in query.recentProgress
    ]


def with_ledger(write: BatchWriter, path: str, checkpoint: str) -> BatchWriter:
    """A batch writer that also enters each batch in a ledger at ``path``.

    The entry is what the checkpoint says about the batch before it runs: Spark itself keeps that for the last
    hundred batches only. For streams of one file source.
    """
    enter = batch_store(path)

    def write_both(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        text = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch_id}", wholetext=True)
        lines = F.split("value", "\n")
        entry = text.select(
            F.get_json_object(lines[1], "$.batchWatermarkMs").cast("bigint").alias("watermark_ms"),
            F.get_json_object(lines[2], "$.logOffset").cast("bigint").alias("source_batch"),
        )
        enter(entry, batch_id)
        write(batch, batch_id)

    return write_both


def late_windows(
    rows: DataFrame,
    *,
    checkpoint: str,
    ledger: str,
    file: str,
    time: str,
    size: str,
    slide: str,
    strict: bool = False,
) -> DataFrame:
    """The rows of a file stream that came too late for some of their windows.

    ``rows`` is the stream's source as a batch frame with the path of each row's file in ``file``
    (``_metadata.file_path``). The result has ``missed``, the starts of the windows that had closed when the row's
    batch ran, and ``too_late``, whether those are all of its windows. ``strict`` is the rule that the stream ran under.
    """
    spark = rows.sparkSession
    entries = read_batches(spark, ledger, LEDGER)
    # A batch without new files repeats the offset of the one before it.
    ran = entries.groupBy("source_batch").agg(F.min("batch_id").alias("batch_id"))
    marks = entries.select((F.col("batch_id") + (0 if strict else 1)).alias("batch_id"), "watermark_ms")
    files = (
        spark.read.text(f"{checkpoint.rstrip('/')}/sources/0")
        .where(F.col("value").startswith("{"))
        .select(
            _plain_path(F.get_json_object("value", "$.path")).alias("__file"),
            F.get_json_object("value", "$.batchId").cast("bigint").alias("source_batch"),
        )
        .distinct()  # compacted logs repeat the entries before them
    )
    late_from = files.join(ran, "source_batch").join(marks, "batch_id").select(
        "__file", F.timestamp_millis("watermark_ms").alias("__watermark")
    )
    marked = rows.withColumn("__file", _plain_path(F.col(file))).join(late_from, "__file")
    size_us, slide_us = micros(size), micros(slide)
    instant = F.unix_micros(F.col(time).cast("timestamp"))
    floored = lambda c: c - F.pmod(c, F.lit(slide_us))
    starts = F.when(
        floored(instant) > floored(instant - F.lit(size_us)),
        F.sequence(floored(instant - F.lit(size_us)) + F.lit(slide_us), floored(instant), F.lit(slide_us)),
    )
    closed = F.unix_micros("__watermark")
    missed = F.filter(starts, lambda start: start + F.lit(size_us) <= closed)
    return (
        marked.withColumn("missed", F.transform(missed, F.timestamp_micros))
        .where(F.size("missed") > 0)
        .withColumn("too_late", F.size("missed") == F.size(starts))
        .drop("__file", "__watermark")
    )


def _plain_path(path: Column) -> Column:
    """Paths of the local file system are written with one slash and with three."""
    return F.regexp_replace(path, "^file:/+", "/")
