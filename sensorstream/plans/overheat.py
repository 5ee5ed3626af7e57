"""The overheat job: messages in, heat statistics or alerts out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sensorstream.functions.codec import decode
from sensorstream.functions.eventtime import parse_event_time, with_event_time
from sensorstream.operators.quality import good_readings
from sensorstream.operators.windows import overheat_alerts, overheat_stats
from sensorstream.schemas import OUT_OF_ORDERNESS
from sensorstream.session import ship_library
from sensorstream.streaming.clock import clock_windows
from sensorstream.streaming.lateness import with_ledger
from sensorstream.streaming.runner import start_batches
from sensorstream.streaming.sinks import batch_store, change_log, current_rows, read_batches, read_changes

KEYS = ["sensor_id", "window_start", "window_end"]
EVENT, LOG, CLOCK, TIMER = "event", "log", "clock", "timer"


def overheat(
    messages: DataFrame,
    *,
    time: str = EVENT,
    delay: str = OUT_OF_ORDERNESS,
    source_tz: str | None = None,
    alerts_only: bool = False,
    **stats,
) -> DataFrame:
    """Heat statistics of a message frame, batch or streaming.

    ``time`` says what windows go by: ``"event"`` the reading's own timestamp,
    ``"log"`` the time the log took the message in, ``"clock"`` the time the job
    reads it (one value per batch). ``open_in`` names the checkpoint of a stopped stream and gives the windows
    it left open. ``"timer"`` is the time at which each reading is taken in, and its windows close by the clock alone
    (streams in append mode). First and last reading carry the reading's own
    timestamp as it was sent, whatever the clock and ``source_tz``. Further arguments go
    to :func:`~sensorstream.operators.windows.overheat_stats`.
    """
    clocks = {EVENT: F.col("event_time"), LOG: F.col("log_time"), CLOCK: F.current_timestamp()}
    if time not in (*clocks, TIMER):
        raise ValueError(f"time must be one of {(*clocks, TIMER)}")
    decoded = decode(messages, fields=("id", "timestamp", "value"), source_tz=source_tz)
    if time == TIMER:
        ship_library(messages.sparkSession)
        stats.pop("decimals", None)  # sums are exact without it
        windows = clock_windows(good_readings(decoded), **stats)
        return overheat_alerts(windows) if alerts_only else windows
    readings = good_readings(decoded).withColumn("sent_at", parse_event_time(F.col("timestamp")))
    timed = with_event_time(readings, clocks[time], delay if messages.isStreaming else None, "at")
    windows = overheat_stats(timed, time="at", reading_time="sent_at", **stats)
    return overheat_alerts(windows) if alerts_only else windows


def start_overheat(
    messages: DataFrame,
    path: str,
    *,
    name: str,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    strict: bool = False,
    files_per_batch: int | None = None,
    ledger: str | None = None,
    **job,
) -> StreamingQuery:
    """Run :func:`overheat` on a stream into a table of results.

    ``mode="append"`` stores each window once, when the watermark has passed its
    end; ``"update"`` stores a revision per batch that changed it. Alerts in update mode are a
    log of changes, as a window that was hot may cool down: see :func:`current_alerts`. ``ledger`` is a folder
    that takes an entry for each batch, from which late rows are told apart afterwards
    (:func:`~sensorstream.streaming.lateness.late_windows`).
    """
    alerts_only = job.pop("alerts_only", False)
    if alerts_only and mode == "update":
        windows = overheat(messages, **job)
        write = change_log(path, windows.schema, KEYS, F.col("hot"), "window_start", files_per_batch)
    else:
        windows = overheat(messages, alerts_only=alerts_only, **job)
        write = batch_store(path, files_per_batch=files_per_batch)
    if ledger is not None:
        write = with_ledger(write, ledger, checkpoint)
    return start_batches(
        windows,
        write,
        name=name,
        checkpoint=checkpoint,
        mode=mode,
        every=every,
        strict=strict,
    )


def current_alerts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The alerts that stand, of those that an update-mode stream has raised and withdrawn."""
    return current_rows(read_changes(spark, path, schema), KEYS)


def finish_overheat(messages: DataFrame, path: str, *, checkpoint: str, **job) -> None:
    """Store the windows that a stopped append-mode stream has left open, as at the end of a bounded input.

    They lie beside the result table and are replaced when the stream has gone on and is finished again.
    """
    overheat(messages, open_in=checkpoint, **job).write.mode("overwrite").parquet(open_path(path))


def finished_windows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All windows of a finished stream: the closed ones, and the open ones that have not been closed since."""
    closed = read_batches(spark, path, schema).drop("batch_id")
    still_open = spark.read.schema(schema).parquet(open_path(path))
    return closed.unionByName(still_open.join(closed.select(*KEYS), KEYS, "left_anti"))


def open_path(path: str) -> str:
    return f"{path.rstrip('/')}.open"
