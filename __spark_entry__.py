"""

The ``events`` table plays the sensor readings: ``user_id`` is the sensor, ``ts``
the reading time, ``value`` the reading, ``event_id`` the order of arrival. Each
user has an event about every ten hours, so the ten-to-one overlap of the
original 10 s / 1 s window becomes 10 h / 1 h. Every query reads whole tables.
"""

from __future__ import annotations

import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sensorstream.functions.aggregates import edge_reading  # noqa: E402
from sensorstream.functions.codec import decode  # noqa: E402
from sensorstream.functions.eventtime import (  # noqa: E402
    event_time_from_millis,
    parse_event_time,
    with_event_time,
)
from sensorstream.functions.keys import log_place, position_key  # noqa: E402
from sensorstream.operators.drift import drift, field_types, shapes  # noqa: E402
from sensorstream.operators.ordered import longest_run, ordered_windows  # noqa: E402
from sensorstream.operators.quality import good_readings, missing_fields  # noqa: E402
from sensorstream.operators.routing import collection_of, topic_of  # noqa: E402
from sensorstream.operators.series import series_grid  # noqa: E402
from sensorstream.operators.windows import (  # noqa: E402
    overheat_alerts,
    overheat_stats,
    sliding_windows,
    state_partitions,
    window_counts,
)
from sensorstream.plans.archive import start_archive  # noqa: E402
from sensorstream.plans.overheat import (  # noqa: E402
    CLOCK,
    TIMER,
    current_alerts,
    finish_overheat,
    finished_windows,
    overheat,
    start_overheat,
)
from sensorstream.plans.publish import messages_of, publish_to_files  # noqa: E402
from sensorstream.plans.quarantine import QUARANTINED, start_quarantine  # noqa: E402
from sensorstream.plans.recompute import recompute  # noqa: E402
from sensorstream.plans.reconcile import reconcile  # noqa: E402
from sensorstream.schemas import TIMESTAMP_FORMAT  # noqa: E402
from sensorstream.session import new_folder, settings, use_utc  # noqa: E402
from sensorstream.sources.collections import QUARANTINE, find  # noqa: E402
from sensorstream.sources.compaction import compact  # noqa: E402
from sensorstream.sources.files import (  # noqa: E402
    read_file_log,
    read_locations,
    read_messages,
    read_readings,
    with_log_position,
    write_arrays,
    write_file_log,
    write_locations,
    write_readings,
)
from sensorstream.sources.rolling import read_rolled, write_rolled  # noqa: E402
from sensorstream.streaming.groups import Group  # noqa: E402
from sensorstream.streaming.lateness import late_windows, with_ledger  # noqa: E402
from sensorstream.streaming.runner import start_batches, start_files  # noqa: E402
from sensorstream.streaming.sinks import (  # noqa: E402
    batch_store,
    last_batch,
    latest_revisions,
    read_batches,
)

# The training-data operators are a part that may be left out.
try:
    import corpus_pipeline  # noqa: E402
    import sensorstream.llm.entries as llm_entries  # noqa: E402
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "sensorstream.llm", "sensorstream.llm.entries"):
        raise
    corpus_pipeline = llm_entries = None

SMOKE_DIR = "/root/testdata/sf0.001"
SIZE, SLIDE = "10 hours", "1 hour"
# The mean in whole cents is exact, so both engines round alike.
EXACT = {"decimals": 2, "mean_type": "double"}
WINDOW = {"size": SIZE, "slide": SLIDE}


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _sensor_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        F.col("user_id").alias("sensor_id"), F.col("ts").alias("event_time"), "value"
    )


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, with an event time that takes a watermark."""
    schema = _events(spark, sf_dir).schema
    # A file stream wants a folder or a pattern; the pattern fits a file and a folder.
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _sensor_type() -> Column:
    humid = F.col("event_type").isin("click", "view")
    return F.when(humid, F.lit("humidity")).otherwise(F.lit("temperature"))


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the shape of sensor readings, with ``event_id`` for order."""
    return _events(spark, sf_dir).select(
        F.col("user_id").cast("int").alias("id"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("location_id"),
        (F.pmod("user_id", F.lit(180)) - F.lit(90)).cast("double").alias("latitude"),
        (F.pmod("user_id", F.lit(360)) - F.lit(180)).cast("double").alias("longitude"),
        (F.pmod("user_id", F.lit(1000)) + F.lit(0.25)).cast("double").alias("elevation"),
        _sensor_type().alias("sensor_type"),
        F.date_format("ts", TIMESTAMP_FORMAT).alias("timestamp"),
        "value",
        "event_id",
    )


def _published(spark: SparkSession, sf_dir: str) -> str:
    """Publish the events as messages; returns the file log's folder."""
    log = new_folder(spark, "log")
    publish_to_files(_readings(spark, sf_dir), log, order="event_id", partitions=8)
    return log


def _archived(spark: SparkSession, sf_dir: str) -> str:
    """Publish, then archive the log; returns the store's folder."""
    messages = read_file_log(spark, _published(spark, sf_dir), streaming=True)
    store = new_folder(spark, "store")
    start_archive(messages, store, checkpoint=new_folder(spark, "checkpoint")).awaitTermination()
    return store


def _plain_bounds(windows: DataFrame) -> DataFrame:
    return windows.withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    ).withColumn("window_end", F.col("window_end").cast("timestamp_ntz"))


# --- windows over the table -------------------------------------------------


def q_overheat_stats(spark, sf_dir):
    return overheat_stats(_sensor_events(spark, sf_dir), **WINDOW, **EXACT)


def q_overheat_stats_direct(spark, sf_dir):
    return overheat_stats(_sensor_events(spark, sf_dir), plan="direct", **WINDOW, **EXACT)


def q_overheat_alerts(spark, sf_dir):
    return overheat_alerts(q_overheat_stats(spark, sf_dir))


def q_overheat_min_count(spark, sf_dir):
    return overheat_alerts(
        overheat_stats(_sensor_events(spark, sf_dir), min_count=2, **WINDOW, **EXACT)
    )


def q_sliding_count(spark, sf_dir):
    return window_counts(
        _events(spark, sf_dir), key="event_type", time="ts", size="5 hours", slide="2 hours"
    )


def q_first_last_arrival(spark, sf_dir):
    arrived = _events(spark, sf_dir).withColumn("partition", F.pmod("event_id", F.lit(4)))
    order = ("partition", "event_id")
    measures = [
        edge_reading("value", "first_value", last=False, order=order),
        edge_reading("value", "last_value", last=True, order=order),
        edge_reading("ts", "first_at", last=False, order=order),
        edge_reading("ts", "last_at", last=True, order=order),
    ]
    windows = sliding_windows(arrived, ["user_id"], "ts", SIZE, SLIDE, measures)
    return windows.select(
        F.col("user_id").alias("sensor_id"),
        "window_start",
        "window_end",
        "first_value",
        "last_value",
        F.date_format("first_at", TIMESTAMP_FORMAT).alias("first_ts"),
        F.date_format("last_at", TIMESTAMP_FORMAT).alias("last_ts"),
    )


def q_overheat_arrival(spark, sf_dir):
    """Heat statistics with the first and last reading in order of arrival."""
    place = log_place(F.pmod("event_id", F.lit(4)), F.col("event_id"))
    readings = _events(spark, sf_dir).select(
        F.col("user_id").alias("sensor_id"),
        F.col("ts").alias("event_time"),
        "value",
        place.alias("place"),
    )
    return overheat_stats(readings, arrival="place", **WINDOW, **EXACT)


def q_proc_time_window(spark, sf_dir):
    """Windows by arrival; first and last carry the reading's own time, in order of arrival."""
    delay = F.make_dt_interval(secs=F.pmod("event_id", F.lit(7)))
    arrived = _events(spark, sf_dir).select(
        F.col("user_id").alias("sensor_id"), (F.col("ts") + delay).alias("at"), "ts", "event_id", "value"
    )
    order = ("at", "event_id")
    return overheat_stats(arrived, time="at", reading_time="ts", arrival=order, **WINDOW, **EXACT)


def q_overheat_default(spark, sf_dir):
    """All defaults: the exact mean without stated places, as a float."""
    return overheat_stats(_sensor_events(spark, sf_dir), **WINDOW)


def q_longest_hot_run(spark, sf_dir):
    """A function of the ordered rows that no partial results merge into: readings above 50 in a row."""
    readings = _events(spark, sf_dir).withColumnRenamed("user_id", "sensor_id")
    runs = longest_run("value", 50.0)
    return ordered_windows(readings, ["sensor_id"], "ts", SIZE, SLIDE, runs, order=["event_id"])


# --- decode, encode, keys, routes -------------------------------------------


def q_reading_decode(spark, sf_dir):
    messages = _events(spark, sf_dir).select(
        "event_id",
        F.concat(
            F.lit('{"id":'),
            F.col("user_id").cast("string"),
            F.lit(',"sensor_type":"'),
            F.col("event_type"),
            F.lit('","timestamp":"'),
            F.date_format("ts", TIMESTAMP_FORMAT),
            F.lit('","value":'),
            F.get_json_object("props", "$.k"),
            F.lit("}"),
        ).alias("value"),
    )
    return good_readings(decode(messages)).select(
        "event_id",
        "sensor_id",
        "sensor_type",
        "timestamp",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
        "value",
    )


def q_reading_encode(spark, sf_dir):
    return messages_of(_readings(spark, sf_dir)).select("event_id", "key", "value")


def _broken_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events lose their value, signups carry it as text, purchases are cut off."""
    text = F.concat(F.lit('{"id":'), F.col("user_id").cast("string"), F.lit(',"timestamp":"'))
    stamp = F.date_format("ts", TIMESTAMP_FORMAT)
    value = F.col("value").cast("string")
    kind = F.col("event_type")
    message = (
        F.when(kind == "error", F.concat(text, stamp, F.lit('"}')))
        .when(kind == "signup", F.concat(text, stamp, F.lit('","value":"'), value, F.lit('"}')))
        .when(kind == "purchase", F.lit("nope"))
        .otherwise(F.concat(text, stamp, F.lit('","value":'), value, F.lit("}")))
    )
    return _events(spark, sf_dir).select(
        "event_id",
        "event_type",
        F.col("user_id").cast("string").alias("key"),
        message.alias("value"),
        topic_of(_sensor_type()).alias("topic"),
    )


def q_quarantine_split(spark, sf_dir):
    decoded = decode(_broken_messages(spark, sf_dir).select("event_type", "value"))
    routed = decoded.withColumn("missing", missing_fields())
    return routed.groupBy("event_type", "missing").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("sensor_id").alias("sensors")
    )


def q_schema_drift(spark, sf_dir):
    """Fields and types of two kinds of odd messages, and where they leave the reading's schema."""
    sent = _sent_texts(spark, sf_dir).select(F.lit("sent").alias("kind"), "value")
    broken = _broken_messages(spark, sf_dir).select(F.lit("broken").alias("kind"), "value")
    kind = ["kind"]
    return drift(field_types(shapes(sent.unionByName(broken), kind), kind), kind)


def q_topic_route(spark, sf_dir):
    topic = topic_of(_sensor_type())
    routed = _events(spark, sf_dir).select("event_type", "user_id", topic.alias("topic"))
    return (
        routed.withColumn("collection", collection_of(F.col("topic")))
        .groupBy("topic", "collection", "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("sensors"))
    )


def q_key_by_position(spark, sf_dir):
    message = F.to_json(F.struct(F.col("user_id").alias("id"), "value"))
    keyed = _events(spark, sf_dir).select(position_key(message).alias("key"))
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def q_event_time_assign(spark, sf_dir):
    text = F.date_format("ts", TIMESTAMP_FORMAT)
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    timed = with_event_time(
        _events(spark, sf_dir).select("event_id", text.alias("text"), millis.alias("ms")),
        parse_event_time(F.col("text")),
        delay=None,
    )
    return timed.select(
        "event_id",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
        F.unix_timestamp("event_time").alias("epoch_seconds"),
        event_time_from_millis(F.col("ms")).cast("timestamp_ntz").alias("from_millis"),
    )


def q_series_grid(spark, sf_dir):
    """An hourly series per sensor over the span of its own events."""
    spans = (
        _events(spark, sf_dir)
        .groupBy(F.col("user_id").alias("sensor_id"))
        .agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    )
    return series_grid(spans, step=SLIDE)


# --- streams ----------------------------------------------------------------


def _streamed_stats(spark, sf_dir, mode):
    readings = with_event_time(
        _event_stream(spark, sf_dir).withColumnRenamed("user_id", "sensor_id"), F.col("ts")
    )
    stats = overheat_stats(readings, **WINDOW, **EXACT)
    path = new_folder(spark, f"stats-{mode}")
    start_batches(
        stats,
        batch_store(path),
        name=f"stats-{mode}",
        checkpoint=new_folder(spark, "checkpoint"),
        mode=mode,
    ).awaitTermination()
    return read_batches(spark, path, stats.schema)


def q_stream_overheat_append(spark, sf_dir):
    return _plain_bounds(_streamed_stats(spark, sf_dir, "append").drop("batch_id"))


def q_stream_overheat_update(spark, sf_dir):
    revisions = _streamed_stats(spark, sf_dir, "update")
    keys = ["sensor_id", "window_start", "window_end"]
    return _plain_bounds(latest_revisions(revisions, keys))


def q_stream_overheat_complete(spark, sf_dir):
    return _plain_bounds(last_batch(_streamed_stats(spark, sf_dir, "complete")))


def q_stream_sliding_count(spark, sf_dir):
    ascending = with_event_time(_event_stream(spark, sf_dir), F.col("ts"), delay="0 seconds")
    counts = window_counts(ascending, key="event_type", size="5 hours", slide="2 hours")
    path = new_folder(spark, "counts")
    start_files(
        counts, path, name="counts", checkpoint=new_folder(spark, "checkpoint")
    ).awaitTermination()
    return spark.read.schema(counts.schema).parquet(path)


def q_stream_alerts(spark, sf_dir):
    """The whole job: publish, consume the temperature topic, alert, store."""
    log = _published(spark, sf_dir)
    messages = read_file_log(spark, log, ["temperature-topic"], streaming=True)
    job = {"alerts_only": True, **WINDOW, **EXACT}
    path = new_folder(spark, "alerts")
    start_overheat(
        messages, path, name="alerts", checkpoint=new_folder(spark, "checkpoint"), **job
    ).awaitTermination()
    schema = overheat(messages, **job).schema
    return _plain_bounds(read_batches(spark, path, schema).drop("batch_id"))


def q_stream_clock_window(spark, sf_dir):
    """Windows by the job's own clock: every reading counts in ten of them."""
    log = _published(spark, sf_dir)
    messages = read_file_log(spark, log, streaming=True)
    path = new_folder(spark, "clock")
    start_overheat(
        messages,
        path,
        name="clock",
        checkpoint=new_folder(spark, "checkpoint"),
        mode="update",
        time=CLOCK,
        delay="0 seconds",
    ).awaitTermination()
    schema = overheat(messages).schema
    keys = ["sensor_id", "window_start", "window_end"]
    windows = latest_revisions(read_batches(spark, path, schema), keys)
    return windows.groupBy("sensor_id").agg(
        F.sum("n").alias("n"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
    )


def q_stream_clock_timers(spark, sf_dir):
    """Windows of 4 s by each reading's own arrival, closed by timers: every reading counts in two of them.

    No data come after the first batch, so the job runs until the clock has closed all windows.
    """
    log, path = _published(spark, sf_dir), new_folder(spark, "timers")
    messages = read_file_log(spark, log, streaming=True)
    job = {"time": TIMER, "size": "4 seconds", "slide": "2 seconds"}
    schema = overheat(messages, **job).schema
    wanted, until = 2 * read_file_log(spark, log).count(), time.time() + TIMER_SECONDS
    query = start_overheat(
        messages, path, name="timers", checkpoint=new_folder(spark, "checkpoint"), every="1 second", **job
    )
    try:
        while time.time() < until and query.isActive:
            time.sleep(1)
            # The folder is there once the first batch is written.
            if query.lastProgress and query.lastProgress["batchId"] > 0:
                if read_batches(spark, path, schema).agg(F.sum("n")).first()[0] == wanted:
                    break
        while query.isActive and query.status["isTriggerActive"] and time.time() < until:
            time.sleep(0.05)  # stop between batches
    finally:
        query.stop()
    windows = read_batches(spark, path, schema)
    return windows.groupBy("sensor_id").agg(
        F.sum("n").alias("n"),
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        (F.count(F.lit(1)) - F.countDistinct("window_start")).alias("closed_twice"),
    )


#: Seconds after which the query with timers is stopped, whatever it has.
TIMER_SECONDS = 180
SLICES, SLICE_FILES = 4, 4
# The default rule lags a batch behind, a quarter of the events' span.
LATE_DAYS = 12
KEYS = ["sensor_id", "window_start", "window_end"]


def _streamed_slices(spark, sf_dir, events, strict=False):
    """Heat statistics of events that come in slices, one run of the stream for each.

    Every run takes up the checkpoint of the one before: state is restored and windows are revised.
    """
    log, path, checkpoint = (new_folder(spark, n) for n in ("slices", "stats-slices", "checkpoint"))
    greatest, rows = events.agg(F.max("event_id"), F.count(F.lit(1))).first()
    part = F.floor(F.col("event_id") * SLICES / F.lit(greatest + 1))
    partitions = state_partitions(rows, SIZE, SLIDE)
    kept = events.select("event_id", F.col("user_id").alias("sensor_id"), F.col("ts").cast("timestamp"), "value")
    stats = None
    for k in range(SLICES):
        kept.where(part == k).write.mode("append").parquet(log)
        readings = with_event_time(spark.readStream.schema(kept.schema).parquet(log), F.col("ts"))
        stats = overheat_stats(readings, **WINDOW, **EXACT)
        start_batches(
            stats,
            batch_store(path),
            name="slices",
            checkpoint=checkpoint,
            mode="update",
            strict=strict,
            partitions=partitions,
        ).awaitTermination()
    revisions = read_batches(spark, path, stats.schema)
    return _plain_bounds(latest_revisions(revisions, ["sensor_id", "window_start", "window_end"]))


def q_stream_slices_update(spark, sf_dir):
    return _streamed_slices(spark, sf_dir, _events(spark, sf_dir))


def q_stream_late_strict(spark, sf_dir):
    """Every tenth event is two days late; windows that have closed take it no more."""
    return _streamed_slices(spark, sf_dir, _late(_events(spark, sf_dir), 2), strict=True)


def _late(events, days):
    """Events of which every tenth is so many days late."""
    late = F.when(F.pmod("event_id", F.lit(10)) == 0, F.expr(f"ts - interval {days} days"))
    return events.withColumn("ts", late.otherwise(F.col("ts")))


def _late_run(spark, sf_dir):
    """One run over four slices, a batch for each, under Spark's default rule; its folders."""
    log, path, checkpoint, ledger = (new_folder(spark, n) for n in ("log", "late", "checkpoint", "ledger"))
    events = _late(_events(spark, sf_dir), LATE_DAYS)
    greatest, rows = events.agg(F.max("event_id"), F.count(F.lit(1))).first()
    part = F.floor(F.col("event_id") * SLICES / F.lit(greatest + 1))
    partitions = state_partitions(rows, SIZE, SLIDE)
    kept = events.select("event_id", F.col("user_id").alias("sensor_id"), F.col("ts").cast("timestamp"), "value")
    for k in range(SLICES):
        kept.where(part == k).repartition(SLICE_FILES).write.mode("append").parquet(log)
    stream = spark.readStream.schema(kept.schema).option("maxFilesPerTrigger", SLICE_FILES).parquet(log)
    stats = overheat_stats(with_event_time(stream, F.col("ts")), **WINDOW, **EXACT)
    write = with_ledger(batch_store(path), ledger, checkpoint)
    start_batches(
        stats, write, name="late", checkpoint=checkpoint, mode="update", partitions=partitions
    ).awaitTermination()
    return log, path, checkpoint, ledger, kept.schema, stats.schema


def q_stream_late_default(spark, sf_dir):
    """Late events under Spark's own rule: a closing window takes them for one batch more."""
    _, path, _, _, _, schema = _late_run(spark, sf_dir)
    return _plain_bounds(latest_revisions(read_batches(spark, path, schema), KEYS))


def q_stream_late_rows(spark, sf_dir):
    """The late events and the windows that each has missed."""
    log, _, checkpoint, ledger, schema, _ = _late_run(spark, sf_dir)
    rows = spark.read.schema(schema).parquet(log).select("*", F.col("_metadata.file_path").alias("file"))
    late = late_windows(rows, checkpoint=checkpoint, ledger=ledger, file="file", time="ts", size=SIZE, slide=SLIDE)
    missed = late.select("event_id", "too_late", F.explode("missed").alias("window_start"))
    return missed.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def q_stream_overheat_finished(spark, sf_dir):
    """The end of a bounded stream: the windows that it closed, and those it left open."""
    log = _published(spark, sf_dir)
    messages = read_file_log(spark, log, streaming=True)
    path, checkpoint = new_folder(spark, "finished"), new_folder(spark, "checkpoint")
    job = {**WINDOW, **EXACT}
    start_overheat(messages, path, name="finished", checkpoint=checkpoint, **job).awaitTermination()
    finish_overheat(messages, path, checkpoint=checkpoint, **job)
    return _plain_bounds(finished_windows(spark, path, overheat(messages, **job).schema))


def q_stream_alerts_update(spark, sf_dir):
    """Alerts as the hot readings come first and the others cool windows down: those that stand at the end."""
    log, path, checkpoint = (new_folder(spark, n) for n in ("log", "alerts", "checkpoint"))
    job = {**WINDOW, **EXACT, "delay": "10000 days"}  # no reading is late
    schema = None
    for is_hot in (F.col("value") > 89.0, F.col("value") <= 89.0):
        publish_to_files(_readings(spark, sf_dir).where(is_hot), log, order="event_id", partitions=8)
        messages = read_file_log(spark, log, streaming=True)
        start_overheat(
            messages, path, name="changes", checkpoint=checkpoint, mode="update", alerts_only=True, **job
        ).awaitTermination()
        schema = overheat(messages, **job).schema
    return _plain_bounds(current_alerts(spark, path, schema))


def q_stream_quarantine(spark, sf_dir):
    """What the heat job passes over, as a table: message text and fault."""
    log = new_folder(spark, "log")
    broken = with_log_position(_broken_messages(spark, sf_dir), "event_id", partitions=8)
    write_file_log(broken, log)
    path = new_folder(spark, "quarantine")
    start_quarantine(
        read_file_log(spark, log, streaming=True), path, checkpoint=new_folder(spark, "checkpoint")
    ).awaitTermination()
    return read_batches(spark, path, QUARANTINED).select("topic", "raw", "missing")


def q_stream_result_files(spark, sf_dir):
    """Windows as rolling CSV part files, read back."""
    readings = with_event_time(
        _event_stream(spark, sf_dir).withColumnRenamed("user_id", "sensor_id"), F.col("ts")
    )
    stats = overheat_stats(readings, **WINDOW, **EXACT)
    path = new_folder(spark, "csv")
    start_files(
        stats,
        path,
        name="csv",
        checkpoint=new_folder(spark, "checkpoint"),
        file_format="csv",
        max_records_per_file=1_000_000,
    ).awaitTermination()
    return _plain_bounds(spark.read.schema(stats.schema).csv(path))


def q_archive_roundtrip(spark, sf_dir):
    store = _archived(spark, sf_dir)
    kept = [find(spark, store, c).withColumn("collection", F.lit(c)) for c in
            ("humidity", "temperature", QUARANTINE)]
    stored = kept[0].unionByName(kept[1]).unionByName(kept[2])
    return stored.groupBy("collection", "topic").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("sensor_id").alias("sensors"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents"),
        F.min("timestamp").alias("first_ts"),
        F.max("timestamp").alias("last_ts"),
    )


def q_archive_group(spark, sf_dir):
    """Three checkpoints of one group, each new to the log: every message once, and the offsets read."""
    log, store, offsets = (new_folder(spark, n) for n in ("log", "store", "offsets"))
    group = Group(offsets, "archive")
    readings = _readings(spark, sf_dir)
    for k in range(3):
        if k < 2:  # the third finds nothing new
            publish_to_files(readings.where(F.pmod("event_id", F.lit(2)) == k), log, order="event_id", partitions=8)
        messages = read_file_log(spark, log, streaming=True, max_files_per_trigger=8, splits=True)
        checkpoint = new_folder(spark, "checkpoint")
        start_archive(messages, store, checkpoint=checkpoint, group=group, files_per_batch=1).awaitTermination()
    kept = [find(spark, store, c) for c in ("humidity", "temperature", QUARANTINE)]
    stored = kept[0].unionByName(kept[1]).unionByName(kept[2])
    behind = stored.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("behind"), F.count(F.lit(1)).alias("n"), F.countDistinct("offset").alias("offsets")
    )
    return (
        behind.join(group.next_offsets(spark), ["topic", "partition"], "full")
        .groupBy("topic")
        .agg(
            F.sum("n").alias("n"),
            F.sum("offsets").alias("offsets"),
            F.count_if(~F.col("behind").eqNullSafe(F.col("next_offset"))).alias("wrong_commits"),
        )
    )


def q_archive_compacted(spark, sf_dir):
    """A collection written in many batches, compacted twice, with batches behind the last compaction."""
    log, store, checkpoint = (new_folder(spark, n) for n in ("log", "store", "checkpoint"))
    readings = _readings(spark, sf_dir)
    for k in range(3):
        publish_to_files(readings.where(F.pmod("event_id", F.lit(3)) == k), log, order="event_id", partitions=8)
        messages = read_file_log(spark, log, streaming=True, max_files_per_trigger=4)
        start_archive(messages, store, checkpoint=checkpoint, files_per_batch=1).awaitTermination()
        if k < 2:
            compact(spark, store, "temperature")
    return find(spark, store, "temperature").select("sensor_id", "timestamp", "value")


def q_collection_find(spark, sf_dir):
    hot = F.col("value") > 89.0
    found = find(spark, _archived(spark, sf_dir), "temperature", hot)
    return found.select("sensor_id", "location_id", "elevation", "timestamp", "value")


def q_recompute_stored(spark, sf_dir):
    return _plain_bounds(recompute(spark, _archived(spark, sf_dir), **WINDOW, **EXACT))


def q_reconcile(spark, sf_dir):
    """The store against the readings with some left out, some changed and some sent twice: just those."""
    stored = find(spark, _archived(spark, sf_dir), "temperature").select("sensor_id", "timestamp", "value")
    lost, changed, doubled = (F.pmod("event_id", F.lit(n)) == 0 for n in (97, 89, 83))
    sent = _readings(spark, sf_dir).where((F.col("sensor_type") == "temperature") & ~lost)
    sent = sent.withColumn("value", F.when(changed, F.col("value") + 1000).otherwise(F.col("value")))
    sent = sent.unionByName(sent.where(doubled)).select(F.col("id").alias("sensor_id"), "timestamp", "value")
    day = F.substring("timestamp", 1, 10)
    differ = reconcile(
        stored.withColumn("day", day),
        sent.withColumn("day", day),
        groups=["day", "sensor_id"],
        columns=["sensor_id", "timestamp", "value"],
    )
    return differ


def _odd_archive(spark, sf_dir):
    """Archive messages with a field of no known name and one of a wrong type."""
    text = F.concat(
        F.lit('{"id":'),
        F.col("user_id").cast("string"),
        F.lit(',"latitude":"north","timestamp":"'),
        F.date_format("ts", TIMESTAMP_FORMAT),
        F.lit('","value":'),
        F.col("value").cast("string"),
        F.lit(',"unit":"C"}'),
    )
    log, store = new_folder(spark, "log"), new_folder(spark, "store")
    sent = _events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("key"),
        text.alias("value"),
        topic_of(_sensor_type()).alias("topic"),
        "event_id",
    )
    write_file_log(with_log_position(sent, "event_id", partitions=8), log)
    messages = read_file_log(spark, log, streaming=True)
    start_archive(messages, store, checkpoint=new_folder(spark, "checkpoint")).awaitTermination()
    return store


def q_archive_documents(spark, sf_dir):
    """The stored text is the text that was sent, whatever its fields."""
    store = _odd_archive(spark, sf_dir)
    kept = [find(spark, store, c).select(F.lit(c).alias("collection"), "raw") for c in
            ("humidity", "temperature", QUARANTINE)]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


def q_recompute_odd_fields(spark, sf_dir):
    """A bad optional field takes no reading out of the statistics."""
    return _plain_bounds(recompute(spark, _odd_archive(spark, sf_dir), **WINDOW, **EXACT))


def q_publish_twice(spark, sf_dir):
    """Two publishes to one log: positions stay distinct and ascend for each sensor."""
    log = new_folder(spark, "log")
    readings = _readings(spark, sf_dir)
    half = readings.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    publish_to_files(readings.where(F.col("event_id") <= half), log, order="event_id", partitions=8)
    publish_to_files(readings.where(F.col("event_id") > half), log, order="event_id", partitions=8)
    sent = read_file_log(spark, log)
    stamp = F.get_json_object("value", "$.timestamp")
    before = Window.partitionBy("key", "topic").orderBy("offset")
    ordered = sent.select("key", "topic", "partition", "offset", stamp.alias("t")).withColumn(
        "descends", (F.lag("t").over(before) > F.col("t")).cast("int")
    )
    return ordered.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("partition", "offset").alias("positions"),
        F.coalesce(F.sum("descends"), F.lit(0)).alias("descents"),
    )


def q_publish_envelope(spark, sf_dir):
    return read_file_log(spark, _published(spark, sf_dir)).select("key", "value", "topic")


# --- files ------------------------------------------------------------------


def q_reading_files(spark, sf_dir):
    path = new_folder(spark, "readings")
    write_readings(_readings(spark, sf_dir), path)
    return read_readings(spark, path, lines=True)


def _sent_texts(spark, sf_dir):
    """Messages with a field of no known name, quotes and braces in a text, and a nested object."""
    return _events(spark, sf_dir).select(
        "event_id",
        F.to_json(
            F.struct(
                F.col("user_id").alias("id"),
                F.when(F.col("event_type") != "error", _sensor_type()).alias("sensor_type"),
                F.date_format("ts", TIMESTAMP_FORMAT).alias("timestamp"),
                "value",
                F.concat(F.lit('a } "quoted" { brace\\'), "event_type").alias("note"),
                F.when(F.pmod("event_id", F.lit(5)) == 0, F.struct(F.struct("event_id").alias("of"))).alias("meta"),
            )
        ).alias("value"),
    )


def q_reading_array(spark, sf_dir):
    """Readings from files of one JSON array each, which several tasks read."""
    path = new_folder(spark, "arrays")
    write_arrays(_sent_texts(spark, sf_dir), path)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "64k"}):
        return read_readings(spark, path).select("id", "sensor_type", "timestamp", "value")


def q_publish_verbatim(spark, sf_dir):
    """Messages as they are: extra fields stay, and those without a type can still be read."""
    path, log = new_folder(spark, "arrays"), new_folder(spark, "log")
    write_arrays(_sent_texts(spark, sf_dir), path)
    publish_to_files(read_messages(spark, path), log, partitions=8)
    return read_file_log(spark, log).select("key", "value", "topic")


def q_rolled_files(spark, sf_dir):
    """Messages in order of arrival as files of 10,000 bytes, read back."""
    messages = messages_of(_readings(spark, sf_dir))
    path = new_folder(spark, "rolled")
    write_rolled(messages, path, F.col("value"), ["event_id"], file_bytes=10_000)
    return read_rolled(spark, path)


def q_location_files(spark, sf_dir):
    """Suppliers as locations: an address over two lines and a list of features."""
    use_utc(spark)
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    nation = F.col("s_nationkey").cast("string")
    locations = suppliers.select(
        F.col("s_suppkey").cast("int").alias("location_id"),
        F.concat(F.col("s_name"), F.lit('\n"No. 1", '), F.col("s_nationkey")).alias("address"),
        F.array(
            F.lit("farmer's field"),
            F.concat(F.lit('the "big" nation, no. '), nation),
            F.concat(F.lit("a\\b "), nation),
        ).alias("topography"),
    )
    path = new_folder(spark, "locations")
    write_locations(locations, path)
    read = read_locations(spark, path)
    return read.select("location_id", "address", F.array_join("topography", "|").alias("features"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per implemented query/operator, by name."""
    found = {
        name.removeprefix("q_"): query
        for name, query in globals().items()
        if name.startswith("q_")
    }
    if llm_entries is not None:
        found |= {**llm_entries.QUERIES, "pipeline": corpus_pipeline.run}
    return found


def entry(spark: SparkSession) -> DataFrame:
    """The flagship query on the smallest tables."""
    return q_overheat_stats(spark, SMOKE_DIR)


# --- oracles ----------------------------------------------------------------

_FIRST, _LAST = "min(moment)", "max(moment)"
_PLACE = "{'p': event_id % 4, 'o': event_id}"
_ARRIVAL = "{'a': moment, 'e': event_id}"

_STATS = """
  ((20 * sum(cast(round(value * 100) as bigint)) + count(*)) // (2 * count(*)))
    / cast(1000 as double) AS mean_temp,
  bool_and(value > 89.0) AS overheat_constant,
  strftime({first}, '%Y-%m-%d %H:%M:%S') AS first_ts,
  strftime({last}, '%Y-%m-%d %H:%M:%S') AS last_ts,
  count(*) AS n"""


def _windows_sql(
    *,
    time: str = "ts",
    where: str = "true",
    key_type: str = "bigint",
    having: str = "true",
    first: str = _FIRST,
    last: str = _LAST,
) -> str:
    """All 10 h / 1 h windows of the events, each row spread to the ten it is in."""
    return f"""
WITH readings AS (
  SELECT user_id, event_id, value, ts, {time} AS moment FROM events WHERE {where}
), spread AS (
  SELECT readings.*,
    time_bucket(interval '1 hour', moment, timestamp '1970-01-01') - k * interval '1 hour' AS ws
  FROM readings, generate_series(0, 9) g(k)
), stats AS (
  SELECT cast(user_id AS {key_type}) AS sensor_id, ws AS window_start,
    ws + interval '10 hours' AS window_end, {_STATS.format(first=first, last=last)}
  FROM spread WHERE moment < ws + interval '10 hours' GROUP BY user_id, ws
)
SELECT *, mean_temp > 90.0 OR overheat_constant AS hot FROM stats WHERE {having}"""


_HOT = "(mean_temp > 90.0 OR overheat_constant)"
_CLOSED = "window_end <= (SELECT max(moment) FROM readings) - interval '2 seconds'"
_SECONDS = "date_trunc('second', ts)::timestamp"
_TEMPERATURE = "event_type NOT IN ('click', 'view')"
_TOPIC = "CASE WHEN event_type IN ('click', 'view') THEN 'humidity-topic' ELSE 'temperature-topic' END"
_SENT_TYPE = f"CASE WHEN event_type <> 'error' THEN replace({_TOPIC}, '-topic', '') END"
_STAMP = "strftime(ts, '%Y-%m-%d %H:%M:%S')"

_COUNTS = """
WITH spread AS (
  SELECT event_type, ts,
    time_bucket(interval '2 hours', ts, timestamp '1970-01-01') - k * interval '2 hours' AS ws
  FROM events, generate_series(0, 2) g(k)
), counts AS (
  SELECT event_type, ws + interval '5 hours' AS we, epoch_ms(ws) AS window_start_ms,
    epoch_ms(ws + interval '5 hours') AS window_end_ms, count(*) AS n
  FROM spread WHERE ts < ws + interval '5 hours' GROUP BY event_type, ws
)
SELECT event_type, window_start_ms, window_end_ms, n FROM counts WHERE {closed}"""


def _late_sql(before: str, days: int, rest: str) -> str:
    """Windows of slices with late events; closed are those before the mark of the slices ``before``."""
    return f"""
WITH sliced AS (
  SELECT *, event_id * {SLICES} // (SELECT max(event_id) + 1 FROM events) AS slice,
    CASE WHEN event_id % 10 = 0 THEN ts - interval '{days} days' ELSE ts END AS moment
  FROM events
), marks AS (
  SELECT k AS slice, (SELECT max(moment) FROM sliced s WHERE s.slice < {before.replace("slice", "k")})
    - interval '2 seconds' AS mark
  FROM generate_series(0, {SLICES - 1}) g(k)
), spread AS (
  SELECT sliced.*, time_bucket(interval '1 hour', moment, timestamp '1970-01-01') - k * interval '1 hour' AS ws
  FROM sliced, generate_series(0, 9) g(k)
), marked AS (
  -- Watermarks are kept in whole milliseconds.
  SELECT spread.*, mark IS NOT NULL AND ws + interval '10 hours' <= date_trunc('millisecond', mark) AS closed
  FROM spread JOIN marks USING (slice) WHERE moment < ws + interval '10 hours'
){rest}"""


_LATE_STATS = f""", stats AS (
  SELECT user_id AS sensor_id, ws AS window_start, ws + interval '10 hours' AS window_end,
    {_STATS.format(first=_FIRST, last=_LAST)}
  FROM marked WHERE NOT closed GROUP BY user_id, ws
)
SELECT *, mean_temp > 90.0 OR overheat_constant AS hot FROM stats"""


def _message_sql(value: str) -> str:
    return f"""cast(to_json({{
      'id': cast(user_id AS integer), 'location_id': cast(user_id % 4 AS integer),
      'latitude': cast(user_id % 180 - 90 AS double),
      'longitude': cast(user_id % 360 - 180 AS double),
      'elevation': cast(user_id % 1000 + 0.25 AS double),
      'sensor_type': replace({_TOPIC}, '-topic', ''),
      'timestamp': {_STAMP}, 'value': {value}}}) AS varchar)"""


_MESSAGE = f"""CASE WHEN value = floor(value) THEN {_message_sql("cast(value AS bigint)")}
    ELSE {_message_sql("value")} END"""


def oracle_sql() -> dict[str, str]:
    """The same results in SQL over the same tables."""
    trained = {} if llm_entries is None else llm_entries.ORACLES
    return trained | {
        "overheat_stats": _windows_sql(),
        "overheat_stats_direct": _windows_sql(),
        "overheat_alerts": _windows_sql(having=_HOT),
        "overheat_min_count": _windows_sql(having=f"{_HOT} AND n >= 2"),
        "sliding_count": _COUNTS.format(closed="true"),
        "first_last_arrival": """
WITH spread AS (
  SELECT user_id, ts, value, {'p': event_id % 4, 'o': event_id} AS place,
    time_bucket(interval '1 hour', ts, timestamp '1970-01-01') - k * interval '1 hour' AS ws
  FROM events, generate_series(0, 9) g(k)
)
SELECT user_id AS sensor_id, ws AS window_start, ws + interval '10 hours' AS window_end,
  arg_min(value, place) AS first_value, arg_max(value, place) AS last_value,
  strftime(arg_min(ts, place), '%Y-%m-%d %H:%M:%S') AS first_ts,
  strftime(arg_max(ts, place), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM spread WHERE ts < ws + interval '10 hours' GROUP BY user_id, ws""",
        "overheat_arrival": _windows_sql(
            first=f"arg_min(moment, {_PLACE})", last=f"arg_max(moment, {_PLACE})"
        ),
        "proc_time_window": _windows_sql(
            time="ts + (event_id % 7) * interval '1 second'",
            first=f"arg_min(ts, {_ARRIVAL})",
            last=f"arg_max(ts, {_ARRIVAL})",
        ),
        "overheat_default": f"""
SELECT * REPLACE (cast(mean_temp AS float) AS mean_temp) FROM ({_windows_sql()})""",
        "longest_hot_run": """
WITH spread AS (
  SELECT user_id, event_id, ts, value > 50 AS hot,
    time_bucket(interval '1 hour', ts, timestamp '1970-01-01') - k * interval '1 hour' AS ws
  FROM events, generate_series(0, 9) g(k)
), numbered AS (
  SELECT *, row_number() OVER w - row_number() OVER (PARTITION BY user_id, ws, hot ORDER BY ts, event_id) AS island
  FROM spread WHERE ts < ws + interval '10 hours' WINDOW w AS (PARTITION BY user_id, ws ORDER BY ts, event_id)
), islands AS (
  SELECT user_id, ws, CASE WHEN hot THEN count(*) ELSE 0 END AS n FROM numbered GROUP BY user_id, ws, hot, island
)
SELECT user_id AS sensor_id, ws AS window_start, ws + interval '10 hours' AS window_end, max(n) AS longest_run
FROM islands GROUP BY user_id, ws""",
        "stream_slices_update": _windows_sql(),
        "stream_late_strict": _late_sql("slice", 2, _LATE_STATS),
        "stream_late_default": _late_sql("slice - 1", LATE_DAYS, _LATE_STATS),
        "stream_late_rows": _late_sql("slice - 1", LATE_DAYS, """
SELECT event_id, bool_and(closed) OVER (PARTITION BY event_id) AS too_late, ws AS window_start
FROM marked QUALIFY closed"""),
        "stream_overheat_finished": _windows_sql(time=_SECONDS, key_type="integer"),
        "stream_alerts_update": _windows_sql(time=_SECONDS, key_type="integer", having=_HOT),
        "reconcile": f"""
WITH stored AS (
  SELECT cast(user_id AS integer) AS sensor_id, {_STAMP} AS timestamp, value, event_id
  FROM events WHERE {_TEMPERATURE}
), sent AS (
  SELECT sensor_id, timestamp, value + CASE WHEN event_id % 89 = 0 THEN 1000 ELSE 0 END AS value, event_id
  FROM stored WHERE event_id % 97 <> 0
), sides AS (
  SELECT sensor_id, timestamp, value, 1 AS l, 0 AS r FROM stored
  UNION ALL SELECT sensor_id, timestamp, value, 0, 1 FROM sent
  UNION ALL SELECT sensor_id, timestamp, value, 0, 1 FROM sent WHERE event_id % 83 = 0
)
SELECT sensor_id, timestamp, value, cast(sum(l) AS bigint) AS n_left, cast(sum(r) AS bigint) AS n_right
FROM sides GROUP BY 1, 2, 3 HAVING sum(l) <> sum(r)""",
        "archive_documents": f"""
SELECT replace({_TOPIC}, '-topic', '') AS collection,
  '{{"id":' || user_id || ',"latitude":"north","timestamp":"' || {_STAMP} || '","value":' || value
    || ',"unit":"C"}}' AS raw
FROM events""",
        "recompute_odd_fields": _windows_sql(
            time=_SECONDS, where=_TEMPERATURE, key_type="integer"
        ),
        "publish_twice": f"""
SELECT {_TOPIC} AS topic, count(*) AS n, count(*) AS positions, 0 AS descents FROM events GROUP BY 1""",
        "reading_decode": f"""
SELECT event_id, cast(user_id AS integer) AS sensor_id, event_type AS sensor_type,
  {_STAMP} AS timestamp, {_SECONDS} AS event_time, cast(props->>'$.k' AS double) AS value
FROM events""",
        "reading_encode": f"""
SELECT event_id, cast(user_id AS varchar) AS key, {_MESSAGE} AS value FROM events""",
        "quarantine_split": """
SELECT event_type,
  CASE WHEN event_type IN ('error', 'signup') THEN 'value'
       WHEN event_type = 'purchase' THEN 'sensor_id,event_time,value' ELSE '' END AS missing,
  count(*) AS n,
  CASE WHEN event_type = 'purchase' THEN 0 ELSE count(DISTINCT user_id) END AS sensors
FROM events GROUP BY event_type""",
        "topic_route": f"""
SELECT {_TOPIC} AS topic, replace({_TOPIC}, '-topic', '') AS collection, event_type,
  count(*) AS n, count(DISTINCT user_id) AS sensors
FROM events GROUP BY ALL""",
        "key_by_position": """
SELECT try_cast(substr(cast(to_json({'id': user_id, 'value': value}) AS varchar), 7, 1)
  AS integer) AS key, count(*) AS n
FROM events GROUP BY 1""",
        "event_time_assign": f"""
SELECT event_id, {_SECONDS} AS event_time, cast(epoch({_SECONDS}) AS bigint) AS epoch_seconds,
  date_trunc('millisecond', ts)::timestamp AS from_millis
FROM events""",
        "series_grid": """
WITH spans AS (SELECT user_id, min(ts) AS lo, max(ts) AS hi FROM events GROUP BY user_id)
SELECT user_id AS sensor_id, unnest(generate_series(lo, hi, interval '1 hour')) AS event_time
FROM spans""",
        "stream_overheat_append": _windows_sql(having=_CLOSED),
        "stream_overheat_update": _windows_sql(),
        "stream_overheat_complete": _windows_sql(),
        "stream_sliding_count": _COUNTS.format(closed="we <= (SELECT max(ts) FROM events)"),
        "stream_alerts": _windows_sql(
            time=_SECONDS, where=_TEMPERATURE, key_type="integer", having=f"{_HOT} AND {_CLOSED}"
        ),
        "stream_clock_window": """
SELECT cast(user_id AS integer) AS sensor_id, 10 * count(*) AS n,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM events GROUP BY user_id""",
        "stream_clock_timers": """
SELECT cast(user_id AS integer) AS sensor_id, 2 * count(*) AS n, 0 AS closed_twice,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts
FROM events GROUP BY user_id""",
        "stream_quarantine": f"""
SELECT {_TOPIC} AS topic,
  CASE event_type
    WHEN 'purchase' THEN 'nope'
    WHEN 'error' THEN '{{"id":' || user_id || ',"timestamp":"' || {_STAMP} || '"}}'
    ELSE '{{"id":' || user_id || ',"timestamp":"' || {_STAMP} || '","value":"' || value || '"}}'
  END AS raw,
  CASE event_type WHEN 'purchase' THEN 'sensor_id,event_time,value' ELSE 'value' END AS missing
FROM events WHERE event_type IN ('error', 'signup', 'purchase')""",
        "stream_result_files": _windows_sql(having=_CLOSED),
        "archive_roundtrip": f"""
SELECT replace({_TOPIC}, '-topic', '') AS collection, {_TOPIC} AS topic, count(*) AS n,
  count(DISTINCT user_id) AS sensors,
  cast(sum(cast(round(value * 100) AS bigint)) AS bigint) AS cents,
  min({_STAMP}) AS first_ts, max({_STAMP}) AS last_ts
FROM events GROUP BY 1, 2""",
        "schema_drift": """
WITH found AS (
  SELECT 'sent' AS kind, unnest([' object', 'id whole', 'timestamp text', 'value fraction', 'note text', 'location_id absent',
    'latitude absent', 'longitude absent', 'elevation absent']) AS f FROM events
  UNION ALL SELECT 'sent', CASE event_type WHEN 'error' THEN 'sensor_type absent' ELSE 'sensor_type text' END FROM events
  UNION ALL SELECT 'sent', unnest(['meta object', 'meta.of object', 'meta.of.event_id whole']) FROM events WHERE event_id % 5 = 0
  UNION ALL SELECT 'broken', unnest([' object', 'id whole', 'timestamp text', 'location_id absent', 'latitude absent',
    'longitude absent', 'elevation absent', 'sensor_type absent']) FROM events WHERE event_type <> 'purchase'
  UNION ALL SELECT 'broken', CASE event_type WHEN 'purchase' THEN ' unreadable' WHEN 'error' THEN 'value absent'
    WHEN 'signup' THEN 'value text' ELSE 'value fraction' END FROM events
)
SELECT kind, split_part(f, ' ', 1) AS path, split_part(f, ' ', 2) AS type, cast(count(*) AS bigint) AS n,
  CASE WHEN f = ' unreadable' THEN 'no object' WHEN f LIKE 'note %' OR f LIKE 'meta%' THEN 'unknown field'
    WHEN f LIKE '% absent' THEN 'missing' WHEN f = 'value text' THEN 'wrong type' END AS fault
FROM found GROUP BY kind, f""",
        "archive_group": f"""
SELECT {_TOPIC} AS topic, cast(count(*) AS bigint) AS n, cast(count(*) AS bigint) AS offsets,
  cast(0 AS bigint) AS wrong_commits
FROM events GROUP BY 1""",
        "archive_compacted": f"""
SELECT cast(user_id AS integer) AS sensor_id, {_STAMP} AS timestamp, value FROM events WHERE {_TEMPERATURE}""",
        "collection_find": f"""
SELECT cast(user_id AS integer) AS sensor_id, cast(user_id % 4 AS integer) AS location_id,
  cast(user_id % 1000 + 0.25 AS double) AS elevation, {_STAMP} AS timestamp, value
FROM events WHERE {_TEMPERATURE} AND value > 89.0""",
        "recompute_stored": _windows_sql(
            time=_SECONDS, where=_TEMPERATURE, key_type="integer"
        ),
        "publish_envelope": f"""
SELECT cast(user_id AS varchar) AS key, {_MESSAGE} AS value, {_TOPIC} AS topic FROM events""",
        "reading_files": f"""
SELECT cast(user_id AS integer) AS id, cast(user_id % 4 AS integer) AS location_id,
  cast(user_id % 180 - 90 AS double) AS latitude,
  cast(user_id % 360 - 180 AS double) AS longitude,
  cast(user_id % 1000 + 0.25 AS double) AS elevation,
  replace({_TOPIC}, '-topic', '') AS sensor_type, {_STAMP} AS timestamp, value
FROM events""",
        "reading_array": f"""
SELECT cast(user_id AS integer) AS id, {_SENT_TYPE} AS sensor_type, {_STAMP} AS timestamp, value FROM events""",
        "publish_verbatim": f"""
SELECT cast(user_id AS varchar) AS key, coalesce({_SENT_TYPE}, 'untyped') || '-topic' AS topic,
  '{{"id":' || user_id || coalesce(',"sensor_type":"' || {_SENT_TYPE} || '"', '') || ',"timestamp":"' || {_STAMP}
    || '","value":' || value || ',"note":"a }} \\"quoted\\" {{ brace\\\\' || event_type || '"'
    || CASE WHEN event_id % 5 = 0 THEN ',"meta":{{"of":{{"event_id":' || event_id || '}}}}' ELSE '' END
    || '}}' AS value
FROM events""",
        "rolled_files": f"""
SELECT value, cast(floor((sum(strlen(value) + 1) OVER (ORDER BY event_id) - strlen(value) - 1) / 10000) AS bigint) AS file
FROM (SELECT event_id, {_MESSAGE} AS value FROM events)""",
        "location_files": """
SELECT cast(s_suppkey AS integer) AS location_id,
  s_name || chr(10) || '"No. 1", ' || s_nationkey AS address,
  'farmer''s field|the "big" nation, no. ' || s_nationkey || '|a\\b ' || s_nationkey AS features
FROM supplier""",
    }
