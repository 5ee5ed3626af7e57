import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sensorstream.functions.eventtime import with_event_time
from sensorstream.operators.windows import overheat_stats, state_partitions
from sensorstream.plans.archive import start_archive
from sensorstream.functions.codec import decode
from sensorstream.operators.quality import good_readings
from sensorstream.plans.overheat import (
    CLOCK,
    LOG,
    current_alerts,
    finish_overheat,
    finished_windows,
    overheat,
    start_overheat,
)
from sensorstream.plans.publish import publish_to_files
from sensorstream.plans.quarantine import QUARANTINED, start_quarantine
from sensorstream.plans.recompute import recompute
from sensorstream.schemas import ENVELOPE, READING
from sensorstream.sources.collections import find
from sensorstream.sources.files import read_file_log, with_log_position, write_file_log
from sensorstream.streaming.lateness import ALLOW_MULTIPLE, late_rows, late_windows, strict_lateness
from sensorstream.streaming import sinks
from sensorstream.streaming.runner import start_batches, start_console, start_files
from sensorstream.streaming.sinks import batch_store, latest_revisions, read_batches, read_changes

ORIGIN = datetime(2010, 1, 2, 12, 25, 0)
KEYS = ["sensor_id", "window_start", "window_end"]

# Late-row fixture: micro-batches of (second, value).
BATCHES = [
    [(s, 95) for s in range(15)],
    [(15, 60), (2, 50), (12, 50), (13, 50)],
    [(30, 60), (4, 50)],
    [(31, 60), (4, 50)],
]
TAIL = {
    5: (87.5, 12), 6: (84.583, 12), 7: (83.636, 11), 8: (82.5, 10), 9: (81.111, 9), 10: (79.375, 8),
    11: (77.143, 7), 12: (74.167, 6), 13: (75.0, 4), 14: (77.5, 2), 15: (60.0, 1),
}
DEFAULT = {
    -9: (95.0, 1), -8: (95.0, 2), -7: (83.75, 4), -6: (86.0, 5), -5: (87.5, 6), -4: (88.571, 7),
    -3: (89.375, 8), -2: (90.0, 9), -1: (90.5, 10), 0: (90.909, 11), 1: (90.909, 11), 2: (90.909, 11),
    3: (87.5, 12), 4: (82.143, 14), **TAIL,
}
STRICT = {
    **{start: (95.0, start + 10) for start in range(-9, 1)},
    1: (95.0, 10), 2: (95.0, 10), 3: (90.909, 11), 4: (84.615, 13), **TAIL,
}


def text(sensor, second, value, kind="temperature"):
    stamp = (ORIGIN + timedelta(seconds=second)).strftime("%Y-%m-%d %H:%M:%S")
    return (
        f'{{"id":{sensor},"location_id":0,"latitude":1.0,"longitude":2.0,"elevation":3.0,'
        f'"sensor_type":"{kind}","timestamp":"{stamp}","value":{value}}}'
    )


def append(spark, path, rows, step):
    """One more file in the log; file streams order files by modification time."""
    frame = spark.createDataFrame([(str(r[0]), text(*r), i) for i, r in enumerate(rows)],
                                  "key string, value string, n long")
    log = with_log_position(frame.withColumn("topic", F.lit("temperature-topic")), "n").coalesce(1)
    write_file_log(log, path)
    fresh = [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    newest = max(fresh, key=os.path.getctime)
    os.utime(newest, (1_700_000_000 + step, 1_700_000_000 + step))


@pytest.fixture
def late_log(spark, folder):
    path = folder("log")
    for step, batch in enumerate(BATCHES):
        append(spark, path, [(2, s, v) for s, v in batch], step)
        time.sleep(0.05)
    return path


@pytest.mark.parametrize(
    "strict,windows,dropped",
    [(False, DEFAULT, [0, 0, 8, 9, 0]), (True, STRICT, [0, 10, 9, 10, 0])],
)
def test_late_rows(spark, folder, late_log, strict, windows, dropped):
    messages = read_file_log(spark, late_log, streaming=True, max_files_per_trigger=1)
    out = folder("out")
    query = start_overheat(
        messages, out, name="late", checkpoint=folder("cp"), strict=strict, mean_type="double"
    )
    query.awaitTermination(120)
    schema = overheat(read_file_log(spark, late_log), mean_type="double").schema
    rows = read_batches(spark, out, schema).collect()
    got = {int((r.window_start - ORIGIN).total_seconds()): (r.mean_temp, r.n) for r in rows}
    assert len(rows) == len(got)
    assert got == windows
    assert late_rows(query) == dropped
    assert spark.conf.get(ALLOW_MULTIPLE, None) is None


@pytest.mark.parametrize("strict", [False, True])
def test_late_rows_are_told_with_their_windows(spark, folder, late_log, strict):
    """As many (row, window) pairs as Spark says it dropped, and just those that the results lack."""
    messages = read_file_log(spark, late_log, streaming=True, max_files_per_trigger=1)
    out, checkpoint, ledger = folder("out"), folder("cp"), folder("ledger")
    query = start_overheat(
        messages, out, name="told", checkpoint=checkpoint, strict=strict, ledger=ledger, mean_type="double"
    )
    query.awaitTermination(120)
    envelope = spark.read.schema(ENVELOPE).parquet(late_log).select("*", F.col("_metadata.file_path").alias("file"))
    rows = good_readings(decode(envelope))
    late = late_windows(
        rows, checkpoint=checkpoint, ledger=ledger, file="file", time="event_time", size="10 seconds",
        slide="1 second", strict=strict,
    ).collect()
    assert sum(len(r.missed) for r in late) == sum(late_rows(query)) > 0
    windows = STRICT if strict else DEFAULT
    told = {}
    for r in late:
        assert r.too_late == (len(r.missed) == 10)
        for start in r.missed:
            key = int((start - ORIGIN).total_seconds())
            told[key] = told.get(key, 0) + 1
    seconds = [s for batch in BATCHES for s, _ in batch]
    for start in {s - k for s in seconds for k in range(10)} - set(range(20, 40)):  # open at the end
        there = sum(start <= s < start + 10 for s in seconds)
        assert windows.get(start, (0, 0))[1] + told.get(start, 0) == there


def test_finished_windows_follow_a_stream_that_goes_on(spark, folder):
    path, out, checkpoint = folder("log"), folder("out"), folder("cp")
    job = {"mean_type": "double"}

    def finish(step, seconds):
        append(spark, path, [(k, s, 50 + (7 * s + k) % 51) for s in seconds for k in (2, 3)], step)
        messages = read_file_log(spark, path, streaming=True)
        start_overheat(messages, out, name="end", checkpoint=checkpoint, **job).awaitTermination(120)
        finish_overheat(messages, out, checkpoint=checkpoint, **job)
        return overheat(read_file_log(spark, path), **job)

    for step, seconds in enumerate([range(25), range(25, 60)]):
        whole = finish(step, seconds)
        got = finished_windows(spark, out, whole.schema)
        assert same(got, whole) and got.count() == whole.count()
        closed = read_batches(spark, out, whole.schema)
        assert 0 < closed.count() < whole.count()
    # Going on without finishing again: what has closed since is not there twice.
    append(spark, path, [(2, 500, 60)], 2)
    messages = read_file_log(spark, path, streaming=True)
    start_overheat(messages, out, name="end", checkpoint=checkpoint, **job).awaitTermination(120)
    got = finished_windows(spark, out, whole.schema)
    assert got.count() == got.select(*KEYS).distinct().count() == whole.count()


def test_open_windows_need_the_measures_that_were_kept(spark, folder, log):
    checkpoint = folder("cp")
    messages = read_file_log(spark, log, streaming=True)
    start_overheat(messages, folder("out"), name="other", checkpoint=checkpoint).awaitTermination(120)
    with pytest.raises(ValueError, match="keeps 7 states"):
        overheat(messages, open_in=checkpoint, decimals=2).collect()


def test_open_windows_by_arrival(spark, folder, log):
    checkpoint, out = folder("cp"), folder("out")
    messages = read_file_log(spark, log, streaming=True)
    job = {"arrival": ("partition", "offset"), "mean_type": "double"}
    start_overheat(messages, out, name="places", checkpoint=checkpoint, **job).awaitTermination(120)
    finish_overheat(messages, out, checkpoint=checkpoint, **job)
    whole = overheat(read_file_log(spark, log), **job)
    assert same(finished_windows(spark, out, whole.schema), whole)


def test_alerts_are_withdrawn_when_a_window_cools(spark, folder):
    path, out, checkpoint = folder("log"), folder("out"), folder("cp")
    job = {"mean_type": "double", "delay": "1 hour"}

    def run():
        messages = read_file_log(spark, path, streaming=True)
        start_overheat(
            messages, out, name="w", checkpoint=checkpoint, mode="update", alerts_only=True, **job
        ).awaitTermination(120)
        schema = overheat(messages, **job).schema
        whole = overheat(read_file_log(spark, path), alerts_only=True, mean_type="double")
        assert same(current_alerts(spark, out, schema), whole)
        return read_changes(spark, out, schema), current_alerts(spark, out, schema)

    append(spark, path, [(3, 0, 10)], 0)
    changes, alerts = run()
    assert changes.count() == alerts.count() == 0
    append(spark, path, [(2, 0, 99)], 1)
    changes, alerts = run()
    assert alerts.count() == changes.count() == 10
    append(spark, path, [(2, 1, 10)], 2)  # nine of the ten windows cool down, one more is cool at once
    changes, alerts = run()
    assert [r.window_start for r in alerts.collect()] == [ORIGIN - timedelta(seconds=9)]
    assert changes.where("change = 'withdrawn'").count() == 9 and changes.count() == 19
    append(spark, path, [(2, 2, 400), (3, 1, 10)], 3)  # and are hot again
    changes, alerts = run()
    assert alerts.count() == 11 and changes.where("change = 'withdrawn'").count() == 9


def test_strict_setting_is_restored(spark):
    spark.conf.set(ALLOW_MULTIPLE, "true")
    with strict_lateness(spark):
        assert spark.conf.get(ALLOW_MULTIPLE) == "false"
    assert spark.conf.get(ALLOW_MULTIPLE) == "true"
    spark.conf.unset(ALLOW_MULTIPLE)


@pytest.fixture
def log(spark, folder):
    """Ten minutes of two sensors in three files, times ascending across files."""
    path = folder("log")
    for step in range(3):
        seconds = range(step * 40, step * 40 + 40)
        append(spark, path, [(k, s, 50 + (7 * s + k) % 51) for s in seconds for k in (2, 3)], step)
        time.sleep(0.05)
    return path


def stats_of(spark, path, log):
    schema = overheat(read_file_log(spark, log), mean_type="double").schema
    return read_batches(spark, path, schema)


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_resume_equals_one_run(spark, folder, log):
    """A query that is killed after its first batch and resumed loses and repeats nothing."""
    whole, parts, checkpoint = folder("whole"), folder("parts"), folder("cp")

    def run(path, cp, write=None):
        messages = read_file_log(spark, log, streaming=True, max_files_per_trigger=1)
        return start_batches(
            overheat(messages, mean_type="double"),
            write or batch_store(path),
            name="resume",
            checkpoint=cp,
        )

    run(whole, folder("cp")).awaitTermination(120)
    store = batch_store(parts)

    def dies_after_write(batch, batch_id):
        store(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("executor lost")

    with pytest.raises(Exception, match="executor lost"):
        run(parts, checkpoint, dies_after_write).awaitTermination(120)
    run(parts, checkpoint).awaitTermination(120)
    assert same(stats_of(spark, whole, log), stats_of(spark, parts, log))


def test_append_equals_batch_up_to_the_watermark(spark, folder, log):
    out = folder("out")
    messages = read_file_log(spark, log, streaming=True, max_files_per_trigger=1)
    start_overheat(messages, out, name="append", checkpoint=folder("cp"), mean_type="double").awaitTermination(120)
    batch = overheat(read_file_log(spark, log), mean_type="double")
    last = ORIGIN + timedelta(seconds=119)
    closed = batch.where(F.col("window_end") <= F.lit(last - timedelta(seconds=2)))
    assert same(stats_of(spark, out, log).drop("batch_id"), closed)


def test_each_state_is_looked_up_once(spark, folder, log):
    """A put or a removal does not look its key up again, as it does where keys are counted."""
    stats = overheat(read_file_log(spark, log, streaming=True))
    query = start_batches(stats, batch_store(folder()), name="lookups", checkpoint=folder("c"))
    query.awaitTermination()
    kept = [op for progress in query.recentProgress for op in progress["stateOperators"]]
    assert sum(op["numRowsRemoved"] for op in kept) > 0
    assert 0 < sum(op["customMetrics"]["rocksdbGetCount"] for op in kept) <= sum(op["numRowsUpdated"] for op in kept)


def test_update_equals_batch(spark, folder, log):
    out = folder("out")
    messages = read_file_log(spark, log, streaming=True, max_files_per_trigger=1)
    start_overheat(
        messages, out, name="update", checkpoint=folder("cp"), mode="update", mean_type="double"
    ).awaitTermination(120)
    revisions = stats_of(spark, out, log)
    latest = latest_revisions(revisions, KEYS)
    assert revisions.count() > latest.count()
    assert same(latest, overheat(read_file_log(spark, log), mean_type="double"))


def test_log_time_windows(spark, folder, log):
    """Windows by the log's own time: all rows of a file arrived at one instant."""
    batch = overheat(read_file_log(spark, log), time=LOG)
    arrivals = read_file_log(spark, log).groupBy("key", "timestamp").count().count()
    assert batch.agg(F.sum("n")).first()[0] == 2400
    assert batch.count() <= 10 * arrivals
    out = folder("out")
    start_overheat(
        read_file_log(spark, log, streaming=True), out, name="log-time", checkpoint=folder("cp"),
        mode="update", time=LOG,
    ).awaitTermination(120)
    assert stats_of(spark, out, log).agg(F.sum("n")).first()[0] == 2400


def test_live_clock(spark, folder, log):
    out = folder("out")
    messages = read_file_log(spark, log, streaming=True, max_files_per_trigger=1)
    query = start_overheat(
        messages, out, name="clock", checkpoint=folder("cp"), mode="update", time=CLOCK,
        every="1 second", delay="0 seconds",
    )
    deadline = time.time() + 90
    while time.time() < deadline and sum(p["numInputRows"] for p in query.recentProgress) < 240:
        time.sleep(0.5)
    query.stop()
    latest = latest_revisions(stats_of(spark, out, log), KEYS)
    assert latest.agg(F.sum("n")).first()[0] == 2400
    with pytest.raises(ValueError):
        overheat(messages, time="wall")


def test_archive_then_recompute(spark, folder):
    log, store = folder("log"), folder("store")
    rows = [(i % 4, 0, 1.0, 2.0, 3.0, "humidity" if i % 4 < 2 else "temperature",
             (ORIGIN + timedelta(seconds=i // 4)).strftime("%Y-%m-%d %H:%M:%S"), float(50 + i % 51))
            for i in range(400)]
    readings = spark.createDataFrame(rows, READING)
    publish_to_files(readings, log, partitions=2)
    for _ in range(2):  # the second run finds nothing new
        start_archive(
            read_file_log(spark, log, streaming=True), store, checkpoint=f"{store}-cp"
        ).awaitTermination(120)
    assert find(spark, store, "temperature").count() == 200
    assert find(spark, store, "humidity").count() == 200
    hot = recompute(spark, store, mean_type="double")
    assert same(hot, overheat(read_file_log(spark, log, ["temperature-topic"]), mean_type="double"))
    files = find(spark, store, "temperature").inputFiles()
    assert files and all("collection=temperature" in f for f in files)


def test_alert_table(spark, folder, late_log):
    out = folder("alerts")
    messages = read_file_log(spark, late_log, streaming=True)
    start_overheat(
        messages, out, name="alerts", checkpoint=folder("cp"), alerts_only=True, files_per_batch=1
    ).awaitTermination(120)
    rows = stats_of(spark, out, late_log).collect()
    assert rows and all(r.hot for r in rows)
    batches = [d for d in os.listdir(out) if d.startswith("batch_id=")]
    for batch in batches:
        assert len([f for f in os.listdir(f"{out}/{batch}") if f.endswith(".parquet")]) == 1


@pytest.mark.parametrize("file_format", ["csv", "json", "parquet"])
def test_result_files(spark, folder, log, file_format):
    out = folder(file_format)
    messages = read_file_log(spark, log, streaming=True)
    stats = overheat(messages, mean_type="double")
    start_files(
        stats, out, name="files", checkpoint=folder("cp"), file_format=file_format, max_records_per_file=20
    ).awaitTermination(120)
    back = spark.read.schema(stats.schema).format(file_format).load(out)
    last = ORIGIN + timedelta(seconds=117)
    closed = overheat(read_file_log(spark, log), mean_type="double").where(F.col("window_end") <= F.lit(last))
    assert same(back, closed)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) >= closed.count() // 20


def test_heat_and_quarantine_streams_share_out_all_messages(spark, folder, messages):
    log, heat, aside = folder("log"), folder("heat"), folder("aside")
    texts = [text(2, 0, 95), "nope", '{"id":3}', None, text(2, 1, 95)]
    write_file_log(messages(texts), log)
    stream = read_file_log(spark, log, streaming=True)
    start_overheat(stream, heat, name="heat", checkpoint=folder("cp"), mode="update").awaitTermination(120)
    start_quarantine(stream, aside, checkpoint=folder("cp")).awaitTermination(120)
    assert stats_of(spark, heat, log).agg(F.sum("n")).first()[0] == 20
    rows = {r.raw: r.missing for r in read_batches(spark, aside, QUARANTINED).collect()}
    assert rows == {
        "nope": "sensor_id,event_time,value",
        '{"id":3}': "event_time,value",
        None: "sensor_id,event_time,value",
    }


def test_batches_are_limited_by_bytes_and_files(spark, folder, log):
    for limit in ({"max_bytes_per_trigger": 1}, {"max_files_per_trigger": 1}):
        messages = read_file_log(spark, log, streaming=True, **limit)
        seen = []
        start_batches(
            messages, lambda batch, n: seen.append(batch.count()), name="limited", checkpoint=folder("cp")
        ).awaitTermination(120)
        assert seen == [80, 80, 80]


def test_arrival_order_in_a_stream(spark, folder):
    """First and last reading by log offset, not by time."""
    log, out = folder("log"), folder("out")
    append(spark, log, [(2, s, 50) for s in (3, 1, 5, 2)], 0)
    messages = read_file_log(spark, log, streaming=True)
    start_overheat(
        messages, out, name="arrival", checkpoint=folder("cp"), mode="update",
        arrival=("partition", "offset"),
    ).awaitTermination(120)
    rows = {r.window_start: r for r in latest_revisions(stats_of(spark, out, log), KEYS).collect()}
    row = rows[ORIGIN]
    assert (row.first_ts[-2:], row.last_ts[-2:], row.n) == ("03", "02", 4)


def test_unknown_file_format(spark, log):
    with pytest.raises(ValueError):
        start_files(read_file_log(spark, log, streaming=True), "x", name="x", checkpoint="y", file_format="xml")


def test_console_and_memory(spark, folder, log):
    messages = read_file_log(spark, log, streaming=True)
    query = start_console(overheat(messages), name="console", mode="update")
    query.awaitTermination(120)
    assert query.exception() is None
    timed = with_event_time(
        messages.select(F.col("key").alias("sensor_id"), F.col("offset").cast("double").alias("value"), "timestamp"),
        F.col("timestamp"),
        delay="0 seconds",
    )
    memory = (
        overheat_stats(timed).writeStream.outputMode("complete").format("memory").queryName("mem")
        .trigger(availableNow=True).start()
    )
    memory.awaitTermination(120)
    assert spark.table("mem").agg(F.sum("n")).first()[0] == 2400


def test_revisions_are_sorted_once(spark, folder, capsys):
    """Of three batches, with keys that are null and keys that only one batch has."""
    path = folder()
    rows = [(k or None, batch, f"{batch}-{k}", 7 * batch + k) for batch in range(3) for k in range(7)]
    frame = spark.createDataFrame([*rows, (99, 1, "alone", -1)], "k int, batch_id long, text string, n long")
    frame.repartition(5).write.parquet(path)
    latest = latest_revisions(spark.read.parquet(path), ["k"])
    latest.explain()
    assert capsys.readouterr().out.count("Sort [") == 1
    found = sorted(map(tuple, latest.collect()), key=str)
    assert found == sorted([(k or None, f"2-{k}", 14 + k) for k in range(7)] + [(99, "alone", -1)], key=str)


def state_files(checkpoint):
    """Endings of the state's files in a checkpoint, and its number of partitions."""
    kinds = {f.rsplit(".", 1)[-1] for _, _, fs in os.walk(f"{checkpoint}/state") for f in fs if not f.startswith(".")}
    return kinds & {"zip", "changelog"}, len([d for d in os.listdir(f"{checkpoint}/state/0") if d.isdigit()])


def test_a_run_over_what_is_there_keeps_its_state(spark, folder):
    """Not its changes, which the next run would make again; one that goes on keeps those. Either takes up the other's."""
    path, out, checkpoint = folder("slices"), folder("out"), folder("cp")
    rng = range(400)
    rows = [(k % 7, (ORIGIN + timedelta(seconds=k // 3)), float(k % 50)) for k in rng]
    kinds = []
    for part, every in enumerate([None, "1 second", None, None]):
        frame = spark.createDataFrame(rows[part * 100 : part * 100 + 100], "sensor_id int, ts timestamp, value double")
        frame.coalesce(1).write.mode("append").parquet(path)
        readings = with_event_time(spark.readStream.schema(frame.schema).parquet(path), F.col("ts"))
        stats = overheat_stats(readings, decimals=2)
        query = start_batches(
            stats, batch_store(out), name="turns", checkpoint=checkpoint, mode="update", every=every, partitions=5 + part
        )
        if every:
            query.processAllAvailable()
            query.stop()
        else:
            query.awaitTermination(120)
        kinds.append(state_files(checkpoint))
    assert kinds[0] == ({"zip"}, 5) and kinds[-1] == ({"zip", "changelog"}, 5)
    whole = spark.createDataFrame(rows, "sensor_id int, event_time timestamp, value double")
    assert same(latest_revisions(read_batches(spark, out, stats.schema), KEYS), overheat_stats(whole, decimals=2))


def test_state_goes_by_the_windows(spark, folder, log):
    """A session's own number of partitions is taken where it is greater."""
    assert state_partitions(0, "10 hours", "1 hour") == 1
    assert state_partitions(36_000_000, "10 hours", "1 hour") == 180
    assert state_partitions(1_000_001, "5 hours", "2 hours") == 2
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 4
    for partitions, wanted in ((None, 4), (2, 4), (9, 9)):
        checkpoint = folder("cp")
        stats = overheat(read_file_log(spark, log, streaming=True))
        start_batches(
            stats, batch_store(folder("out")), name="parts", checkpoint=checkpoint, partitions=partitions
        ).awaitTermination(120)
        assert state_files(checkpoint)[1] == wanted
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 4


def test_revisions_by_their_number(spark, folder, monkeypatch):
    """Tasks go by the rows, which a hash before the keys orders by one number; equal hashes would not mix keys."""
    path = folder()
    rows = [(k % 40, None if k % 40 == 3 else k % 11, k // 440, f"{k}") for k in range(1320)]
    spark.createDataFrame(rows, "a int, b int, batch_id long, text string").write.parquet(path)
    newest = {(a, b): text for a, b, batch, text in sorted(rows, key=lambda r: (r[2], int(r[3])))}
    monkeypatch.setattr(sinks, "REVISIONS_PER_TASK", 60)
    latest = latest_revisions(spark.read.parquet(path).dropDuplicates(["a", "b", "batch_id"]), ["a", "b"])
    assert latest.rdd.getNumPartitions() == 22
    assert {(r.a, r.b) for r in latest.collect()} == set(newest) and latest.columns == ["a", "b", "text"]
    assert "xxhash64" in latest._jdf.queryExecution().toString().split("Physical Plan")[1]
    monkeypatch.setattr(sinks.F, "xxhash64", lambda *_: F.lit(7).cast("bigint"))
    again = latest_revisions(spark.read.parquet(path).where(F.col("b").isNotNull()), ["a", "b"])
    assert sorted(map(tuple, again.collect())) == sorted((a, b, t) for (a, b), t in newest.items() if b is not None)
