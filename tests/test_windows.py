from collections import defaultdict
from datetime import datetime, timedelta
from statistics import mean

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorstream.functions.aggregates import Measure, count_rows, rounded_mean
from sensorstream.functions.eventtime import event_time_from_millis, with_event_time
from sensorstream.functions.intervals import micros
from sensorstream.operators import windows
from sensorstream.operators.ordered import longest_run, ordered_windows
from sensorstream.operators.windows import (
    overheat_alerts,
    overheat_stats,
    sliding_windows,
    window_counts,
)
from sensorstream.sources.files import keyed_millis

ORIGIN = datetime(2010, 1, 2, 12, 25, 0)
PLANS = ["direct", "panes"]


def offsets(rows):
    return {int((r.window_start - ORIGIN).total_seconds()): r for r in rows}


@pytest.mark.parametrize("plan", PLANS)
def test_count_example(spark, plan):
    rows = keyed_millis(spark, [("hi", ms) for ms in (1, 2, 3, 4, 5, 8, 9, 15)])
    timed = with_event_time(rows, event_time_from_millis(F.col("ms")), delay=None)
    got = {(r.window_start_ms, r.window_end_ms): r.n for r in window_counts(timed, plan=plan).collect()}
    assert got == {
        (-2, 3): 2, (0, 5): 4, (2, 7): 4, (4, 9): 3, (6, 11): 2, (8, 13): 2, (12, 17): 1, (14, 19): 1,
    }


@pytest.mark.parametrize("plan", PLANS)
def test_dense_series(readings, plan):
    stats = overheat_stats(readings([(1, s, 75) for s in range(600)]), plan=plan)
    counts = [r.n for r in stats.collect()]
    assert len(counts) == 609
    assert sum(counts) == 6000
    assert counts.count(10) == 591
    assert all(counts.count(n) == 2 for n in range(1, 10))


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("decimals", [None, 3])
def test_threshold_edges(readings, plan, decimals):
    values = {2: [90, 90], 3: [89, 100], 4: [89, 91.0008], 5: [89, 91], 6: [95], 7: [89]}
    if decimals:
        del values[4]  # four decimals: outside the exact mean's contract
    rows = readings([(k, 0, v) for k, vs in values.items() for v in vs])
    stats = overheat_stats(rows, plan=plan, decimals=decimals, mean_type="double")
    got = defaultdict(set)
    for r in stats.collect():
        got[r.sensor_id].add((r.mean_temp, r.overheat_constant, r.hot, r.n))
    expected = {
        2: {(90.0, True, True, 2)},
        3: {(94.5, False, True, 2)},
        4: {(90.0, False, False, 2)},
        5: {(90.0, False, False, 2)},
        6: {(95.0, True, True, 1)},
        7: {(89.0, False, False, 1)},
    }
    assert got == {k: expected[k] for k in values}
    assert stats.count() == 10 * len(values)
    assert {r.sensor_id for r in overheat_alerts(stats).collect()} == {2, 3, 6}


def test_min_count_keeps_thin_windows_quiet(readings):
    rows = readings([(1, 0, 95), (1, 5, 95)])
    alerts = overheat_alerts(overheat_stats(rows, min_count=2))
    assert {r.n for r in alerts.collect()} == {2}
    assert alerts.count() == 5


@pytest.mark.parametrize("plan", PLANS)
def test_arrival_order(readings, plan):
    rows = readings([(1, 3, 50, 0), (1, 1, 50, 1), (1, 5, 50, 2), (1, 2, 50, 3)])
    by_arrival = offsets(overheat_stats(rows, arrival=("partition", "offset"), plan=plan).collect())
    by_time = offsets(overheat_stats(rows, plan=plan).collect())

    def edges(row):
        return row.first_ts[-2:], row.last_ts[-2:], row.n

    assert edges(by_arrival[0]) == ("03", "02", 4)
    assert edges(by_time[0]) == ("01", "05", 4)
    assert edges(by_arrival[-6]) == ("03", "02", 3)
    assert edges(by_time[-6]) == ("01", "03", 3)
    assert edges(offsets(overheat_stats(rows, arrival="offset", plan=plan).collect())[0]) == ("03", "02", 4)


def test_result_schema(readings):
    stats = overheat_stats(readings([(1, 0, 95)]))
    assert stats.schema.simpleString() == (
        "struct<sensor_id:int,window_start:timestamp,window_end:timestamp,mean_temp:float,"
        "overheat_constant:boolean,first_ts:string,last_ts:string,n:bigint,hot:boolean>"
    )


def test_rounding_matches_for_whole_values(spark):
    """Means of up to ten whole readings round as Python rounds them."""
    sums = [(s, n) for n in range(1, 11) for s in range(50 * n, 100 * n + 1)]
    frame = spark.createDataFrame(sums, "s long, n long")
    for r in frame.select("s", "n", F.round(F.col("s") / F.col("n"), 3).alias("m")).collect():
        assert r.m == round(r.s / r.n, 3)


def test_exact_mean_rounds_half_away_from_zero(spark):
    rows = [(1, 8.01), (1, 8.015), (2, -8.01), (2, -8.015), (3, 0.0)]
    frame = spark.createDataFrame(rows, "k int, v double")
    measure = rounded_mean("v", decimals=3)
    states = frame.groupBy("k").agg(*[c.alias(n) for n, c in measure.fold.items()])
    got = {r.k: r.m for r in states.select("k", measure.result.alias("m")).collect()}
    assert got == {1: 8.013, 2: -8.013, 3: 0.0}
    with pytest.raises(ValueError):
        rounded_mean("v", decimals=4)


def test_more_places_than_stated_stop_the_job(readings):
    with pytest.raises(Exception, match="more than 2 decimal places"):
        overheat_stats(readings([(1, 0, 90.125)]), decimals=2).collect()


def test_default_mean_depends_on_no_plan(spark):
    rows = spark.range(20_000).select(
        (F.col("id") % 7).cast("int").alias("sensor_id"),
        F.timestamp_seconds(F.lit(1262435100) + F.col("id") % 300).alias("event_time"),
        (F.rand(3) * 100).alias("value"),
    )
    panes = overheat_stats(rows, plan="panes", mean_type="double")
    direct = overheat_stats(rows.repartition(13), plan="direct", mean_type="double")
    assert panes.exceptAll(direct).isEmpty() and direct.exceptAll(panes).isEmpty()


@pytest.mark.parametrize("plan", ["panes", "direct"])
def test_a_key_called_window(readings, plan):
    rows = readings([(1, 0, 50), (1, 3, 70)]).withColumnRenamed("sensor_id", "window")
    assert overheat_stats(rows, key="window", plan=plan).where("n = 2").count() == 7


def test_first_and_last_are_the_readings_own(readings):
    rows = readings([(1, 1, 50), (1, 5, 70)]).withColumn("taken", F.timestamp_seconds(F.lit(1262440000)))
    stats = overheat_stats(rows, time="taken", reading_time="event_time")
    assert {(r.first_ts, r.last_ts) for r in stats.collect()} == {("2010-01-02 12:25:01", "2010-01-02 12:25:05")}


def test_nan_is_not_hot(readings):
    stats = overheat_stats(readings([(1, 0, float("nan"))])).collect()
    assert len(stats) == 10
    assert not any(r.hot or r.overheat_constant for r in stats)


@pytest.mark.parametrize(
    "text,length", [("10 seconds", 10_000_000), ("1 hour", 3_600_000_000), ("5 milliseconds", 5_000)]
)
def test_intervals(text, length):
    assert micros(text) == length


@pytest.mark.parametrize("text", ["1 month", "ten seconds", "seconds", "-1 second"])
def test_no_interval(text):
    with pytest.raises(ValueError):
        micros(text)


def test_session_zone_must_be_utc(spark, readings):
    rows = readings([(1, 0, 95)])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            overheat_stats(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_pane_plan_shuffles_before_it_spreads(readings):
    """Two exchanges, and rows multiply only behind the second."""
    stats = overheat_stats(readings([(1, 0, 95)]))
    plan = stats._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    spread = plan.index("start#")
    assert spread < plan.index("Exchange hashpartitioning")
    assert "SortAggregate" not in plan
    assert "BatchEvalPython" not in plan


def brute_force(rows, size, slide):
    groups = defaultdict(list)
    for key, at, value in rows:
        start = at // slide * slide
        while start > at - size:
            groups[key, start].append((at, value))
            start -= slide
    return {
        place: (
            round(mean(v for _, v in group), 3),
            all(v > 89.0 for _, v in group),
            min(at for at, _ in group),
            max(at for at, _ in group),
            len(group),
        )
        for place, group in groups.items()
    }


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.tuples(st.integers(0, 2), st.integers(-120, 400), st.integers(85, 95)),
        min_size=1,
        max_size=40,
    ),
    shape=st.sampled_from([(10, 1), (5, 2), (10, 10), (7, 3), (3, 5), (60, 1)]),
)
def test_plans_match_brute_force(spark, rows, shape):
    size, slide = shape
    frame = spark.createDataFrame(rows, "sensor_id int, s long, value long").select(
        "sensor_id", F.timestamp_seconds("s").alias("event_time"), F.col("value").cast("double")
    )
    expected = brute_force(rows, size, slide)
    plans = PLANS if size >= slide else ["panes"]
    for plan in plans:
        stats = overheat_stats(
            frame, size=f"{size} seconds", slide=f"{slide} seconds", plan=plan, mean_type="double"
        )
        seconds = stats.select(
            "sensor_id",
            F.unix_seconds("window_start").alias("start"),
            "mean_temp",
            "overheat_constant",
            F.unix_timestamp("first_ts").alias("first"),
            F.unix_timestamp("last_ts").alias("last"),
            "n",
        ).collect()
        assert len(seconds) == len(expected)
        assert {(r.sensor_id, r.start): tuple(r)[2:] for r in seconds} == expected


def test_hot_key_same_result(spark):
    """One sensor with almost all rows, many in one pane, across many blocks."""
    hot = spark.range(60_000).select(
        F.lit(1).alias("sensor_id"), (F.col("id") % 5_000).alias("s"), (F.col("id") % 7 + 86).alias("v")
    )
    burst = spark.range(40_000).select(F.lit(1), F.lit(2_500), F.lit(90))
    cold = spark.range(200).select((F.col("id") + 2), F.col("id") * 30, F.lit(95))
    frame = hot.union(burst).union(cold).select(
        "sensor_id", F.timestamp_seconds("s").alias("event_time"), F.col("v").cast("double").alias("value")
    )
    direct = overheat_stats(frame, plan="direct", decimals=0)
    panes = overheat_stats(frame, plan="panes", decimals=0)
    assert direct.exceptAll(panes).isEmpty() and panes.exceptAll(direct).isEmpty()
    assert direct.count() == 5_009 + 200 * 10


def test_zoneless_times_keep_their_type(spark):
    frame = spark.sql("SELECT 1 AS sensor_id, timestamp_ntz'1969-12-31 23:59:58' AS event_time, 95D AS value")
    got = overheat_stats(frame)
    assert got.schema["window_start"].dataType.simpleString() == "timestamp_ntz"
    starts = sorted(r.window_start for r in got.collect())
    assert starts == [datetime(1969, 12, 31, 23, 59, 49) + timedelta(seconds=i) for i in range(10)]


@pytest.mark.parametrize("plan", PLANS)
def test_own_window_function(readings, plan):
    """A caller's own measure: the spread of values, next to a built-in one."""
    spread = Measure(
        "spread",
        {"low": F.min("value"), "high": F.max("value")},
        {"low": F.min("low"), "high": F.max("high")},
        F.col("high") - F.col("low"),
    )
    rows = readings([(1, 0, 50), (1, 4, 80), (1, 12, 60)])
    windows = sliding_windows(
        rows, ["sensor_id"], "event_time", "10 seconds", "1 second", [spread, count_rows()], plan=plan
    )
    got = offsets(windows.collect())
    assert (got[0].spread, got[0].n) == (30.0, 2)
    assert (got[4].spread, got[4].n) == (20.0, 2)
    assert (got[5].spread, got[5].n) == (0.0, 1)


@pytest.mark.parametrize("key", ["pane", "block", "start"])
def test_keys_may_have_any_name(readings, key):
    rows = readings([(1, 0, 95), (2, 0, 85)]).withColumnRenamed("sensor_id", key)
    direct, panes = (overheat_stats(rows, key=key, plan=plan) for plan in PLANS)
    assert panes.count() == 20
    assert direct.exceptAll(panes).isEmpty() and panes.exceptAll(direct).isEmpty()


def test_pane_plan_is_for_batches(spark):
    stream = spark.readStream.format("rate").load().selectExpr(
        "1 AS sensor_id", "timestamp AS event_time", "1D AS value"
    )
    with pytest.raises(ValueError):
        overheat_stats(stream, plan="panes")
    with pytest.raises(ValueError):
        sliding_windows(stream, ["sensor_id"], "event_time", "1 second", "1 second", [], plan="other")


@pytest.mark.parametrize("plan", ["panes", "direct"])
def test_mean_of_huge_values(spark, readings, plan):
    """Neither sum of the mean leaves its decimal; whole and fractional parts stay exact."""
    rows = [(1, k / 10, 9e18) for k in range(30)]
    rows += [(2, 0, 9.9e18), (2, 1, 9.9e18), (3, 0, -9e18), (3, 1, 9e18), (3, 2, 0.0015)]
    rows += [(4, 0, 1e19), (4, 1, 1e19), (5, 0, -0.0005), (5, 1, -0.0005), (6, 0, -1.9), (6, 1, 0.1)]
    rows += [(7, 0, 0.1), (7, 1, 0.2), (7, 2, 1e15)]
    stats = overheat_stats(readings(rows), size="10 seconds", slide="10 seconds", mean_type="double", plan=plan)
    got = {r.sensor_id: r.mean_temp for r in stats.where("window_start <= '2010-01-02 12:25:00'").collect()}
    assert got == {1: 9e18, 2: 9.9e18, 3: 0.001, 4: 1e19, 5: -0.001, 6: -0.9, 7: 333333333333333.433}


@pytest.mark.parametrize("arrival", [None, ("partition", "offset")])
def test_no_task_holds_more_windows_as_rows_grow(readings, monkeypatch, arrival):
    """More rows make more tasks, whatever number of partitions the session names."""
    monkeypatch.setattr(windows, "WINDOWS_PER_TASK", 2_000)
    for sensors in (300, 1200):
        rows = readings([(k, 60 * s, 50) for k in range(sensors) for s in range(2)])
        stats = overheat_stats(rows, arrival=arrival)
        held = [r["count"] for r in stats.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(held) == 20 * sensors
        assert max(held) < 4_000
    runs = ordered_windows(rows, ["sensor_id"], "event_time", "10 seconds", "1 second", longest_run("value", 40.0))
    held = [r["count"] for r in runs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 20 * 1200 and max(held) < 4_000
