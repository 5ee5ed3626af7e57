from pyspark.sql import functions as F

from sensorstream.operators.series import STEPS_PER_BLOCK, series_grid
from sensorstream.operators.windows import overheat_stats


def sensors(spark, seconds):
    return spark.range(3).select(
        F.col("id").cast("int").alias("sensor_id"),
        F.timestamp_seconds(F.lit(1262435100)).alias("start"),
        F.timestamp_seconds(F.lit(1262435100 + seconds - 1)).alias("end"),
    )


def test_grid_covers_blocks_without_gaps(spark):
    steps = 2 * STEPS_PER_BLOCK + 7
    grid = series_grid(sensors(spark, steps))
    assert grid.count() == grid.distinct().count() == 3 * steps
    bounds = grid.agg(F.unix_seconds(F.min("event_time")), F.unix_seconds(F.max("event_time"))).first()
    assert tuple(bounds) == (1262435100, 1262435100 + steps - 1)


def test_empty_span(spark):
    assert series_grid(sensors(spark, 0)).isEmpty()


def test_ten_minutes_give_609_windows_per_sensor(spark):
    grid = series_grid(sensors(spark, 600)).withColumn("value", F.lit(70.0))
    per_sensor = overheat_stats(grid).groupBy("sensor_id").count().collect()
    assert [r["count"] for r in per_sensor] == [609] * 3
