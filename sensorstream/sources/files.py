"""Files: reading dumps, the location dimension and the file log."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorstream.functions.keys import log_partition
from sensorstream.sources.arrays import array_elements
from sensorstream.schemas import ENVELOPE, KEYED_MILLIS, LOCATION, LOCATION_HEADER, READING


def keyed_millis(spark: SparkSession, rows: Iterable[tuple[str, int]]) -> DataFrame:
    """A bounded in-memory collection of (key, milliseconds)."""
    return spark.createDataFrame(list(rows), KEYED_MILLIS)


def read_readings(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """Readings from JSON files.

    By default a file is one array of readings, ``lines=True`` reads one object per line. Either way
    many tasks read a large file.
    """
    if lines:
        return spark.read.schema(READING).json(path)
    reading = F.from_json("value", READING, {"mode": "PERMISSIVE"})
    return array_elements(spark, path).select(F.inline(F.array(reading)))


def read_messages(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """The texts (``value``) of the objects in JSON files, as they are written there."""
    texts = spark.read.text(path) if lines else array_elements(spark, path)
    return texts.select("value").where(F.trim("value") != "")


def write_arrays(texts: DataFrame, path: str, *, mode: str = "error") -> None:
    """Texts of objects (``value``) as files of one JSON array each, one object to a line."""
    places = texts.select("value").withColumn("part", F.spark_partition_id())
    row = F.monotonically_increasing_id()
    edges = Window.partitionBy("part").orderBy("row")
    lines = (
        places.withColumn("row", row)
        .withColumn("first", F.lag("row").over(edges).isNull())
        .withColumn("last", F.lead("row").over(edges).isNull())
    )
    open_, close = F.when(F.col("first"), "[").otherwise(""), F.when(F.col("last"), "]").otherwise(",")
    # A part stays in one task, and in order.
    framed = lines.sortWithinPartitions("part", "row").select(F.concat(open_, "value", close).alias("value"))
    framed.write.mode(mode).text(path)


def write_readings(readings: DataFrame, path: str, *, mode: str = "error") -> None:
    """Readings as JSON lines, sensor by sensor and in order of time.

    A file holds a range of (sensor, time), so the number of files follows the bytes, not the
    sensors, and several tasks write one hot sensor.
    """
    ranged = readings.select(*READING.names).repartitionByRange("id", "timestamp")
    ranged.sortWithinPartitions("id", "timestamp").write.mode(mode).json(path)


# One quoted text of a list literal, in either kind of quotes, with escapes.
QUOTED = r"""(?:'(?:[^'\\]|\\.)*+'|"(?:[^"\\]|\\.)*+")"""


def parse_features(literal: Column) -> Column:
    """The texts of a list literal; one that is no such list stops the job, null stays null."""
    whole = rf"(?s)^\s*\[\s*(?:{QUOTED}(?:\s*,\s*{QUOTED})*)?\s*\]\s*$"
    inner = F.transform(
        F.regexp_extract_all(literal, F.lit(f"(?s){QUOTED}"), 0),
        lambda t: F.regexp_replace(F.substring(t, F.lit(2), F.length(t) - 2), r"(?s)\\(.)", "$1"),
    )
    wrong = F.raise_error(F.concat(F.lit("no list of quoted texts: "), literal))
    return F.when(literal.rlike(whole), inner).when(literal.isNotNull(), wrong.cast("array<string>"))


def read_locations(spark: SparkSession, path: str) -> DataFrame:
    """The location CSV: quoted addresses span lines, topography is a list literal."""
    header = ", ".join(f"{name} STRING" for name in LOCATION_HEADER)
    rows = (
        spark.read.schema(header)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )
    features = parse_features(F.col("topography"))
    return rows.select(
        F.col("sensor_id").cast(LOCATION["location_id"].dataType).alias("location_id"),
        "address",
        features.alias("topography"),
    )


def write_locations(locations: DataFrame, path: str, *, mode: str = "error") -> None:
    """The location dimension in the CSV form that :func:`read_locations` reads."""
    escaped = F.transform("topography", lambda f: F.regexp_replace(f, r"([\\'])", r"\\$1"))
    quoted = F.transform(escaped, lambda f: F.concat(F.lit("'"), f, F.lit("'")))
    literal = F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
    (
        locations.select(
            F.col("location_id").alias(LOCATION_HEADER[0]),
            F.col("address").alias(LOCATION_HEADER[1]),
            literal.alias(LOCATION_HEADER[2]),
        )
        .write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )


def with_log_position(
    messages: DataFrame, order: str, *, partitions: int = 1, after: int = -1
) -> DataFrame:
    """Give ``(key, value, topic, <order>)`` rows a partition, an offset and a time.

    Equal keys share a partition and their offsets ascend with ``order``; offsets
    start behind ``after`` and may have gaps, as in a compacted log. Rows are
    range-partitioned, so the rows of one hot key are numbered by many tasks, and of
    equal ``order`` those of different keys.
    """
    placed = messages.withColumn("partition", log_partition(F.col("key"), partitions))
    by = ("topic", "partition", order, "key")
    numbered = (
        placed.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("offset", F.monotonically_increasing_id() + F.lit(after + 1))
        .withColumn("timestamp", F.current_timestamp())
    )
    return numbered.select(*ENVELOPE.names)


def last_offset(spark: SparkSession, path: str) -> int:
    """Greatest offset of a file log, -1 if it is empty or not there yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return -1
    last = read_file_log(spark, path).agg(F.max("offset")).first()[0]
    return -1 if last is None else last


def write_file_log(log: DataFrame, path: str, *, mode: str = "append") -> None:
    """Append envelope rows to a file log, one folder per topic."""
    log.select(*ENVELOPE.names).write.mode(mode).partitionBy("topic").parquet(path)


def read_file_log(
    spark: SparkSession,
    path: str,
    topics: Sequence[str] | None = None,
    *,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    splits: bool = False,
) -> DataFrame:
    """Messages of a file log; other topics' folders are not read. ``splits`` adds the name of each one's file."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if streaming and max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    split = [F.col("_metadata.file_name").alias("split")] if splits else []
    log = reader.schema(ENVELOPE).parquet(path).select(*ENVELOPE.names, *split)
    return log if topics is None else log.where(F.col("topic").isin(list(topics)))
