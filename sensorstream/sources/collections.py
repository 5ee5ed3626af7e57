"""Stored collections: one table of documents per topic, as Parquet.

Layout ``<store>/collection=<name>/day=<date>/batch_id=<n>/``. The batch folder makes the
streaming writer idempotent; collection and day (of the reading's time, null for a
document without one) are what a scan prunes by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from sensorstream.schemas import COLLECTIONS, DATABASE, READING

QUARANTINE = "quarantine"
POSITION = ("topic", "partition", "offset")

DOCUMENT = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("log_time", T.TimestampType()),
        T.StructField("sensor_id", T.IntegerType()),
        *[f for f in READING.fields if f.name != "id"],
        T.StructField("event_time", T.TimestampType()),
        # The message text as it came.
        T.StructField("raw", T.StringType()),
    ]
)
STORED = T.StructType(
    DOCUMENT.fields
    + [
        T.StructField("collection", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
FOLDERS = ("collection", "day")


def create_folders(spark: SparkSession, store: str) -> None:
    """Create the folder of each collection, so that empty ones can be scanned."""
    empty = spark.createDataFrame([], STORED).drop("collection")
    for name in (*COLLECTIONS, QUARANTINE):
        empty.write.mode("append").partitionBy("day", "batch_id").parquet(f"{store}/collection={name}")


def find(
    spark: SparkSession, store: str, collection: str, where: Column | None = None
) -> DataFrame:
    """All documents of a collection, or those that satisfy ``where``.

    Only the collection's own folders are listed, and a condition on ``day`` reads only those days. Compacted
    collections are read as of one snapshot (:mod:`~sensorstream.sources.compaction`).
    """
    from sensorstream.sources.compaction import documents_of

    documents = documents_of(spark, store, collection)
    found = documents if where is None else documents.where(where)
    return found.drop("day", "batch_id")


def distinct_positions(documents: DataFrame) -> DataFrame:
    """One document per log position.

    Needed only after a checkpoint was lost: the log is then read again from the
    start under new batch numbers.
    """
    return documents.dropDuplicates(list(POSITION))


def create_collections(spark: SparkSession, store: str, database: str = DATABASE) -> None:
    """Create each collection, empty, and declare it as a catalog table over its folder."""
    create_folders(spark, store)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in DOCUMENT.fields)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in COLLECTIONS:
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}, day DATE, batch_id BIGINT) "
            f"USING parquet PARTITIONED BY (day, batch_id) LOCATION '{store}/collection={name}'"
        )


def register_batch(spark: SparkSession, store: str, batch_id: int, database: str = DATABASE) -> None:
    """Make one written batch visible through the catalog tables, without listing the others."""
    for name in COLLECTIONS:
        pattern = spark._jvm.org.apache.hadoop.fs.Path(
            f"{store}/collection={name}/day=*/batch_id={batch_id}"
        )
        files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
        days = [str(s.getPath().getParent().getName())[len("day=") :] for s in files.globStatus(pattern)]
        parts = [
            f"PARTITION (day={'null' if day.startswith('__') else repr(day)}, batch_id={batch_id})"
            for day in sorted(days)
        ]
        if parts:
            spark.sql(f"ALTER TABLE {database}.{name} ADD IF NOT EXISTS {' '.join(parts)}")
            spark.catalog.refreshTable(f"{database}.{name}")


def refresh_collections(spark: SparkSession, database: str = DATABASE) -> None:
    """Make batches written since then visible through the catalog tables."""
    for name in COLLECTIONS:
        spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(f"{database}.{name}")
