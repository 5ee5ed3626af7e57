"""Sinks that may run a batch twice without storing it twice."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BatchWriter = Callable[[DataFrame, int], None]

#: Revisions that one task sorts.
REVISIONS_PER_TASK = 1_000_000


def batch_store(
    path: str, partition_by: Sequence[str] = (), files_per_batch: int | None = None
) -> BatchWriter:
    """Writer for ``foreachBatch``: batch n owns the folders ``batch_id=n``.

    A replayed batch replaces exactly those folders. That holds while the
    checkpoint fixes the batch boundaries. Each task of the stream writes its own
    file unless ``files_per_batch`` spreads the rows over that many tasks, which
    suits frequent small batches such as alerts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if files_per_batch is not None:
            # A shuffle, not coalesce: that would also shrink the stage that keeps state.
            batch = batch.repartition(files_per_batch)
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by, "batch_id")
            .parquet(path)
        )

    return write


RAISED, WITHDRAWN = "raised", "withdrawn"
CHANGE = T.StructField("change", T.StringType())


def change_log(
    path: str, schema: T.StructType, keys: Sequence[str], alive: Column, day: str, files_per_batch: int | None = None
) -> BatchWriter:
    """Writer for update-mode results of which only the rows that are ``alive`` count.

    A batch adds its alive rows as raised, and of the others those that earlier batches have raised, as
    withdrawn. The log is kept by the day of the column ``day``, one of the keys, so a batch looks
    up the days that it touches only. A replayed batch leaves out what it wrote itself.
    """
    store = batch_store(path, ["day"], files_per_batch)
    logged = T.StructType([*schema.fields, CHANGE, T.StructField("day", T.DateType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.withColumn("day", F.to_date(day)).persist()
        try:
            first, last = batch.agg(F.min("day"), F.max("day")).first()
            if first is None:
                return
            changed = batch.where(alive).withColumn(CHANGE.name, F.lit(RAISED))
            if path_exists(spark, path):
                before = read_batches(spark, path, logged).where(
                    F.col("day").between(F.lit(first), F.lit(last)) & (F.col("batch_id") < batch_id)
                )
                newest = before.groupBy(*keys).agg(F.max_by(CHANGE.name, "batch_id").alias("newest"))
                raised = newest.where(F.col("newest") == RAISED).select(*keys)
                cooled = batch.where(~F.coalesce(alive, F.lit(False))).join(raised, list(keys), "left_semi")
                changed = changed.unionByName(cooled.withColumn(CHANGE.name, F.lit(WITHDRAWN)))
            store(changed, batch_id)
        finally:
            batch.unpersist()

    return write


def read_changes(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What :func:`change_log` wrote: the rows, ``change`` and ``batch_id``."""
    logged = T.StructType([*schema.fields, CHANGE])
    if not path_exists(spark, path):  # no batch had a row
        return spark.createDataFrame([], T.StructType([*logged.fields, T.StructField("batch_id", T.LongType())]))
    return read_batches(spark, path, logged)


def current_rows(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of a change log, the rows that are raised and not withdrawn since."""
    return latest_revisions(changes, keys).where(F.col(CHANGE.name) == RAISED).drop(CHANGE.name, "day")


def path_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What :func:`batch_store` wrote, with its ``batch_id``."""
    stored = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])
    return spark.read.schema(stored).parquet(path)


def latest_revisions(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of an update-mode result, the newest row per key.

    Rows are aggregated by sorting, as their state is a struct. Dealt by key beforehand, they are
    sorted once instead of on both sides of the exchange; a hash before the keys decides the order of nearly all
    by one number. Rows are counted first, so that no task sorts more than its share.
    """
    cores = results.sparkSession.sparkContext.defaultParallelism
    tasks = max(cores, math.ceil(results.count() / REVISIONS_PER_TASK))
    others = [c for c in results.columns if c not in (*keys, "batch_id")]
    newest = F.max_by(F.struct(*others), F.col("batch_id")).alias("newest")
    hashed = F.xxhash64(*keys).alias("__hash")
    return results.repartition(tasks, *keys).groupBy(hashed, *keys).agg(newest).select(*keys, "newest.*")


def last_batch(results: DataFrame) -> DataFrame:
    """Of a complete-mode result, the rows of its last batch."""
    last = results.agg(F.max("batch_id").alias("batch_id"))
    return results.join(F.broadcast(last), "batch_id", "left_semi").drop("batch_id")
