"""Compaction of stored collections while they are written and read.

The archive job adds a folder for each micro-batch and day. Compaction writes what the batches since the last one
hold as a *segment*: files of about the wanted size, by day. A manifest names the live segments and the last batch that
they hold; it changes in one step, and a reader takes one manifest: the segments it names, and the batches behind them. What
a manifest no longer names stays until :func:`vacuum`, for readers that still use it. Segments of like size are merged
when there are ``SEGMENTS`` of them, so a document is rewritten a logarithmic number of times. One compaction
of a collection runs at a time; the archive job needs no stop.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.sources.collections import STORED

FILE_BYTES = 128 * 1024 * 1024
#: Segments of like size that are merged into one.
SEGMENTS = 4
MANIFEST = T.StructType(
    [
        T.StructField("segment", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("through", T.LongType()),
    ]
)
SEGMENT = T.StructType([f for f in STORED.fields if f.name != "collection"])


@dataclass(frozen=True)
class Snapshot:
    """What a reader sees: bytes of the live segments by name, and the last batch that they hold."""

    version: int
    segments: dict[str, int]
    through: int


def snapshot_of(spark: SparkSession, store: str, collection: str) -> Snapshot:
    """The newest whole manifest of a collection."""
    root = f"{_root(store, collection)}/manifest"
    versions = sorted((int(name) for name in _names(spark, root)), reverse=True)
    for version in versions:
        if "_SUCCESS" in _names(spark, f"{root}/{version}"):
            rows = spark.read.schema(MANIFEST).parquet(f"{root}/{version}").collect()
            return Snapshot(version, {r.segment: r.bytes for r in rows if r.segment}, max(r.through for r in rows))
    return Snapshot(0, {}, -1)


def documents_of(spark: SparkSession, store: str, collection: str, at: Snapshot | None = None) -> DataFrame:
    """All documents of a collection with their day and batch: the segments of a snapshot, and the batches behind it."""
    at = at or snapshot_of(spark, store, collection)
    batches = spark.read.schema(SEGMENT).parquet(f"{store}/collection={collection}")
    found = batches.where(F.col("batch_id") > at.through) if at.through >= 0 else batches
    for segment in at.segments:
        path = f"{_root(store, collection)}/{segment}"
        found = found.unionByName(spark.read.schema(SEGMENT).parquet(path))
    return found


def compact(spark: SparkSession, store: str, collection: str, *, file_bytes: int = FILE_BYTES) -> Snapshot:
    """Put the batches since the last compaction into a segment; all but the newest, which may still be written."""
    before = snapshot_of(spark, store, collection)
    sizes = _batch_sizes(spark, store, collection)
    newest = max((batch for _, batch in sizes), default=-1)
    fresh = {place: n for place, n in sizes.items() if before.through < place[1] < newest}
    if not fresh:
        return before
    through = max(batch for _, batch in fresh)
    batches = spark.read.schema(SEGMENT).parquet(f"{store}/collection={collection}")
    added = batches.where(F.col("batch_id").between(before.through + 1, through))
    days: dict[str, int] = {}
    for (day, _), n in fresh.items():
        days[day] = days.get(day, 0) + n
    segments = dict(before.segments)
    name = f"segment-{before.version + 1}"
    segments[name] = _write(spark, added, days, f"{_root(store, collection)}/{name}", file_bytes)
    levels: dict[int, list[str]] = {}
    for segment, n in segments.items():
        levels.setdefault(int(math.log(max(n, 1), SEGMENTS)), []).append(segment)
    for same in levels.values():
        if len(same) >= SEGMENTS:
            paths = [f"{_root(store, collection)}/{segment}" for segment in same]
            days = {}
            for path in paths:
                for day, n in _day_sizes(spark, path).items():
                    days[day] = days.get(day, 0) + n
            merged = f"segment-{before.version + 1}-merged"
            rows = spark.read.schema(SEGMENT).parquet(paths[0])
            for path in paths[1:]:
                rows = rows.unionByName(spark.read.schema(SEGMENT).parquet(path))
            size = _write(spark, rows, days, f"{_root(store, collection)}/{merged}", file_bytes)
            segments = {merged: size, **{s: n for s, n in segments.items() if s not in same}}
            break
    after = Snapshot(before.version + 1, segments, through)
    listed = [(s, n, through) for s, n in segments.items()]
    made = spark.createDataFrame(listed, MANIFEST).coalesce(1)
    made.write.mode("overwrite").parquet(f"{_root(store, collection)}/manifest/{after.version}")
    return after


def vacuum(spark: SparkSession, store: str, collection: str) -> None:
    """Delete segments and batches that the newest snapshot does not read. No older snapshot may be in use."""
    at = snapshot_of(spark, store, collection)
    root = _root(store, collection)
    for name in _names(spark, root):
        if name.startswith("segment-") and name not in at.segments:
            _delete(spark, f"{root}/{name}")
    for version in _names(spark, f"{root}/manifest"):
        if int(version) < at.version:
            _delete(spark, f"{root}/manifest/{version}")
    for day, batch in _batch_sizes(spark, store, collection):
        if 0 <= batch <= at.through:
            _delete(spark, f"{store}/collection={collection}/day={day}/batch_id={batch}")


def _write(spark: SparkSession, rows: DataFrame, days: dict[str, int], path: str, file_bytes: int) -> int:
    """Rows in files of about ``file_bytes`` each, by day; the bytes written."""
    # A task for each file: as many for a day as its bytes fill.
    files = [(None if d.startswith("__") else d, max(1, -(-n // file_bytes))) for d, n in days.items()]
    plan = spark.createDataFrame(files, "d string, files long").select(F.col("d").cast("date").alias("d"), "files")
    placed = rows.join(F.broadcast(plan), F.col("day").eqNullSafe(F.col("d")))
    placed = placed.withColumn("file", F.pmod(F.xxhash64("topic", "partition", "offset"), F.col("files")))
    tasks = sum(n for _, n in files)
    dealt = placed.repartition(tasks, "day", "file").drop("d", "files", "file")
    dealt.write.mode("overwrite").partitionBy("day").parquet(path)
    return sum(_day_sizes(spark, path).values())


def _root(store: str, collection: str) -> str:
    # Names with an underscore are no partitions to Spark.
    return f"{store}/_segments/{collection}"


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    folder, files = _files(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def _delete(spark: SparkSession, path: str) -> None:
    folder, files = _files(spark, path)
    files.delete(folder, True)


def _batch_sizes(spark: SparkSession, store: str, collection: str) -> dict[tuple[str, int], int]:
    """Bytes by (day, batch) of a collection's own folders."""
    pattern, files = _files(spark, f"{store}/collection={collection}/day=*/batch_id=*")
    found = {}
    for status in files.globStatus(pattern) or []:
        path = status.getPath()
        day, batch = path.getParent().getName()[len("day=") :], path.getName()[len("batch_id=") :]
        if batch.isdigit():
            found[day, int(batch)] = files.getContentSummary(path).getLength()
    return found


def _day_sizes(spark: SparkSession, path: str) -> dict[str, int]:
    pattern, files = _files(spark, f"{path}/day=*")
    return {
        s.getPath().getName()[len("day=") :]: files.getContentSummary(s.getPath()).getLength()
        for s in files.globStatus(pattern) or []
    }
