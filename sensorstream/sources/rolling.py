"""Files of lines that roll at a number of bytes, in order over all files.

Layout ``<path>/file=<n>/``, one file in each folder; the files in order of their number hold the lines in order.
"""

from __future__ import annotations

import os
import shutil
import uuid
import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorstream.session import new_folder, settings, ship_library

FILE_BYTES = 128 * 1024 * 1024
#: Tasks for each core among which the folders are listed.
LISTED_AT_ONCE = 4
#: Bytes for each checksum of Hadoop's local file system.
SUMMED = 512


def write_rolled(
    frame: DataFrame, path: str, line: Column, order: Sequence[str], *, file_bytes: int = FILE_BYTES, mode: str = "error"
) -> None:
    """Write a text for each row, one to a line, into files of ``file_bytes``.

    A line belongs to the file in which its first byte falls, so a file is larger or smaller than that by one line at most; the last holds
    the rest. A text must not hold line ends, and a null counts as empty. Rows that tie in ``order`` come in any
    order. Places are prefix sums: of the lines of each range of rows, and of the sums of the ranges, of which there are
    as many as tasks; so no task sees all rows, and a long tie is shared by several.
    """
    if file_bytes < 1:
        raise ValueError("file_bytes must be positive")
    names = {name: f"_{name}_{uuid.uuid4().hex[:8]}" for name in ("tie", "part", "place", "bytes", "before")}
    tie, part, place, size, before = names.values()
    tied = frame.select(F.coalesce(line, F.lit("")).alias("value"), *(F.col(c).alias(f"{tie}_{c}") for c in order))
    by = [*(f"{tie}_{c}" for c in order), tie]
    dealt = (
        tied.withColumn(tie, F.xxhash64("value", F.monotonically_increasing_id()))
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .select(
            "value",
            F.spark_partition_id().alias(part),
            F.monotonically_increasing_id().alias(place),
            (F.octet_length("value") + 1).cast("bigint").alias(size),
        )
    )
    # Written once: places must not change when a lost task runs again.
    scratch = new_folder(frame.sparkSession, "rolling")
    dealt.write.parquet(scratch)
    lines = frame.sparkSession.read.schema(dealt.schema).parquet(scratch)
    sums = lines.groupBy(part).agg(F.sum(size).alias(size))
    upto = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(part, F.coalesce(F.sum(size).over(upto), F.lit(0)).alias(before))
    within = Window.partitionBy(part).orderBy(place).rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.withColumn("at", F.coalesce(F.sum(size).over(within), F.lit(0))).join(F.broadcast(starts), part)
    numbered = placed.withColumn("file", F.floor((F.col("at") + F.col(before)) / F.lit(file_bytes)).cast("bigint"))
    files = numbered.repartition("file").sortWithinPartitions("file", place).select("value", "file")
    local = _local_folder(frame.sparkSession, path)
    if local is not None:
        _write_local(files, path, local, mode)
        return
    files.write.mode(mode).option("maxRecordsPerFile", 0).partitionBy("file").text(path)


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """The plain path of a folder on Hadoop's local file system, None on any other."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getUri().getScheme() != "file":
        return None
    return files.makeQualified(folder).toUri().getPath()


def _write_local(files: DataFrame, path: str, local: str, mode: str) -> None:
    """What Spark's writer does, on a local disk, where Hadoop starts a process for the mode of each file and folder.

    Python tasks set it themselves. They write to a folder for each attempt, of which the driver moves those that have
    succeeded; a job that fails leaves no file behind.
    """
    spark = files.sparkSession
    if mode == "ignore" and os.path.exists(local):
        return
    # Spark makes the folder, clears it or refuses, as the mode says.
    empty = spark.createDataFrame([], files.schema).write.mode(mode).partitionBy("file")
    empty.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    mask = hadoop.permission.FsPermission.getUMask(spark._jsc.hadoopConfiguration()).toShort()
    staging = f"{local}/_rolling-{uuid.uuid4().hex}"
    os.mkdir(staging)
    os.chmod(staging, 0o777 & ~mask)
    ship_library(spark)
    try:
        lines = files.select(F.concat("value", F.lit("\n")).cast("binary").alias("line"), "file")
        written = lines.mapInArrow(_file_writer(staging, uuid.uuid4().hex, mask), "folder string").collect()
        for folder in (row.folder for row in written):
            for name in os.listdir(folder):
                _move_folder(f"{folder}/{name}", f"{local}/{name}", replace=mode == "overwrite")
    finally:
        shutil.rmtree(staging, ignore_errors=True)
    done = hadoop.Path(path, "_SUCCESS")
    done.getFileSystem(spark._jsc.hadoopConfiguration()).create(done, True).close()


def _move_folder(source: str, target: str, *, replace: bool) -> None:
    """Move a folder, in place of one of that name or together with it."""
    if replace and os.path.exists(target):
        shutil.rmtree(target)
    if not os.path.exists(target):
        os.rename(source, target)
        return
    for name in os.listdir(source):
        os.rename(f"{source}/{name}", f"{target}/{name}")


def _file_writer(staging: str, job: str, mask: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for tasks whose lines come file by file; it yields the folder that the attempt has filled, if any."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = f"{staging}/{uuid.uuid4().hex}"
        name = f"part-{TaskContext.get().partitionId():05}-{job}.c000.txt"
        number, file = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = batch.column("file").to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), batch.num_rows]
            text, starts = _bytes_of(batch.column("line"))
            for begin, end in zip(bounds[:-1], bounds[1:]):
                if file is None or numbers[begin] != number:
                    if file is None:
                        os.mkdir(folder)
                    else:
                        file.close()
                    number = numbers[begin]
                    file = _SummedFile(f"{folder}/file={number}", name, mask)
                file.write(text[starts[begin] : starts[end]])
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_pydict({"folder": [folder]})

    return write


def _bytes_of(lines: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The bytes of all lines, one after the other, and where each starts and the last one ends."""
    _, offsets, data = lines.buffers()
    kind = np.int64 if pa.types.is_large_binary(lines.type) else np.int32
    return memoryview(data), np.frombuffer(offsets, kind)[lines.offset : lines.offset + len(lines) + 1]


class _SummedFile:
    """A file in a folder of its own, with the checksums that Hadoop's local file system keeps beside it."""

    def __init__(self, folder: str, name: str, mask: int) -> None:
        os.mkdir(folder)
        os.chmod(folder, 0o777 & ~mask)
        self.data, self.sums = (open(f"{folder}/{n}", "wb") for n in (name, f".{name}.crc"))
        for file in (self.data, self.sums):
            os.chmod(file.fileno(), 0o666 & ~mask)
        self.sums.write(b"crc\0" + SUMMED.to_bytes(4, "big"))
        self.rest = b""

    def write(self, piece: memoryview) -> None:
        self.data.write(piece)
        held = self.rest + piece
        whole = len(held) // SUMMED * SUMMED
        self._sum(held[:whole])
        self.rest = held[whole:]

    def _sum(self, held: bytes) -> None:
        starts = range(0, len(held), SUMMED)
        self.sums.write(b"".join(zlib.crc32(held[i : i + SUMMED]).to_bytes(4, "big") for i in starts))

    def close(self) -> None:
        self._sum(self.rest)
        self.data.close()
        self.sums.close()


def read_rolled(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`write_rolled` wrote: ``value`` and ``file``."""
    # Spark would list each of up to ten thousand folders in a task of its own. As partitions it takes them in with a time
    # that grows by their number squared; by its path a file is still left out of a scan whose condition on ``file`` it fails.
    tasks = LISTED_AT_ONCE * spark.sparkContext.defaultParallelism
    with settings(spark, {"spark.sql.sources.parallelPartitionDiscovery.parallelism": str(tasks)}):
        lines = spark.read.schema("value string").option("recursiveFileLookup", True).text(path)
    return lines.select("value", F.regexp_extract("_metadata.file_path", r"/file=(\d+)/[^/]*$", 1).cast("bigint").alias("file"))
