"""What the operators share: written tables, extra columns from Python, sorted groups."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from sensorstream.session import new_folder, ship_library

#: Rows per Arrow batch while whole texts pass through Python.
TEXT_ROWS = "1000"
#: Rows of a few numbers each that a file of a small written table holds, about.
ROWS_PER_FILE = 25_000
#: ASCII white space, as a class for regular expressions.
SPACE = r"[\x20\x09-\x0D]"


def for_texts(spark: SparkSession) -> None:
    """Library to the workers, and Arrow batches small enough for a batch of long texts."""
    ship_library(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS)


def fresh_name(name: str) -> str:
    """A column name that no caller's table has."""
    return f"_{name}_{uuid.uuid4().hex[:8]}"


def files_for(rows: int) -> int:
    """Files that a table of so many short rows needs; one at least."""
    return max(1, -(-rows // ROWS_PER_FILE))


class Scratch:
    """Tables written between steps, below the folder that all executors share.

    A written table, unlike a cached one, outlives the executor that made it.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = new_folder(spark, name)
        self.written = 0

    def path(self) -> str:
        self.written += 1
        return f"{self.root}/{self.written}"

    def write(self, frame: DataFrame, rows: int | None = None) -> DataFrame:
        """The table as written. ``rows``: how many short rows it has at most, so that a small one takes few files.

        For each file and its checksum, Hadoop's local file system starts a ``chmod`` beside the executor; until that
        runs it counts as a second JVM, so thousands of tiny files cost more memory than what they hold.
        """
        path = self.path()
        if rows is not None:
            frame = frame.coalesce(files_for(rows))
        frame.write.parquet(path)
        kept = self.spark.read.schema(frame.schema).parquet(path)
        kept.scratch_path = path
        return kept

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for frame in frames:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(frame.scratch_path)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def with_arrow(
    frame: DataFrame,
    columns: list[tuple[str, DataType]],
    compute: Callable[[pa.RecordBatch], list[pa.Array]],
) -> DataFrame:
    """``frame`` with columns computed batch by batch in Python; its own pass unchanged."""
    schema = StructType([*frame.schema.fields, *(StructField(n, t) for n, t in columns)])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *compute(batch)], names=names)

    return frame.mapInArrow(run, schema)


def crc32_of(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    import zlib

    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def column_of(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Whole groups out of batches sorted by ``keys``: rows, and the bounds of their groups.

    A group that goes on in the next batch waits for it, so groups must be bounded.
    """
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if held is None else [held, batch])
        held = table.combine_chunks().to_batches()[0]
        bounds = _bounds(held, keys)
        if len(bounds) > 2:
            last = int(bounds[-2])
            yield held.slice(0, last), bounds[:-1]
            held = held.slice(last)
    if held is not None:
        yield held, _bounds(held, keys)


def _bounds(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    changes = np.zeros(batch.num_rows - 1, bool)
    for key in keys:
        values = column_of(batch, key)
        changes |= values[1:] != values[:-1]
    return np.concatenate([[0], np.flatnonzero(changes) + 1, [batch.num_rows]])


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))
