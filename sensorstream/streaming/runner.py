"""Starting streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from sensorstream.session import ROCKSDB, new_folder, settings
from sensorstream.streaming.lateness import strict_lateness
from sensorstream.streaming.sinks import BatchWriter

# Window state on local disk instead of executor heap. Keys are not counted: that
# looks each one up once more with every put and every removal.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}
# What a commit keeps: with frequent batches the changes; in a run over what is there new files of the state, as each
# such run takes the state up from its checkpoint, and would make all changes since the last snapshot again.
CHANGE_LOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
PARTITIONS = "spark.sql.shuffle.partitions"
FILE_FORMATS = ("csv", "json", "parquet")


def _writer(
    df: DataFrame, name: str, checkpoint: str, mode: str, every: str | None
) -> DataStreamWriter:
    writer = df.writeStream.queryName(name).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint)
    # Without an interval: work off what is there in bounded batches, then stop.
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def _start(
    writer: DataStreamWriter, df: DataFrame, strict: bool, every: str | None, partitions: int | None = None
) -> StreamingQuery:
    spark = df.sparkSession
    wanted = {**STATE_SETTINGS, CHANGE_LOG: "true" if every else "false"}
    values = {k: v for k, v in wanted.items() if spark.conf.get(k, None) is None}
    if partitions is not None:
        values[PARTITIONS] = str(max(partitions, int(spark.conf.get(PARTITIONS))))
    with settings(spark, values):
        with strict_lateness(spark, strict):
            return writer.start()


def start_batches(
    df: DataFrame,
    write: BatchWriter,
    *,
    name: str,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    strict: bool = False,
    partitions: int | None = None,
) -> StreamingQuery:
    """Run a stream into a batch writer. ``every`` is the trigger interval.

    State is dealt among ``partitions`` at least, see :func:`~sensorstream.operators.windows.state_partitions`. They are fixed by a
    checkpoint's first run.
    """
    writer = _writer(df, name, checkpoint, mode, every).foreachBatch(write)
    return _start(writer, df, strict, every, partitions)


def start_files(
    df: DataFrame,
    path: str,
    *,
    name: str,
    checkpoint: str,
    file_format: str = "parquet",
    max_records_per_file: int | None = None,
    every: str | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Run a stream into rolling part files, each result row written exactly once.

    Files roll with every trigger and at ``max_records_per_file``.
    """
    if file_format not in FILE_FORMATS:
        raise ValueError(f"file_format must be one of {FILE_FORMATS}")
    writer = _writer(df, name, checkpoint, "append", every).format(file_format).option("path", path)
    if max_records_per_file is not None:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    return _start(writer, df, strict, every)


def print_rows(df: DataFrame, write: Callable[[str], object] = print) -> None:
    """Print every row. One partition at a time reaches the driver; for volume, use files."""
    for row in df.toLocalIterator():
        write("  ".join(f"{name}={value}" for name, value in row.asDict().items()))


def start_console(
    df: DataFrame,
    *,
    name: str,
    checkpoint: str | None = None,
    mode: str = "append",
    every: str | None = None,
    strict: bool = False,
) -> StreamingQuery:
    """Print every result row, the way to look at small streams."""
    return start_batches(
        df,
        lambda batch, _: print_rows(batch),
        name=name,
        checkpoint=checkpoint or new_folder(df.sparkSession, "console"),
        mode=mode,
        every=every,
        strict=strict,
    )
