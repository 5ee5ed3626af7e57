"""Session settings for local tests and for a cluster."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Small, because window rows multiply by size/slide behind the exchange.
TARGET_PARTITION_BYTES = 32 * 1024 * 1024

# Local scratch folder of this process, used only where the session names none.
_local_scratch: str | None = None
# Applications whose Python workers have this library.
_shipped: set[str] = set()


def shuffle_partitions_for(shuffle_bytes: int, cores: int) -> int:
    """Reduce tasks that keep a partition near 32 MB, three waves of cores at least."""
    wanted = -(-shuffle_bytes // TARGET_PARTITION_BYTES)
    return max(1, wanted, 3 * cores)


def session_builder(
    app_name: str = "sensorstream",
    *,
    shuffle_bytes: int | None = None,
    cores: int = 8,
    checkpoint_dir: str | None = None,
) -> SparkSession.Builder:
    """Builder with the settings the jobs assume.

    ``shuffle_bytes`` is the expected shuffle volume of the largest job; adaptive
    execution merges partitions that turn out small, so it may be generous.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", TARGET_PARTITION_BYTES)
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_bytes is not None:
        builder = builder.config(
            "spark.sql.shuffle.partitions", shuffle_partitions_for(shuffle_bytes, cores)
        )
    if checkpoint_dir is not None:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return builder


def use_utc(spark: SparkSession) -> None:
    """Put the session in UTC: reading timestamps carry no zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(
            f"session zone is {zone}; reading times are zone-less, set spark.sql.session.timeZone=UTC"
        )


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block; a stream keeps those of its start."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it in spark.checkpoint.dir.

    Only a local session without that setting falls back to a folder of its own.
    """
    global _local_scratch
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp" if os.path.isdir("/tmp") else None)
    return _local_scratch


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder (not created), deleted when the session's JVM ends."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path.getParent())
    files.deleteOnExit(path)
    return folder


def ship_library(spark: SparkSession) -> None:
    """Send this library to the Python workers, once per application.

    They may run anywhere and need not find it on a path of their own.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="library-"))
    archive = os.path.join(folder, "sensorstream.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for place, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith((".py", ".txt"))):  # code and the texts it reads
                path = os.path.join(place, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
