"""Groups of consumers: offsets committed with each batch, so that a new checkpoint goes on where the group stopped.

Layout ``<path>/group=<name>/commits/batch_id=<n>/`` and ``<path>/group=<name>/runs/``. A run is the life of one
checkpoint. Batches are numbered through all runs of the group, so a later run replaces no batch of an earlier one. One run
of a group is at work at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.streaming.sinks import BatchWriter, batch_store, path_exists, read_batches

EARLIEST = -2  # fixed value: how the connector's starting offsets spell it
# The file of a file log that a message lies in; null for a log without files.
SPLIT = "split"
COMMIT = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField(SPLIT, T.StringType()),
        T.StructField("first_offset", T.LongType()),
        T.StructField("next_offset", T.LongType()),
        T.StructField("run", T.StringType()),
    ]
)
RUN = T.StructType([T.StructField("run", T.StringType()), T.StructField("first_batch", T.LongType())])


@dataclass(frozen=True)
class Group:
    """A group of consumers by name, with its offsets below ``path``."""

    path: str
    name: str

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[\w.\-]+", self.name):
            raise ValueError(f"a group is named by letters, digits, '_', '.' and '-': {self.name!r}")

    @property
    def folder(self) -> str:
        return f"{self.path}/group={self.name}"

    def commits(self, spark: SparkSession) -> DataFrame:
        """What each batch has read: a row per topic, partition and split."""
        if not path_exists(spark, f"{self.folder}/commits"):
            return spark.createDataFrame([], T.StructType([*COMMIT.fields, T.StructField("batch_id", T.LongType())]))
        return read_batches(spark, f"{self.folder}/commits", COMMIT)

    def next_offsets(self, spark: SparkSession) -> DataFrame:
        """The offset behind the greatest one that was read, by topic and partition."""
        return self.commits(spark).groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))

    def starting_offsets(self, spark: SparkSession, partitions: Mapping[str, int]) -> str:
        """Starting offsets for a connector, in its JSON form.

        ``partitions`` counts each topic's partitions; one without a commit is read from its beginning, as is a new one
        of a topic that has grown. The driver gets one number for each partition.
        """
        found = {(r.topic, r.partition): r.next_offset for r in self.next_offsets(spark).collect()}
        outside = sorted(p for p in found if p[0] in partitions and p[1] >= partitions[p[0]])
        if outside:
            raise ValueError(f"commits of partitions that the topics do not have: {outside}")
        return json.dumps(
            {topic: {str(p): found.get((topic, p), EARLIEST) for p in range(n)} for topic, n in partitions.items()}
        )

    def join(self, spark: SparkSession, checkpoint: str, table: str, folders: Sequence[str] = ()) -> Run:
        """Take part with a checkpoint, to write into a table of :func:`~sensorstream.streaming.sinks.batch_store`.

        A checkpoint that the group knows goes on as the run it is. A new one begins behind the last
        committed batch; what an earlier run has written of the batch after it, without a commit, is deleted and read again.
        """
        mark = f"{checkpoint}/group"
        if path_exists(spark, mark):
            run = Run(self, *spark.read.schema(RUN).parquet(mark).first())
            others = self.commits(spark).where((F.col("batch_id") >= run.first_batch) & (F.col("run") != run.run))
            if not others.isEmpty():
                raise ValueError(f"group {self.name} has gone on with another checkpoint than {checkpoint}")
            return run
        if path_exists(spark, f"{checkpoint}/metadata"):
            raise ValueError(f"{checkpoint} has run outside of group {self.name}")
        last = self.commits(spark).agg(F.max("batch_id")).first()[0]
        run = Run(self, uuid.uuid4().hex, 0 if last is None else last + 1)
        if path_exists(spark, f"{self.folder}/runs"):
            _delete_batch(spark, table, folders, run.first_batch)
        elif _batches(spark, table, folders, "*"):
            raise ValueError(f"{table} holds batches that group {self.name} has not written")
        record = spark.createDataFrame([(run.run, run.first_batch)], RUN).coalesce(1)
        record.write.mode("append").parquet(f"{self.folder}/runs")
        record.write.mode("overwrite").parquet(mark)
        return run


@dataclass(frozen=True)
class Run:
    """A checkpoint's part in its group; its batch n is the group's batch ``first_batch + n``."""

    group: Group
    run: str
    first_batch: int

    def unread(self, messages: DataFrame) -> DataFrame:
        """The messages that no earlier run has committed, of a log of files (with ``split``).

        Files are read whole and never change, so their names tell. A log without files starts at
        :meth:`Group.starting_offsets` instead.
        """
        if SPLIT not in messages.columns:
            return messages
        before = self.group.commits(messages.sparkSession).where(F.col("batch_id") < self.first_batch)
        return messages.join(before.select("topic", SPLIT).distinct(), ["topic", SPLIT], "left_anti")

    def committing(self, write: BatchWriter) -> BatchWriter:
        """Write a batch of messages under the group's number for it, then commit its offsets.

        The commit reads the batch again, four of its columns only.
        """
        commit = batch_store(f"{self.group.folder}/commits", files_per_batch=1)

        def write_and_commit(batch: DataFrame, batch_id: int) -> None:
            number = self.first_batch + batch_id
            write(batch, number)
            split = F.col(SPLIT) if SPLIT in batch.columns else F.lit(None).cast("string")
            offsets = batch.groupBy("topic", "partition", split.alias(SPLIT)).agg(
                F.min("offset").alias("first_offset"), (F.max("offset") + 1).alias("next_offset")
            )
            commit(offsets.withColumn("run", F.lit(self.run)), number)

        return write_and_commit


def _batches(spark: SparkSession, table: str, folders: Sequence[str], batch: int | str) -> list:
    """Folders of a batch, or of all; one for each of the table's folders that the batch has rows of."""
    levels = [table, *(f"{name}=*" for name in folders), f"batch_id={batch}"]
    pattern = spark._jvm.org.apache.hadoop.fs.Path("/".join(levels))
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath() for status in files.globStatus(pattern) or []]


def _delete_batch(spark: SparkSession, table: str, folders: Sequence[str], batch: int) -> None:
    for path in _batches(spark, table, folders, batch):
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
