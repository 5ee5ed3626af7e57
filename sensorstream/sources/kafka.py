"""Kafka topics as message frames, and back.

The connector is the public package spark-sql-kafka-0-10, given to the cluster at
submission. Without it, use the file log in :mod:`sensorstream.sources.files`,
which has the same columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.schemas import ENVELOPE


def read_options(
    servers: str,
    topics: Sequence[str],
    *,
    starting_offsets: str = "earliest",
    group_id: str | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
    }
    if group_id is not None:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def write_options(servers: str, *, acks: str = "1") -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "kafka.acks": acks}


def read_topics(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str],
    *,
    streaming: bool = True,
    starting_offsets: str = "earliest",
    group_id: str | None = None,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Messages of the topics. A restarted stream goes on from its checkpoint;
    ``starting_offsets`` counts only for its first start."""
    options = read_options(
        servers,
        topics,
        starting_offsets=starting_offsets,
        group_id=group_id,
        max_offsets_per_trigger=max_offsets_per_trigger if streaming else None,
    )
    reader = spark.readStream if streaming else spark.read
    try:
        records = reader.format("kafka").options(**options).load()
    except AnalysisException as error:
        raise RuntimeError(
            "no Kafka connector in this session: submit with the spark-sql-kafka-0-10 package"
        ) from error
    return records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ENVELOPE])


def publish_to_kafka(messages: DataFrame, servers: str, *, acks: str = "1") -> None:
    """Append ``(key, value, topic)`` rows; Kafka picks the partition by key."""
    (
        messages.select("key", "value", "topic")
        .write.format("kafka")
        .options(**write_options(servers, acks=acks))
        .save()
    )
