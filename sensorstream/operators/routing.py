"""Which topic a reading is published to, and which collection a topic lands in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: topics are named after the sensor type.
TOPIC_SUFFIX = "-topic"
#: Where readings without a sensor type go.
UNTYPED_TOPIC = f"untyped{TOPIC_SUFFIX}"


def topic_of(sensor_type: Column) -> Column:
    """Topic of a reading by its sensor type; one without a type has a topic of its own."""
    return F.coalesce(F.concat(sensor_type, F.lit(TOPIC_SUFFIX)), F.lit(UNTYPED_TOPIC))


def collection_of(topic: Column) -> Column:
    """Collection of a topic; NULL for a topic that no collection stores."""
    named = topic.endswith(TOPIC_SUFFIX)
    return F.when(named, F.substr(topic, F.lit(1), F.length(topic) - F.lit(len(TOPIC_SUFFIX))))


def by_topic(messages: DataFrame, topic: str) -> DataFrame:
    """One topic of a multi-topic log."""
    return messages.where(F.col("topic") == F.lit(topic))
