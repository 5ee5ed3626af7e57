"""The publish job: stored readings into the message log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorstream.functions.codec import encode
from sensorstream.operators.routing import topic_of
from sensorstream.schemas import READING
from sensorstream.sources.files import last_offset, with_log_position, write_file_log


def messages_of(readings: DataFrame, *, integral_values: bool = True) -> DataFrame:
    """Readings as ``(key, value, topic)``; further columns of the frame stay."""
    extra = [c for c in readings.columns if c not in READING.names]
    return encode(readings, integral_values=integral_values, keep=["sensor_type", *extra]).select(
        "key", "value", topic_of(F.col("sensor_type")).alias("topic"), *extra
    )


def as_sent(texts: DataFrame, *, topic: str | None = None) -> DataFrame:
    """Message texts (``value``) as they are, as ``(key, value, topic)``; further columns of the frame stay.

    The key is the text's ``id``, null if it has none. Messages go to ``topic``, or without it to that of their
    ``sensor_type``. No field is read beyond these two, and none is lost.
    """
    extra = [c for c in texts.columns if c not in ("key", "value", "topic")]
    by_type = topic_of(F.get_json_object("value", "$.sensor_type"))
    to = by_type if topic is None else F.lit(topic)
    return texts.select(F.get_json_object("value", "$.id").alias("key"), "value", to.alias("topic"), *extra)


def _messages(frame: DataFrame, topic: str | None) -> DataFrame:
    """Messages of readings, or of texts where the frame has no readings."""
    if "id" not in frame.columns:
        return as_sent(frame, topic=topic)
    messages = messages_of(frame)
    return messages if topic is None else messages.withColumn("topic", F.lit(topic))


def _order(frame: DataFrame, order: str) -> Column:
    in_text = order == "timestamp" and order not in frame.columns
    return F.get_json_object("value", "$.timestamp") if in_text else F.col(order)


def publish_to_files(
    frame: DataFrame, path: str, *, order: str = "timestamp", partitions: int = 1, topic: str | None = None
) -> None:
    """Publish readings, or message texts as they are, to a file log.

    Offsets of a sensor ascend with ``order``, and from publish to publish: they go on behind the greatest one
    in the log, so one publish runs at a time. ``topic`` takes all messages; without it they go by sensor type.
    """
    keyed = frame.withColumn("sent_order", _order(frame, order))
    after = last_offset(frame.sparkSession, path)
    # Placing reads the messages twice, first for the ranges: they are made once.
    messages = _messages(keyed, topic).persist()
    try:
        placed = with_log_position(messages, "sent_order", partitions=partitions, after=after)
        write_file_log(placed, path)
    finally:
        messages.unpersist()


def in_sending_order(frame: DataFrame, order: str = "timestamp", *, topic: str | None = None) -> DataFrame:
    """Messages for a broker: those of a sensor in one task, in order.

    A broker keeps the order in which a producer sends, so a sensor's messages cannot be spread over tasks. To publish a long
    history of one busy sensor, publish it in slices of time.
    """
    messages = _messages(frame.withColumn("sent_order", _order(frame, order)), topic)
    return messages.repartition("key").sortWithinPartitions("key", "sent_order")
