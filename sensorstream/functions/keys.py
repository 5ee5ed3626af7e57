"""Keys: which sensor a message belongs to, and which log partition it goes to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: in a compact message with `id` first, the id's first digit is the 7th character.
KEY_POSITION = 7


def position_key(message: Column) -> Column:
    """Sensor key read by position, as the original job does it.

    Right only for compact messages with a one-digit ``id`` in front: id 12 gives
    1, and any other text gives NULL. Use the decoded ``sensor_id`` elsewhere.
    """
    return F.substring(message, KEY_POSITION, 1).try_cast("int")


def log_partition(key: Column, partitions: int) -> Column:
    """Partition of a key in a log of ``partitions``: equal keys share one."""
    return F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int")


# A log place holds the partition above any 63-bit offset.
OFFSETS = 2**63


def log_place(partition: Column, offset: Column) -> Column:
    """Place of a message in its log as one ascending number.

    Ordering by it equals ordering by ``(partition, offset)``, but one fixed-width
    column keeps window aggregation in hash buffers.
    """
    above = partition.cast("decimal(18,0)") * F.lit(str(OFFSETS)).cast("decimal(19,0)")
    return (above + offset.cast("decimal(19,0)")).cast("decimal(38,0)")
