"""Window states that a stopped stream has left in its checkpoint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorstream.functions.aggregates import Measure

# How Spark names the second field of a two-field aggregation state.
SECOND = ("isEmpty", "extremumOrdering")


def open_states(
    spark: SparkSession, checkpoint: str, keys: Sequence[str], measures: Sequence[Measure]
) -> DataFrame:
    """Keys, window bounds and measure states of the windows that are open in a checkpoint.

    The windows are those of the last finished batch: what the watermark has not passed. The stream must
    have stopped and have kept ``measures`` and nothing else.
    """
    store = spark.read.format("statestore").option("path", checkpoint).load()
    # States are read by place, as Spark names them after their kind only.
    held = _numbered(store, "value")
    states: dict[str, Column] = {}
    wanted = [state for m in measures for state in m.fold if state not in m.unread]
    fields = store.schema["value"].dataType.fields
    firsts = [k for k, f in enumerate(fields) if f.name not in SECOND]
    if len(dict.fromkeys(wanted)) != len(firsts):
        raise ValueError(f"{checkpoint} keeps {len(firsts)} states, not {list(dict.fromkeys(wanted))}")
    for state, k in zip(dict.fromkeys(wanted), firsts):
        empty = k + 1 < len(fields) and fields[k + 1].name == "isEmpty"
        states[state] = F.when(~held[f"_{k + 1}"], held[f"_{k}"]) if empty else held[f"_{k}"]
    key = _numbered(store, "key")
    window = key[f"_{len(keys)}"]
    return store.select(
        *[key[f"_{k}"].alias(name) for k, name in enumerate(keys)],
        window["start"].alias("window_start"),
        window["end"].alias("window_end"),
        *[column.alias(state) for state, column in states.items()],
    )


def _numbered(store: DataFrame, column: str) -> Column:
    """The struct with its fields named by place."""
    fields = store.schema[column].dataType.fields
    return F.col(column).cast(T.StructType([T.StructField(f"_{k}", f.dataType) for k, f in enumerate(fields)]))
