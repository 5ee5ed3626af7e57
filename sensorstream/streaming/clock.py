"""Sliding windows by the clock: each reading counts when it is taken in, and windows close by a timer.

Windows of :mod:`~sensorstream.operators.windows` over the job's clock have one time for all rows of a batch and close
when a batch comes. Here each sensor keeps the panes of its open windows as state. A reading is stamped as it is folded
in, and a processing-time timer per sensor closes windows when their end has passed, whether or not data come. Panes hold
sums, not readings, so a sensor's state is bounded by size over slide however fast it sends.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Iterable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sensorstream.functions.intervals import micros
from sensorstream.schemas import CONSTANT_THRESHOLD, MEAN_DIGITS, MEAN_THRESHOLD, WINDOW_SIZE, WINDOW_SLIDE

PLACES = Decimal(1).scaleb(-MEAN_DIGITS)


def now_ms() -> int:
    return time.time_ns() // 1_000_000


class Panes:
    """One sensor's panes: start in ms -> [sum as decimal text, count, all above, first, last]."""

    def __init__(self, size_ms: int, slide_ms: int, threshold: float, held: str | None = None) -> None:
        self.size, self.slide, self.threshold = size_ms, slide_ms, threshold
        self.pane = math.gcd(size_ms, slide_ms)
        self.closed, panes = json.loads(held) if held else (0, {})
        self.panes: dict[int, list] = {int(k): v for k, v in panes.items()}

    def add(self, at: int, value: float, sent: str) -> None:
        """A reading taken in at ``at``. A clock that runs behind counts as at the last closed window's end."""
        at = max(at, self.closed - self.size + self.pane) if self.closed else at
        start = at - at % self.pane
        total, n, above, first, last = self.panes.get(start, ["0", 0, True, sent, sent])
        # What is no finite number stays so in the sum.
        total = str(Decimal(total) + Decimal(repr(value)))
        above = above and value > self.threshold
        self.panes[start] = [total, n + 1, above, min(first, sent), max(last, sent)]

    def close(self, now: int) -> Iterator[tuple[int, list]]:
        """(start, sums) of the windows whose end has passed since the last call, earliest first."""
        for start in sorted({s for p in self.panes for s in self._starts(p)}):
            if self.closed < start + self.size <= now:
                held = [v for p, v in self.panes.items() if start <= p < start + self.size]
                total = sum((Decimal(v[0]) for v in held), Decimal(0))
                yield start, [
                    total, sum(v[1] for v in held), all(v[2] for v in held),
                    min(v[3] for v in held), max(v[4] for v in held),
                ]
        self.closed = max(self.closed, now)
        self.panes = {p: v for p, v in self.panes.items() if self._ends(p)}

    def _starts(self, pane: int) -> range:
        last = pane - pane % self.slide
        return range(last, pane - self.size + self.pane - 1, -self.slide)

    def _ends(self, pane: int) -> list[int]:
        """Ends of the open windows over a pane."""
        return [s + self.size for s in self._starts(pane) if s + self.size > self.closed]

    def next_end(self) -> int | None:
        return min((e for p in self.panes for e in self._ends(p)), default=None)

    def text(self) -> str:
        return json.dumps([self.closed, self.panes])


def clock_windows(
    readings: DataFrame,
    *,
    key: str = "sensor_id",
    value: str = "value",
    sent: str = "timestamp",
    size: str = WINDOW_SIZE,
    slide: str = WINDOW_SLIDE,
    mean_threshold: float = MEAN_THRESHOLD,
    constant_threshold: float = CONSTANT_THRESHOLD,
    min_count: int = 1,
    mean_type: str = "float",
    clock: Callable[[], int] = now_ms,
) -> DataFrame:
    """Heat statistics, as of ``overheat_stats``, of windows by the clock of the tasks. For append mode.

    ``sent`` is the reading's own timestamp as text, of which first and last are kept. The clocks of the executors should
    agree; a reading whose clock runs behind a closed window counts in the earliest open one.
    """
    if not readings.isStreaming:
        raise ValueError("a stream is asked for: a batch has no clock of its own")
    if micros(size) % 1000 or micros(slide) % 1000:
        raise ValueError("windows by the clock are of whole milliseconds")
    size_ms, slide_ms = micros(size) // 1000, micros(slide) // 1000
    kind = readings.schema[key].dataType
    sums = "start_ms bigint, mean double, constant boolean, first_ts string, last_ts string, n bigint"
    out = T.StructType([T.StructField(key, kind), *T.StructType.fromDDL(sums)])

    def fold(keys: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        panes = Panes(size_ms, slide_ms, constant_threshold, state.get[0] if state.exists else None)
        if not state.hasTimedOut:
            for frame in frames:
                for number, text in zip(frame[value].tolist(), frame[sent].tolist()):
                    panes.add(clock(), number, text)
        rows = [
            (keys[0], start, _mean(total, n), above, first, last, n)
            for start, (total, n, above, first, last) in panes.close(clock())
        ]
        end = panes.next_end()
        if end is None:
            state.remove()
        else:
            state.update((panes.text(),))
            state.setTimeoutDuration(max(1, end - state.getCurrentProcessingTimeMs()))
        if rows:
            yield pd.DataFrame(rows, columns=out.names)

    found = (
        readings.where(F.col(value).isNotNull())
        .select(key, F.col(value).cast("double").alias(value), sent)
        .groupBy(key)
        .applyInPandasWithState(fold, out, "panes string", "append", GroupStateTimeout.ProcessingTimeTimeout)
    )
    hot = ((F.col("mean") > F.lit(mean_threshold)) & ~F.isnan("mean")) | F.col("constant")
    return found.select(
        key,
        F.timestamp_millis("start_ms").alias("window_start"),
        F.timestamp_millis(F.col("start_ms") + F.lit(size_ms)).alias("window_end"),
        F.col("mean").cast(mean_type).alias("mean_temp"),
        F.col("constant").alias("overheat_constant"),
        "first_ts",
        "last_ts",
        "n",
        (hot & (F.col("n") >= F.lit(min_count))).alias("hot"),
    )


def _mean(total: Decimal, n: int) -> float:
    if not total.is_finite():
        return float(total)
    mean = total / n
    return float(mean.quantize(PLACES, ROUND_HALF_UP)) if abs(mean) < Decimal("1e20") else float(mean)
