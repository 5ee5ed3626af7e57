"""Window measures as mergeable partial states.

A measure names its state columns, how a row set folds into them, how states of
two row sets merge, and how the result is read off. Any of the window plans can
then compute it. All default states are fixed-width, so Spark keeps them in hash
aggregation buffers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorstream.schemas import MEAN_DIGITS


@dataclass(frozen=True)
class Measure:
    name: str
    fold: dict[str, Column]
    merge: dict[str, Column]
    result: Column
    #: States that serve merging alone; the result does not read them.
    unread: tuple[str, ...] = ()


def count_rows(name: str = "n") -> Measure:
    return Measure(
        name,
        {f"{name}_state": F.count(F.lit(1))},
        {f"{name}_state": F.sum(f"{name}_state")},
        F.col(f"{name}_state"),
    )


def count_values(value: str, name: str = "n") -> Measure:
    """Rows that carry a ``value``; shares its state with the mean of that column."""
    state = f"{value}_count"
    return Measure(name, {state: F.count(value)}, {state: F.sum(state)}, F.col(state))


def rounded_mean(
    value: str, name: str = "mean", digits: int = MEAN_DIGITS, decimals: int | None = None
) -> Measure:
    """Mean rounded half up to ``digits`` places.

    The sum is a fixed-point number, so the result depends neither on the order of
    rows nor on the plan or the number of tasks: of each value the first 18 decimal
    places count. Values of 10^19 and more, infinities and NaN are summed apart as doubles.
    ``decimals`` states that values have at most that many decimal places; whole
    numbers then do, which is faster, and a value with more places stops the job.
    """
    number, count = F.col(value), f"{value}_count"
    if decimals is None:
        # Whole units and fractions are summed apart, so neither sum leaves the 38 digits of a decimal.
        whole, part, far = f"{value}_whole_sum", f"{value}_part_sum", f"{value}_far_sum"
        fixed = F.abs(number) < F.lit(1e19)
        near = F.when(fixed, number).try_cast("decimal(38,18)")
        units = F.floor(near)
        n = F.col(count).cast("decimal(19,0)")
        # The mean is near + rest, for any whole number near; a rounded quotient keeps the rest small.
        close = F.round(F.col(whole) / n, 0).cast("decimal(20,0)")
        rest = ((F.col(whole) - close * n).cast("decimal(19,0)") + F.col(part)) / n
        summed = F.col(whole).cast("double") + F.col(part).cast("double")
        mean = F.when(
            F.col(far).isNull(), F.round(close + rest.cast("decimal(30,18)"), digits).cast("double")
        ).otherwise((F.coalesce(summed, F.lit(0.0)) + F.col(far)) / F.col(count))
        fold = {
            whole: F.sum(units.cast("decimal(20,0)")),
            part: F.sum((near - units).cast("decimal(19,18)")),
            far: F.sum(F.when(~fixed | F.isnan(number), number.cast("double"))),
            count: F.count(value),
        }
        merge = {whole: F.sum(whole), part: F.sum(part), far: F.sum(far), count: F.sum(count)}
        return Measure(name, fold, merge, mean)
    if decimals > digits:
        raise ValueError("values have more decimals than the mean keeps")
    total = f"{value}_sum_{decimals}"
    scaled = number * F.lit(float(10**decimals))
    whole = F.round(scaled)
    # Scaling itself is off by a few units in the last place of a double.
    off = F.abs(scaled - whole) > F.greatest(F.abs(scaled) * 1e-12, F.lit(1e-9))
    finer = F.raise_error(F.concat(F.lit(f"more than {decimals} decimal places: "), number.cast("string")))
    summand = F.when(off, finer.cast("bigint")).otherwise(whole.cast("bigint"))
    doubled = f"{total} * {2 * 10 ** (digits - decimals)}L"
    half = f"cast(sign({total}) as bigint) * {count}"
    mean = F.expr(f"(({doubled} + {half}) div (2 * {count})) / {10**digits}.0D")
    fold = {total: F.sum(summand), count: F.count(value)}
    return Measure(name, fold, {total: F.sum(total), count: F.sum(count)}, mean)


def all_above(value: str, threshold: float, name: str = "constant") -> Measure:
    """Whether every value lies above the threshold; NaN never does."""
    above = (F.col(value) > F.lit(threshold)) & ~F.isnan(value)
    state = f"{name}_state"
    return Measure(name, {state: F.every(above)}, {state: F.every(F.col(state))}, F.col(state))


def edge_reading(
    column: str, name: str, *, last: bool, order: str | Sequence[str] | None = None
) -> Measure:
    """First or last ``column`` of the window.

    Without ``order`` that is the smallest or largest one. Otherwise it is the one
    that comes first or last by ``order``, such as ``("partition", "offset")`` for
    order of arrival. One numeric order column keeps hash aggregation; several
    form a struct, which Spark aggregates by sorting.
    """
    state, place = f"{name}_state", f"{name}_place"
    edge, edge_by = (F.max, F.max_by) if last else (F.min, F.min_by)
    if order is None:
        return Measure(name, {state: edge(column)}, {state: edge(state)}, F.col(state))
    names = [order] if isinstance(order, str) else list(order)
    rank = F.col(names[0]) if len(names) == 1 else F.struct(*names)
    return Measure(
        name,
        {state: edge_by(F.col(column), rank), place: edge(rank)},
        {state: edge_by(state, place), place: edge(place)},
        F.col(state),
        unread=(place,),
    )
