"""Interval text such as ``"10 seconds"`` as a number of microseconds."""

UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def micros(interval: str) -> int:
    """Length of a fixed-length interval written as ``"<count> <unit>[s]"``."""
    count, _, unit = interval.strip().partition(" ")
    unit = unit.strip().lower().removesuffix("s")
    if unit not in UNIT_MICROS or not count.isdigit():
        raise ValueError(f"not a fixed-length interval: {interval!r}")
    return int(count) * UNIT_MICROS[unit]
