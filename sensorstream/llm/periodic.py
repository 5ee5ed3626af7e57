"""Runs of repeated words in a text, by multi-scale minimizers.

A run is a stretch of words with smallest period q, at least two periods and ``least`` words
long, that neither neighbour extends. Periods below ``SHORT`` are found by comparing the text with
itself at each lag. For periods from P to 2 P, P doubling from ``SHORT``, every window of P/2 starts
has a minimizer, the least hash of ``GRAM`` words that starts in it (the leftmost of equals). A window that
lies in the first period of a run comes back one period on, and with it its minimizer. A grid of
windows, so close that one lies in every first period, gives the seeds: pairs of equal
minimizers from P to 2 P apart. Each pair is extended both ways while the words at that distance agree;
what spans a period and more is a run, and of runs over the same words the least period counts.

Minima of 2 W starts are minima of two windows of W, so each scale is one pass. Texts of a batch lie on end,
longest first, parted by words that occur once: such a word is in no run, and at every scale the texts
that are long enough for it come first.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sensorstream.llm.common import for_texts, fresh_name

LEAST = 12
#: Periods from here on are found by minimizers.
SHORT = 16
GRAM = 5
#: Words that are searched together, unless one text has more.
SEGMENT = 1 << 18
#: Pairs that are extended together.
PAIRS = 1 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _stretches(flags: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values that are long enough."""
    edges = np.flatnonzero(flags[1:] != flags[:-1]) + 1
    edges = np.concatenate([[0] * bool(flags[0]), edges, [len(flags)] * bool(flags[-1])]).astype(np.int64)
    begins, ends = edges[::2], edges[1::2]
    long = ends - begins >= least
    return begins[long], ends[long]


def _short_runs(words: np.ndarray, least: int) -> Iterator[np.ndarray]:
    """(start, end, period) rows of runs with periods below ``SHORT``."""
    for q in range(1, min(SHORT, len(words) // 2 + 1)):
        begins, ends = _stretches(words[:-q] == words[q:], max(least, 2 * q) - q)
        yield np.stack([begins, ends + q, np.full(len(begins), q)], axis=1)


class _Extension:
    """How far the words at two places agree, by hashes of all prefixes."""

    def __init__(self, words: np.ndarray) -> None:
        count = len(words)
        base = np.full(count + 1, 0x9E3779B97F4A7C15, np.uint64)
        base[0] = 1
        self.powers = np.cumprod(base)  # numbers wrap around at 64 bits
        mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        mixed *= np.uint64(0xD6E8FEB86659FD93)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * self.powers[:-1])])
        self.count = count

    def _equal(self, begin: np.ndarray, end: np.ndarray, lag: np.ndarray) -> np.ndarray:
        left = (self.sums[end] - self.sums[begin]) * self.powers[lag]
        return left == self.sums[end + lag] - self.sums[begin + lag]

    def forward(self, at: np.ndarray, lag: np.ndarray) -> np.ndarray:
        reach = np.zeros(len(at), np.int64)
        for k in reversed(range(self.count.bit_length())):
            longer = reach + (1 << k)
            fits = np.flatnonzero(at + lag + longer <= self.count)
            a, q = at[fits], lag[fits]
            good = fits[self._equal(a + reach[fits], a + longer[fits], q)]
            reach[good] = longer[good]
        return reach

    def backward(self, at: np.ndarray, lag: np.ndarray) -> np.ndarray:
        reach = np.zeros(len(at), np.int64)
        for k in reversed(range(self.count.bit_length())):
            longer = reach + (1 << k)
            fits = np.flatnonzero(longer <= at)
            a, q = at[fits], lag[fits]
            good = fits[self._equal(a - longer[fits], a - reach[fits], q)]
            reach[good] = longer[good]
        return reach


def _grams(words: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``GRAM`` words from each place."""
    mixed = (words.astype(np.uint64) + np.uint64(0x632BE59B)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    count = len(words) - GRAM + 1
    total = mixed[:count].copy()
    for k in range(1, GRAM):
        total *= np.uint64(0xBF58476D1CE4E5B9)
        total ^= total >> np.uint64(31)
        total += mixed[k : k + count]
    total *= np.uint64(0x94D049BB133111EB)
    return total ^ (total >> np.uint64(32))


def _seeds(grams: np.ndarray, least: np.ndarray, bits: np.uint64, period: int) -> Iterator[tuple]:
    """Pairs (place, lag) of equal minimizers with lags from ``period`` to twice that."""
    places = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    chosen = places[np.concatenate([[True], places[1:] != places[:-1]])]
    order = chosen[np.lexsort((chosen, grams[chosen]))]
    group = np.cumsum(np.concatenate([[0], grams[order][1:] != grams[order][:-1]]))
    span = len(grams) + 1
    keys = group * span + order
    number = np.empty(span, np.int64)
    number[order] = group
    # Any G starts in a row hold a grid place, and G + (P / 2 + GRAM - 1) = P + 1.
    seeds = np.unique(places[:: period // 2 - GRAM + 2])
    base = number[seeds] * span
    first = np.searchsorted(keys, base + np.minimum(seeds + period, span - 1))
    after = np.searchsorted(keys, base + np.minimum(seeds + 2 * period, span - 1))
    counts = np.maximum(after - first, 0)
    held = np.flatnonzero(counts)
    # So many pairs at a time; one seed has no more than ``period`` of them.
    parts = np.cumsum(counts[held]) // PAIRS
    for part in np.unique(parts):
        some = held[parts == part]
        of = np.repeat(some, counts[some])
        offset = np.arange(len(of)) - np.repeat(np.cumsum(counts[some]) - counts[some], counts[some])
        twins = order[first[of] + offset]
        yield seeds[of], twins - seeds[of]


def _least_periods(runs: np.ndarray) -> np.ndarray:
    """One row for each (start, end), with the least period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        runs = runs[np.concatenate([[True], (runs[1:, :2] != runs[:-1, :2]).any(axis=1)])]
    return runs


def _long_runs(words: np.ndarray, bounds: np.ndarray, short: np.ndarray, least: int) -> np.ndarray:
    """All runs, from those of short periods and the texts' bounds (longest text first)."""
    sizes = np.diff(bounds)
    runs = short
    if len(words) < 2 * SHORT:
        return runs
    grams = _grams(words)
    bits = np.uint64(len(words).bit_length())
    minima = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    width, extension, period = 1, None, SHORT
    while sizes[0] >= 2 * period:
        end = int(bounds[np.searchsorted(-sizes, -2 * period, "right")])
        while 2 * width <= period // 2:
            minima = minima[: end - GRAM + 1]
            minima = np.minimum(minima[:-width], minima[width:])
            width *= 2
        covers, by = _covering(runs, len(words))
        for place, lag in _seeds(grams, minima, bits, period):
            # Inside a run whose period divides the lag, that run is all the pair can give.
            known = (covers[place] > place + lag) & (lag % by[place] == 0)
            place, lag = place[~known], lag[~known]
            same = words[place] == words[place + lag]
            place, lag = place[same], lag[same]
            if not len(place):
                continue
            extension = extension or _Extension(words)
            after, before = extension.forward(place, lag), extension.backward(place, lag)
            long = (after + before >= lag) & (after + before + lag >= least)
            found = np.stack([place - before, place + after + lag, lag], axis=1)[long]
            runs = np.concatenate([runs, _verified(words, _least_periods(found), least)])
        runs = _least_periods(runs)
        period *= 2
    return runs


def _covering(runs: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place the end and period of the run over it that ends last."""
    covers, by = np.zeros(count, np.int64), np.ones(count, np.int64)
    for start, end, period in runs[np.argsort(runs[:, 1], kind="stable")].tolist():
        covers[start:end] = end
        by[start:end] = period
    return covers, by


def _verified(words: np.ndarray, runs: np.ndarray, least: int) -> np.ndarray:
    """The same runs, word by word; where equal hashes misled, all runs of that period."""
    good = []
    for start, end, q in runs.tolist():
        if (words[start : end - q] == words[start + q : end]).all():
            good.append([[start, end, q]])
        else:
            begins, ends = _stretches(words[:-q] == words[q:], max(least, 2 * q) - q)
            good.append(np.stack([begins, ends + q, np.full(len(begins), q)], axis=1))
    return np.concatenate([np.empty((0, 3), np.int64), *good])


def runs_of(texts: list[list], least: int = LEAST) -> list[np.ndarray]:
    """(start, length, period) rows of every text (a list of words), by start and period."""
    out: list = [np.empty((0, 3), np.int64)] * len(texts)
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    begin = 0
    while begin < len(order):
        end, held = begin, 0
        while end < len(order) and (end == begin or held + len(texts[order[end]]) < SEGMENT):
            held += len(texts[order[end]]) + 1
            end += 1
        _search([texts[k] for k in order[begin:end]], order[begin:end], least, out)
        begin = end
    return out


def _search(texts: list[list], numbers: list[int], least: int, out: list) -> None:
    """Fills the runs of texts, longest first, into their places of ``out``."""
    ids: defaultdict = defaultdict()
    ids.default_factory = ids.__len__
    parts, marks = [], 0
    for text in texts:
        parts += [np.fromiter(map(ids.__getitem__, text), np.int64, len(text)), np.array([-1 - marks])]
        marks += 1
    words = np.concatenate(parts)
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    short = np.concatenate([np.empty((0, 3), np.int64), *_short_runs(words, least)])
    runs = _long_runs(words, bounds, _least_periods(short), least)
    of = np.searchsorted(bounds, runs[:, 0], "right") - 1
    for k in np.unique(of):
        mine = runs[of == k]
        rows = np.stack([mine[:, 0] - bounds[k], mine[:, 1] - mine[:, 0], mine[:, 2]], axis=1)
        out[numbers[k]] = rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapsed(words: list, runs: np.ndarray) -> list:
    """The words without what any run repeats after its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return [words[k] for k in kept.tolist()]


def with_runs(
    docs: DataFrame, *, text: str = "text", least: int = LEAST
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the runs of each text and the text without its repeats.

    Returns the table and the names of its new columns, which clash with none of the caller's:
    ``runs`` (array of start, length, period in words, by start and period) and ``collapsed`` (the words that are
    left, joined by one space). Words are runs of anything but ASCII white space, numbered from 0. A
    run is ``least`` words and two periods long at least. A word is left out if a run holds it after that run's
    first period. Null, empty and blank texts have no runs and collapse to the empty text. Equal rows give equal
    results; every row is judged by itself, whatever its other columns. A text lies in one task whole, however
    long: its runs take memory in proportion to its words. An empty table gives an empty one.
    """
    for_texts(docs.sparkSession)
    names = {k: fresh_name(k) for k in ("runs", "collapsed")}
    schema = docs.withColumn(names["runs"], F.lit(None).cast(RUNS)).schema.add(names["collapsed"], StringType())
    at = docs.columns.index(text)
    fields = [pa.field(n, pa.int64()) for n in ("start", "length", "period")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).fill_null(b"").to_pylist()
            words = [t.split() for t in texts]
            found = runs_of(words, least)
            flat = np.concatenate([np.empty((0, 3), np.int64), *found])
            offsets = np.cumsum([0, *map(len, found)])
            rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=fields)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)
            left = [b" ".join(collapsed(w, r)) for w, r in zip(words, found)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists, pa.array(left, pa.binary()).cast(pa.string())], names=schema.names
            )

    return docs.mapInArrow(run, schema), names
