"""Repeated passages by prefix doubling over sampled suffixes.

A byte is removed if a string of ``length`` bytes covers it that also starts earlier in
the corpus. Prefix doubling names the string of 2h bytes at a position by the pair of
names at i and i + h: equal names, equal strings. Here a task makes the names of 8, 16, 32, ...
bytes of its own texts, and Spark sorts positions by name wherever ranks must be settled
across documents. Positions whose name is unique leave; the rest are ranked again by
longer names until they leave or the names are ``length`` bytes long.

All positions at once would be sorted with about twenty bytes for each byte of text and round. So
the first ranking takes a sample that no repeat escapes: of the 32-byte names inside
a string of ``length`` bytes the least is its *anchor* (equal strings, equal anchors), and the neighbouring
strings with one anchor are a *range*. Three rankings follow, each by a *core* that all strings of a
range share and the *whole* text that they cover:

    ranges of an anchor      core: the anchor, 32 of 100 bytes
    blocks of such ranges    core: 93 bytes, the block's strings start within 8 bytes
    single strings           core and whole: the string

A unique core: none of the strings repeats. A whole met before: all of them do. Otherwise
the range goes on to the next ranking in smaller parts. Of ranges with one whole text only the
earliest goes on, as an earliest string always lies in an earliest range.

Ranges that a batch of documents has seen before are settled there and never sorted, so a text that a third
of all rows share costs a few rows per batch. Cores that a sample of documents shows to be frequent
are dealt out by their whole text and count as not unique, which only makes more work.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.llm.common import Scratch, column_of, for_texts, fresh_name, text_of

LENGTH = 100
#: Starts of strings that share a core in the second ranking.
BLOCK = 8
#: Starts that are named in one go.
PIECE = 1 << 16
#: One document in so many is looked at for frequent cores; those above the share of its cores count.
SAMPLE, HOT_SHARE, HOT_ROWS = 64, 0.001, 8

RANGES = "core long, whole long, id long, place long, first int, shape int, state int"
#: What a range is: not settled yet, or all of its strings repeat.
OPEN, REPEATS = 0, 1

_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def pair_name(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit names of pairs of names."""
    x = a * _C1  # numbers wrap around at 64 bits
    x ^= x >> np.uint64(32)
    x += b
    x *= _C2
    x ^= x >> np.uint64(29)
    return x


class Names:
    """Names of the strings in a run of bytes. The bytes end with 8 that belong to no string."""

    def __init__(self, data: np.ndarray) -> None:
        self.eights = np.lib.stride_tricks.sliding_window_view(data, 8)

    def at(self, places: np.ndarray, size: int) -> np.ndarray:
        """Names of ``size`` bytes (8 at least) at the places, each from two that are half as long or longer."""
        if size == 8:
            return np.ascontiguousarray(self.eights[places]).view("<u8").ravel()
        half = 1 << (size - 1).bit_length() - 1
        return pair_name(self.at(places, half), self.at(places + (size - half), half))

    def all(self, begin: int, end: int, size: int) -> np.ndarray:
        """Names at all places from ``begin``, ``size`` a power of two."""
        names = np.ascontiguousarray(self.eights[begin : end + size - 8]).view("<u8").ravel()
        half = 8
        while half < size:
            names = pair_name(names[:-half], names[half:])
            half *= 2
        return names


def gram_of(length: int) -> int:
    """Bytes of an anchor: a power of two, at most a third of the string."""
    if length < 24:
        raise ValueError("strings of 24 bytes at least")
    return 1 << (length // 3).bit_length() - 1


def anchored(names: Names, begin: int, end: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of the strings that start from ``begin`` to ``end``, and the names of the anchors."""
    gram = gram_of(length)
    width = length - gram + 1
    grams = names.all(begin, end + width - 1, gram)
    bits = np.uint64((PIECE + length).bit_length())
    # The least name by its upper bits, then the leftmost: one number says both.
    least = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: reach - width], least[width - reach :])
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    return at + begin, grams[at]


class Texts:
    """The bytes of a batch's texts on end."""

    def __init__(self, column: pa.Array, spare: int) -> None:
        column = column.fill_null(b"").cast(pa.binary())
        _, offsets, data = column.buffers()
        bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
        self.bounds = bounds.astype(np.int64) - int(bounds[0])
        held = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None and data.size else ()
        # Strings run over the end of the last text only where they are left out below.
        self.data = np.concatenate([np.asarray(held, np.uint8), np.zeros(spare, np.uint8)])
        self.names = Names(self.data)


def ranges_of(texts: Texts, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first, last, anchor, name) of the ranges, in bytes from the start of the batch."""
    bounds = texts.bounds
    for begin in range(0, int(bounds[-1]), PIECE):
        end = min(begin + PIECE, int(bounds[-1]))
        starts = np.arange(begin, end)
        rows = np.searchsorted(bounds, starts, "right") - 1
        fits = starts + length <= bounds[rows + 1]
        if not fits.any():
            continue
        anchors, grams = anchored(texts.names, begin, end, length)
        starts, rows, anchors, grams = starts[fits], rows[fits], anchors[fits], grams[fits]
        new = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])])
        firsts = np.flatnonzero(new)
        lasts = np.append(firsts[1:], len(starts)) - 1
        yield rows[firsts], starts[firsts], starts[lasts], anchors[firsts], grams[firsts]


def _whole(names: Names, first: np.ndarray, last: np.ndarray, core: np.ndarray, length: int) -> np.ndarray:
    """Names of what the strings from first to last cover, with the place of the core in it."""
    ends = pair_name(names.at(first, length), names.at(last, length))
    return pair_name(ends, ((last - first) << 32 | (core - first)).astype(np.uint64))


def _seen(core, whole, id_, none, place, first) -> np.ndarray:
    """Which ranges have an equal one at an earlier place in the corpus."""
    order = np.argsort(whole, kind="stable")
    equal = whole[order][1:] == whole[order][:-1]
    some = order[np.append(equal, False) | np.append(False, equal)]
    some = some[np.lexsort([k[some] for k in (first, place, id_, none, core, whole)])]
    seen = np.zeros(len(core), bool)
    seen[some[1:]] = (core[some][1:] == core[some][:-1]) & (whole[some][1:] == whole[some][:-1])
    return seen


def _spans(place: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping or touching spans of one place as one."""
    order = np.lexsort((first, place))
    place, first, end = place[order], first[order], end[order]
    new = np.concatenate([[True], place[1:] != place[:-1]])
    # Ends so far, within a place: places are told apart by adding what no end reaches.
    number = np.cumsum(new) - 1
    step = int(end.max(initial=0)) + 1
    reach = np.maximum.accumulate(end + number * step) - number * step
    new[1:] |= first[1:] > reach[:-1]
    begins = np.flatnonzero(new)
    last = np.append(begins[1:], len(place)) - 1
    return place[begins], first[begins], reach[last]


def _rows(core, whole, id_, none, place, first, last, anchor, length) -> pa.RecordBatch:
    """Ranges of one batch: open ones, and the spans of those that the batch has seen before.

    ``id_``, ``none`` and ``place`` are those of each range's document; the rest counts from its start.
    """
    seen = _seen(core, whole, id_, none, place, first)
    old, new = np.flatnonzero(seen), np.flatnonzero(~seen)
    if len(old):
        spans = _spans(place[old], first[old], last[old] + length)
    else:
        spans = tuple(np.empty(0, np.int64) for _ in range(3))
    empty = np.zeros(len(spans[0]), np.int64)
    shape = (anchor[new] - first[new]) << 16 | (last[new] - first[new])
    columns = [
        pa.array(np.concatenate([core[new].view(np.int64), empty])),
        pa.array(np.concatenate([whole[new].view(np.int64), empty])),
        pa.array(np.concatenate([id_[new], empty]), mask=np.concatenate([none[new], empty > -1])),
        pa.array(np.concatenate([place[new], spans[0]])),
        pa.array(np.concatenate([first[new], spans[1]]).astype(np.int32)),
        pa.array(np.concatenate([shape, spans[2] - spans[1]]).astype(np.int32)),
        pa.array(np.repeat([OPEN, REPEATS], [len(new), len(empty)]).astype(np.int32)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in RANGES.split(", ")])


def _ids_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = batch.column("id")
    none = ids.is_null().to_numpy(zero_copy_only=False)
    return ids.fill_null(0).to_numpy(), none, column_of(batch, "place")


def _first_ranking(length: int) -> Callable:
    """Ranges of an anchor, from (id, place, body)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = Texts(batch.column("body"), 2 * length + 8)
            found = list(ranges_of(texts, length))
            if not found:
                continue
            row, first, last, anchor, core = (np.concatenate(part) for part in zip(*found))
            whole = _whole(texts.names, first, last, anchor, length)
            ids, none, place = _ids_of(batch)
            base = texts.bounds[row]
            yield _rows(
                core, whole, ids[row], none[row], place[row], first - base, last - base, anchor - base, length
            )

    return run


def _parts_ranking(length: int, block: int) -> Callable:
    """Blocks of open ranges, from (id, place, body, open: list of (first, shape))."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = Texts(batch.column("body"), 2 * length + 8)
            lists = batch.column("open")
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            parts = lists.flatten()
            base = texts.bounds[row]
            first = _field(parts, "first") + base
            shape = _field(parts, "shape")
            last, anchor = first + (shape & 0xFFFF), first + (shape >> 16)
            # Blocks are counted back from the anchor, so that equal strings lie in equal blocks.
            least, most = (anchor - last) // block, (anchor - first) // block
            count = most - least + 1
            of = np.repeat(np.arange(len(row)), count)
            number = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + least[of]
            core_at = anchor[of] - block * number
            begin = np.maximum(first[of], core_at - block + 1)
            end = np.minimum(last[of], core_at)
            core = texts.names.at(core_at, length - block + 1)
            whole = _whole(texts.names, begin, end, core_at, length)
            ids, none, place = _ids_of(batch)
            row, base = row[of], base[of]
            yield _rows(
                core, whole, ids[row], none[row], place[row], begin - base, end - base, core_at - base, length
            )

    return run


def _field(parts: pa.StructArray, name: str) -> np.ndarray:
    return parts.field(name).to_numpy(zero_copy_only=False).astype(np.int64)


def _settle(length: int, final: bool, hot: frozenset) -> Callable:
    """Open ranges sorted by core, whole and place: those that repeat, and those that go on.

    Holds one row of a core at a time. The first whole of a core goes on when a second one turns up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        core_before = whole_before = None
        pending: pa.RecordBatch | None = None  # the first range of a core with one whole so far
        for batch in batches:
            if not batch.num_rows:
                continue
            state = column_of(batch, "state")
            core, whole = column_of(batch, "core"), column_of(batch, "whole")
            is_open = state == OPEN
            same_core = np.concatenate([[core[0] == core_before], core[1:] == core[:-1]])
            same = same_core & np.concatenate([[whole[0] == whole_before], whole[1:] == whole[:-1]])
            core_before, whole_before = core[-1], whole[-1]
            repeats = is_open & same
            leads = is_open & ~same  # the earliest of each whole
            opens = leads & ~same_core  # the first whole of a core
            out = [_marked(batch, repeats, length), batch.filter(pa.array(~is_open))]
            if not final:
                places = np.flatnonzero(leads)
                if len(places):
                    if pending is not None and not opens[places[0]]:
                        out.append(pending)
                    followed = np.append(~opens[places[1:]], False)
                    frequent = np.isin(core[places], list(hot)) if hot else np.zeros(len(places), bool)
                    goes_on = ~opens[places] | followed | frequent
                    out.append(batch.take(pa.array(places[goes_on])))
                    last = places[-1]
                    waits = opens[last] and not frequent[-1]
                    pending = batch.slice(int(last), 1) if waits else None
            yield from (b for b in out if b.num_rows)

    return run


def _marked(batch: pa.RecordBatch, rows: np.ndarray, length: int) -> pa.RecordBatch:
    """Ranges whose strings all repeat, as spans."""
    found = batch.filter(pa.array(rows))
    shape = (column_of(found, "shape") & 0xFFFF) + length
    columns = {**dict(zip(found.schema.names, found.columns))}
    columns["shape"] = pa.array(shape.astype(np.int32))
    columns["state"] = pa.array(np.full(found.num_rows, REPEATS, np.int32))
    return pa.RecordBatch.from_arrays([columns[n] for n in found.schema.names], names=found.schema.names)


class _Ranking:
    """One ranking: rows from a table of texts, dealt out by core, sorted and settled."""

    def __init__(self, spark: SparkSession, scratch: Scratch, length: int) -> None:
        self.spark, self.scratch, self.length = spark, scratch, length

    def hot_cores(self, rows: DataFrame) -> list[int]:
        """Frequent cores of a sample's rows, at most 1 / ``HOT_SHARE`` of them."""
        opened = rows.where(F.col("state") == OPEN)
        counts = self.scratch.write(opened.groupBy("core").agg(F.count(F.lit(1)).alias("n")))
        total = counts.agg(F.sum("n")).first()[0] or 0
        bound = max(HOT_ROWS, HOT_SHARE * total)
        return [r.core for r in counts.where(F.col("n") >= bound).collect()]

    def settled(self, rows: DataFrame, hot: list[int], *, final: bool = False) -> DataFrame:
        route = F.when(F.col("state") == REPEATS, F.xxhash64("place", "first"))
        if hot:
            route = route.when(F.col("core").isin(hot), F.xxhash64("core", "whole"))
        order = ["core", "whole", F.asc_nulls_last("id"), "place", "first"]
        dealt = rows.repartition(route.otherwise(F.xxhash64("core"))).sortWithinPartitions("state", *order)
        return self.scratch.write(dealt.mapInArrow(_settle(self.length, final, frozenset(hot)), RANGES))


def _texts_table(spark: SparkSession, docs: DataFrame, place: str) -> DataFrame:
    """The documents with a number for each row, written in buckets by it, so that joins by it move no text."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = Scratch(spark, "repeats-texts").path()
    name = f"repeats_{uuid.uuid4().hex[:12]}"
    (
        docs.withColumn(place, F.monotonically_increasing_id())
        .repartition(buckets, place)
        .write.format("parquet")
        .option("path", path)
        .option("compression", "zstd")
        .bucketBy(buckets, place)
        .saveAsTable(name)
    )
    return spark.table(name)


def without_repeats(
    docs: DataFrame,
    *,
    length: int = LENGTH,
    id_column: str = "doc_id",
    text: str = "text",
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with what is left of each text when repeated strings of ``length`` bytes are removed.

    Returns the table and the names of its new columns, which clash with none of the
    caller's: ``n_bytes`` of the text in UTF-8, ``spans`` (array of begin, end: the maximal runs of removed bytes),
    ``kept`` (binary: the other bytes on end; a character may be cut where a run ends).

    A byte goes if a string of ``length`` bytes covers it that starts earlier too: in a document
    of smaller id, or in the same one further left. Strings never cross documents and are judged
    on the input. Null text counts as empty. Null ids come after all others. Rows that share an id follow each
    other in an order of their own, so the later of two equal rows is removed. Texts shorter than ``length``
    stay whole. An empty table gives an empty one.

    Names have 64 bits; a range counts as met before if its core's and its whole text's names are both equal.
    """
    spark = docs.sparkSession
    for_texts(spark)
    names = {k: fresh_name(k) for k in ("n_bytes", "spans", "kept")}
    place, body = fresh_name("place"), text_of(text).cast("binary")
    scratch = Scratch(spark, "repeats")
    held = _texts_table(spark, docs, place)
    texts = held.select(F.col(id_column).cast("bigint").alias("id"), F.col(place).alias("place"), body.alias("body"))
    sampled = F.pmod(F.xxhash64("place"), F.lit(SAMPLE)) == 0
    ranking = _Ranking(spark, scratch, length)

    first = _first_ranking(length)
    hot = ranking.hot_cores(texts.where(sampled).mapInArrow(first, RANGES))
    found = [ranking.settled(texts.mapInArrow(first, RANGES), hot)]
    for block in (BLOCK, 1):
        parts = F.collect_list(F.struct("first", "shape")).alias("open")
        open_ranges = found[-1].where(F.col("state") == OPEN).groupBy("place").agg(parts)
        joined = texts.join(open_ranges.hint("merge"), "place").select("id", "place", "body", "open")
        run = _parts_ranking(length, block)
        hot = [] if block == 1 else ranking.hot_cores(joined.where(sampled).mapInArrow(run, RANGES))
        found.append(ranking.settled(joined.mapInArrow(run, RANGES), hot, final=block == 1))
    spans = found[0].where(F.col("state") == REPEATS)
    for more in found[1:]:
        spans = spans.unionAll(more.where(F.col("state") == REPEATS))
    runs, at = fresh_name("runs"), fresh_name("at")
    removed = spans.groupBy(F.col("place").alias(at)).agg(
        F.collect_list(F.struct(F.col("first"), (F.col("first") + F.col("shape")).alias("end"))).alias(runs)
    )
    joined = held.join(removed.hint("merge"), F.col(place) == F.col(at), "left")
    return _cut(joined, docs.columns, text, runs, names), names


def _cut(frame: DataFrame, columns: list[str], text: str, runs: str, names: dict[str, str]) -> DataFrame:
    """The texts without their runs."""
    carried = [F.col(f"`{c}`") for c in columns]
    frame = frame.select(*carried, runs)
    text_at = frame.columns.index(text)
    kinds = {names["n_bytes"]: "bigint", names["spans"]: "array<struct<begin:int,end:int>>", names["kept"]: "binary"}
    out = frame.select(*carried, *(F.lit(None).cast(kind).alias(n) for n, kind in kinds.items())).schema
    fields = [pa.field("begin", pa.int32()), pa.field("end", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, begins, ends, bounds, kept = [], [], [], [0], []
            for data, found in zip(batch.column(text_at), batch.column(len(columns))):
                raw = memoryview(data.as_buffer() if data.is_valid else b"")
                sizes.append(len(raw))
                if found.is_valid:
                    first, last = (_field(found.values, n) for n in ("first", "end"))
                    _, first, last = _spans(np.zeros(len(first), np.int64), first, last)
                    begins += first.tolist()
                    ends += last.tolist()
                    inner = zip([0, *last.tolist()], [*first.tolist(), len(raw)])
                    kept.append(b"".join(raw[a:b] for a, b in inner))
                else:
                    kept.append(bytes(raw))
                bounds.append(len(begins))
            pairs = pa.StructArray.from_arrays(
                [pa.array(begins, pa.int32()), pa.array(ends, pa.int32())], fields=fields
            )
            spans = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(columns)], pa.array(sizes, pa.int64()), spans, pa.array(kept, pa.binary())],
                names=out.names,
            )

    return frame.mapInArrow(run, out)
