"""Packing along a space-filling curve.

A document's token ids are hashed into a vector, the vector is projected to a few
dimensions, and its place there gives a key on the Hilbert curve. Documents are range-sorted by that
key and laid end to end along the curve, so a sequence holds neighbours; it is cut
every ``length`` tokens. What is left at the end of a range is cut into powers
of two, which are not padded. Nothing is dropped and each id lies in one piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstream.llm.common import Scratch, column_of, for_texts, text_of
from sensorstream.llm.tokenfile import bits_for, pack, unpack
from sensorstream.llm.tokenizing import BatchTokenizer

LENGTH = 2048
#: Packed ids that one task sorts, about.
RANGE_BYTES = 64 * 1024 * 1024
#: Buckets that token ids are hashed to, and dimensions they are projected to.
BUCKETS, DIMENSIONS = 1024, 3
#: Bits of each coordinate; the key has DIMENSIONS times as many.
COORDINATE_BITS = 16
SEED = 5


def hilbert_key(points: np.ndarray, bits: int = COORDINATE_BITS) -> np.ndarray:
    """Places on the Hilbert curve of integer points (rows of coordinates below 2^bits).

    By Skilling's transform ("Programming the Hilbert curve", 2004), for all rows at once.
    """
    x = [points[:, k].astype(np.int64) for k in range(points.shape[1])]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        low = q - 1
        for k in range(n):
            inside = (x[k] & q) != 0
            swap = np.where(inside, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(inside, x[0] ^ low, x[0] ^ swap)
            if k:
                x[k] = x[k] ^ swap
    for k in range(1, n):
        x[k] = x[k] ^ x[k - 1]
    fold = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        fold = np.where(x[n - 1] & (1 << level), fold ^ ((1 << level) - 1), fold)
    x = [v ^ fold for v in x]
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for k in range(n):
            key = (key << 1) | ((x[k] >> level) & 1)
    return key


def curve_keys(ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents, from their ids on end; an empty one lies in the middle."""
    plane = np.random.default_rng(SEED).normal(size=(BUCKETS, DIMENSIONS))
    buckets = (np.random.default_rng(SEED + 1).integers(0, BUCKETS, int(ids.max(initial=0)) + 1))[ids]
    coordinates = np.zeros((len(bounds) - 1, DIMENSIONS))
    for first in range(0, len(coordinates), 256):  # bounded work space
        some = bounds[first : first + 257]
        rows = np.repeat(np.arange(len(some) - 1), np.diff(some))
        cells = rows * BUCKETS + buckets[some[0] : some[-1]]
        counts = np.log1p(np.bincount(cells, minlength=(len(some) - 1) * BUCKETS).reshape(-1, BUCKETS))
        length = np.maximum(np.sqrt((counts * counts).sum(axis=1)), 1e-9)
        coordinates[first : first + len(some) - 1] = counts @ plane / length[:, None]
    scaled = (np.clip(coordinates, -4, 4) + 4) / 8 * ((1 << COORDINATE_BITS) - 1)
    return hilbert_key(scaled.astype(np.int64))


def piece_lengths(tokens: int, length: int = LENGTH) -> Iterator[int]:
    """Lengths of sequences that hold so many tokens without padding: full ones, then powers of two."""
    for _ in range(tokens // length):
        yield length
    rest = tokens % length
    while rest:
        most = 1 << (rest.bit_length() - 1)
        yield most
        rest -= most


def pack_along_curve(
    docs: DataFrame,
    tokenizer: str,
    *,
    vocabulary: int,
    end_id: int = 1,
    length: int = LENGTH,
    id_column: str = "doc_id",
    text: str = "text",
    most_ranges: int | None = None,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` tokens.

    Columns: doc_id, start (ids of the document before the piece), length, doc_tokens,
    sequence_id, offset (of the piece in its sequence), curve_key, ids (as little-endian unsigned 32-bit
    integers on end; empty tables have none). Every document
    ends with ``end_id``; null text counts as empty. Rows that share an id are packed one by one;
    equal texts share a key and are dealt by id and row. An empty table gives an empty one.

    Texts are encoded once; the packed ids are written to the shared folder, dealt by ranges
    of key, and sorted there. There are as many ranges as the ids need at ``RANGE_BYTES`` each, and no fewer than
    the session's shuffle has. Each task reads its range as a stream, or, to leave no more than ``most_ranges`` tasks, several
    ranges one after the other; their sequences run on.
    """
    spark = docs.sparkSession
    for_texts(spark)
    bits = bits_for(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchTokenizer.of_worker(tokenizer, end_id)
        for batch in batches:
            ids, bounds = encoder.encode(batch.column("text"))
            packed = [pack(ids[a:b], bits) for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(curve_keys(ids, bounds)),
                    pa.array(np.diff(bounds)),
                    pa.array(packed, pa.binary()),
                ],
                names=["doc_id", "key", "n", "packed"],
            )

    texts = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text_of(text).alias("text"))
    encoded = texts.mapInArrow(encode, "doc_id long, key long, n long, packed binary")
    placed = Scratch(spark, "packing").write(encoded.withColumn("at", F.monotonically_increasing_id()))
    order = ["key", "doc_id", "at"]
    ids = placed.agg(F.sum("n")).first()[0] or 0
    ranges = -(-ids * bits // (8 * RANGE_BYTES))
    enough = ranges <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartitionByRange(*order) if enough else placed.repartitionByRange(ranges, *order)
    along = dealt.sortWithinPartitions(*order)
    if most_ranges is not None:
        along = along.coalesce(max(most_ranges, ranges, 1))
    return along.mapInArrow(
        lambda batches: _sequences(batches, bits, length),
        "doc_id long, start long, length long, doc_tokens long, sequence_id long, "
        "offset long, curve_key long, ids binary",
    )


def _sequences(batches: Iterator[pa.RecordBatch], bits: int, length: int) -> Iterator[pa.RecordBatch]:
    """Cut the documents of one range; a batch's unfinished sequence waits for the next."""
    number = TaskContext.get().partitionId() << 33
    waiting: list[tuple] = []  # pieces (doc_id, start, ids, doc_tokens, key) of the open sequence
    held = 0
    out: list[tuple] = []

    def close(pieces: list[tuple]) -> None:
        nonlocal number
        offset = 0
        for doc, start, ids, total, key in pieces:
            out.append((doc, start, len(ids), total, number, offset, key, ids))
            offset += len(ids)
        number += 1

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [()] * 8
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "curve_key"]
        arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
        data = [np.ascontiguousarray(ids, "<u4").tobytes() for ids in columns[7]]
        out.clear()
        return pa.RecordBatch.from_arrays([*arrays, pa.array(data, pa.binary())], names=[*names, "ids"])

    for batch in batches:
        docs, keys = batch.column("doc_id").to_pylist(), column_of(batch, "key").tolist()
        counts, packed = column_of(batch, "n").tolist(), batch.column("packed")
        for doc, key, total, data in zip(docs, keys, counts, packed):
            ids, start = unpack(data.as_buffer(), total, bits), 0
            while start < total:
                taken = ids[start : start + length - held]
                waiting.append((doc, start, taken, total, key))
                start += len(taken)
                held += len(taken)
                if held == length:
                    close(waiting)
                    waiting, held = [], 0
        yield flush()
    for room in piece_lengths(held, length):
        pieces = []
        while room:
            doc, start, ids, total, key = waiting.pop(0)
            pieces.append((doc, start, ids[:room], total, key))
            if len(ids) > room:
                waiting.insert(0, (doc, start + room, ids[room:], total, key))
            room -= len(pieces[-1][2])
        close(pieces)
    if out:
        yield flush()
