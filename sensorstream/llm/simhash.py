"""SimHash near-duplicates by covering locality-sensitive hashing.

A document's fingerprint has 64 bits: each is the majority of that bit in the XXH64
hashes of its word shingles. Two fingerprints link when they differ in at most
``radius`` bits. Each bit position gets a random vector of ``radius + 1`` bits, and each
nonzero vector v gets a table whose mask drops the positions orthogonal to v. The
positions in which a pair differs span at most ``radius`` dimensions, so some v is
orthogonal to all of them, and in its table the pair collides: no linked pair is
missed (Pagh, "CoveringLSH", 2016).

Equal fingerprints are one node from the start. From a bucket only a spanning star of
each connected part leaves the worker, never all pairs. Buckets of more than ``most``
fingerprints are not compared pairwise: their members step ``radius`` times to
neighbours one bit apart that two of them share (see ``_hot_links``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from sensorstream.llm.common import (
    Scratch,
    column_of,
    for_texts,
    fresh_name,
    sorted_groups,
    with_arrow,
)
from sensorstream.llm.components import components

BITS = 64
SEED = 42
#: Fingerprints of a bucket that one task compares pairwise.
MOST = 2048


def fingerprint(text: str | None, size: int = 3) -> int:
    """64-bit SimHash of a text's word shingles; 0 without words.

    Words are runs of anything but ASCII white space, A-Z in lower case; a text of fewer
    words than a shingle is one shingle.
    """
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shifted = [words[k:] for k in range(min(size, len(words)))]
    shingles = map(b" ".join, zip(*shifted))
    count = len(shifted[-1])
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, count)
    ones = np.zeros(BITS, np.int64)
    for begin in range(0, count, 65536):  # bounded for very long texts
        part = hashes[begin : begin + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * ones > count, bitorder="little")
    return int(majority.view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str, size: int = 3, text: str = "text") -> DataFrame:
    """Adds the fingerprint as a signed 64-bit integer. Null text: no words."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        prints = np.fromiter((fingerprint(t, size) for t in texts), np.uint64, len(texts))
        return [pa.array(prints.view(np.int64))]

    return with_arrow(docs, [(name, LongType())], compute)


def covering_masks(radius: int, seed: int = SEED) -> list[int]:
    """Masks such that any two numbers within ``radius`` bits agree under one of them."""
    space = 1 << (radius + 1)
    # Each position takes one of the nonzero vectors in turn, in a random order.
    vectors = np.random.default_rng(seed).permutation(np.arange(BITS) % (space - 1) + 1)
    return [
        sum(1 << k for k in range(BITS) if (int(vectors[k]) & v).bit_count() % 2)
        for v in range(1, space)
    ]


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def near_links(
    spark: SparkSession, prints: DataFrame, radius: int = 2, *, most: int = MOST
) -> DataFrame:
    """Links (a, b) that connect what lies within ``radius`` bits, from distinct prints (fp).

    A spanning set, not all pairs: components of these links are those of all links.
    """
    masks = covering_masks(radius)
    tables = F.explode(
        F.array(
            *(
                F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                for t, m in enumerate(masks)
            )
        )
    )
    entries = prints.select("fp", tables.alias("e")).select("fp", "e.table", "e.key")
    scratch = Scratch(spark, "simhash-tables")
    rows = len(masks) * prints.count()
    sizes = entries.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n"))
    full = scratch.write(
        entries.join(sizes.where("n > 1").hint("merge"), ["table", "key"]), rows
    )
    cold = full.where(F.col("n") <= most)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in sorted_groups(batches, ["table", "key"]):
            prints = column_of(rows, "fp").view(np.uint64)
            a, b = [], []
            for begin, end in zip(bounds[:-1], bounds[1:]):
                for node, root in _spanning(prints[begin:end], radius):
                    a.append(begin + node)
                    b.append(begin + root)
            signed = prints.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed[np.array(a, int)]), pa.array(signed[np.array(b, int)])],
                names=["a", "b"],
            )

    near = (
        cold.repartition("table", "key")
        .sortWithinPartitions("table", "key")
        .mapInArrow(compare, "a long, b long")
    )
    hot = full.where(F.col("n") > most).select("fp").distinct()
    return near.union(_hot_links(hot, radius))


def _spanning(prints: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """(node, root) for the connected parts of one bucket; each print is compared once."""
    left = np.arange(len(prints))
    while len(left) > 1:
        root, left = int(left[0]), left[1:]
        edge = [root]
        while edge and len(left):
            near = np.bitwise_count(prints[left] ^ prints[edge.pop()]) <= radius
            found = left[near].tolist()
            left = left[~near]
            edge += found
            yield from zip(found, repeat(root))


def _hot_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links between the members of hot buckets without pairs.

    Two prints differ in at most two bits exactly if they are equal, one bit apart, or
    share a neighbour one bit from both. So each print goes to its 64 neighbours and
    itself, and those that meet link with the least that came. For radius 1 only
    neighbours that are themselves prints count; more than 2 bits are refused.
    """
    if radius > 2:
        raise ValueError("buckets beyond `most` are resolved for a radius of 2 at most")
    flips = F.array(*(F.lit(_signed(1 << k)) for k in range(BITS)))
    spread = F.explode(F.array_append(F.transform(flips, lambda f: F.col("fp").bitwiseXOR(f)), F.col("fp")))
    met = prints.select(spread.alias("at"), "fp")
    least = met.groupBy("at").agg(
        F.min("fp").alias("b"),
        F.max("fp").alias("c"),
        F.max(F.col("fp") == F.col("at")).alias("real"),
    ).where(F.col("b") != F.col("c"))
    if radius == 1:
        least = least.where("real").withColumn("b", F.col("at"))
    linked = met.join(least, "at").where(F.col("fp") != F.col("b"))
    return linked.select(F.col("fp").alias("a"), "b")


def near_duplicates(
    docs: DataFrame,
    *,
    size: int = 3,
    radius: int = 2,
    id_column: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
    most: int = MOST,
) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` (or its columns ``carry``) with the fingerprint, the group's least id and whether the row stays.

    Returns the table and the names of its new columns (``fingerprint``: signed long,
    ``component``: least id of the group, ``kept``: true for one row of each group), which
    clash with none of the caller's. The row with the least id stays; of rows that share
    it, one. Null text counts as empty, and all texts without words link. A null id sorts
    after all others: a group has a null component only if all its ids are null. An empty
    table gives an empty one.
    """
    spark = docs.sparkSession
    for_texts(spark)
    names = {k: fresh_name(k) for k in ("fingerprint", "component", "kept")}
    fp, place = names["fingerprint"], fresh_name("place")
    scratch = Scratch(spark, "simhash")
    carried = [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]
    printed = with_fingerprint(docs, fp, size, text)
    prints = scratch.write(printed.select(*carried, fp, F.monotonically_increasing_id().alias(place)))
    many = prints.count()
    first = F.struct(
        F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.col(place).alias("at")
    )
    distinct = scratch.write(prints.groupBy(F.col(fp).alias("fp")).agg(F.min(first).alias("first")), many)
    links = near_links(spark, distinct.select("fp"), radius, most=most)
    rooted = distinct.join(
        components(spark, links, many).select(F.col("node").alias("fp"), "root"), "fp", "left"
    ).select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = scratch.write(rooted, many)
    best = scratch.write(rooted.groupBy("root").agg(F.min("first").alias("best")), many)
    stays = fresh_name("best")
    groups = scratch.write(
        rooted.join(best.hint("merge"), "root").select(F.col("fp").alias(fp), F.col("best").alias(stays)), many
    )
    grouped = prints.join(groups.hint("merge"), fp)
    out = [
        *carried,
        F.col(fp),
        F.col(stays)["id"].alias(names["component"]),
        (F.col(place) == F.col(stays)["at"]).alias(names["kept"]),
    ]
    return grouped.select(*out), names


def hex_of(bits: Column) -> Column:
    """16 lower-case hex digits of a signed 64-bit integer."""
    return F.lower(F.lpad(F.hex(bits), 16, "0"))
