"""Near-duplicate vectors by spherical-cap filters.

Filter directions come from structured random product codes: after a random rotation a vector
is cut into ``BLOCKS`` parts, each part has ``WORDS`` random unit directions, and every choice of one
per part is a filter, a million in all. A vector goes to the filters whose direction it exceeds in
inner product; they are list-decoded from the sorted scores of the parts, not by
trying all. (Becker, Ducas, Gama, Laarhoven, "New directions in nearest neighbor searching", 2016.)

With one height for all caps, the lists would run from none to thousands of filters, and half of the
links would be missed. So each vector's caps are as high as leaves ``PER_CODE`` filters in each
of ``CODES`` independent codes; at cosine 0.95 two vectors share some filter in 99.9 % of
cases (simulated on random pairs in 64 dimensions), and more often above.

Vectors meet in their common filters, and each pair is verified in double precision. A pair counts
in the least of its common filters only, so links are counted, not listed; from a
filter leave one row per linked vector, with the number of its links there and one
vector it is connected with. Filters of more than ``MOST`` vectors are cut into blocks that meet two by
two: the work of a tight cluster is the square of its distinct vectors, as its links
are, but no task holds more than two blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorstream.llm.common import Scratch, column_of, for_texts, sorted_groups
from sensorstream.llm.components import components

THRESHOLD = 0.95
BLOCKS, WORDS = 4, 32
CODES, PER_CODE = 4, 6
SEED = 3
#: Vectors of a filter that are compared in one go.
MOST = 1024
#: Hot filters that are broadcast; with more of them, they are joined by a shuffle.
MOST_BROADCAST = 50_000


@lru_cache(maxsize=32)
def product_code(dimension: int, code: int) -> tuple[np.ndarray, np.ndarray]:
    """A rotation of (padded) space and the directions of each part."""
    rng = np.random.default_rng([SEED, dimension, code])
    part = -(-dimension // BLOCKS)
    words = min(WORDS, 1 << min(part, 5))  # parts of few dimensions have few directions
    rotation, _ = np.linalg.qr(rng.normal(size=(part * BLOCKS, part * BLOCKS)))
    directions = rng.normal(size=(BLOCKS, words, part))
    return rotation, directions / np.linalg.norm(directions, axis=2, keepdims=True)


def cap_filters(unit: np.ndarray) -> np.ndarray:
    """Numbers of the filters that each unit vector exceeds most, ``PER_CODE`` of each code."""
    count, dimension = unit.shape
    found = []
    for code in range(CODES):
        rotation, directions = product_code(dimension, code)
        padded = np.pad(unit, ((0, 0), (0, len(rotation) - dimension)))
        parts = (padded @ rotation).reshape(count, BLOCKS, -1)
        scores = np.einsum("nbk,bwk->nbw", parts, directions)
        words = directions.shape[1]
        left = (scores[:, 0, :, None] + scores[:, 1, None, :]).reshape(count, -1)
        right = (scores[:, 2, :, None] + scores[:, 3, None, :]).reshape(count, -1)
        # The best sums of two halves lie among the best of either half.
        few = min(PER_CODE, words * words)
        best_left, best_right = (np.argsort(-half, axis=1, kind="stable")[:, :few] for half in (left, right))
        total = (
            np.take_along_axis(left, best_left, 1)[:, :, None]
            + np.take_along_axis(right, best_right, 1)[:, None, :]
        ).reshape(count, -1)
        top = np.argsort(-total, axis=1, kind="stable")[:, :PER_CODE]
        pair = np.take_along_axis(best_left, top // few, 1) * words * words + np.take_along_axis(
            best_right, top % few, 1
        )
        found.append(pair + code * WORDS**BLOCKS)
    return np.concatenate(found, axis=1)


def _array_of(value) -> np.ndarray | None:
    """A usable vector in double precision, or None: null, zero, null or non-finite components."""
    if value is None or not len(value) or any(v is None for v in value):
        return None
    vector = np.asarray(value, np.float64) + 0.0  # no negative zeros
    return vector if np.isfinite(vector).all() and vector.any() else None


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [_array_of(v) for v in batch.column("v").to_pylist()]
        data = [None if v is None else v.tobytes() for v in vectors]
        codes = [None if d is None else hashlib.sha256(d).digest() for d in data]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(codes, pa.binary()), pa.array(data, pa.binary())],
            names=["id", "code", "data"],
        )


def _filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [np.frombuffer(d.as_buffer()) for d in batch.column("data")]
        lists: list = [None] * len(vectors)
        for dimension in {len(v) for v in vectors}:
            rows = [k for k, v in enumerate(vectors) if len(v) == dimension]
            for begin in range(0, len(rows), 512):  # bounded work space
                some = rows[begin : begin + 512]
                matrix = np.stack([vectors[k] for k in some])
                matrix /= np.abs(matrix).max(axis=1)[:, None]  # no overflow in the norm
                unit = matrix / np.linalg.norm(matrix, axis=1)[:, None]
                for k, found in zip(some, cap_filters(unit)):
                    lists[k] = np.unique(found).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(lists, pa.list_(pa.int32()))],
            names=[*batch.schema.names, "filters"],
        )


def _linked(matrix: np.ndarray, homes: np.ndarray, across: bool, threshold: float) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1)[:, None]
    norms = np.linalg.norm(scaled, axis=1)
    links = scaled @ scaled.T >= threshold * norms[:, None] * norms[None, :]
    np.fill_diagonal(links, False)
    if across:
        links &= homes[:, None] != homes[None, :]
    return links


def _first_here(links: np.ndarray, lists: list[np.ndarray], number: int) -> np.ndarray:
    """Drop links of vectors that meet in a filter before this one."""
    earlier = [found[found < number] for found in lists]
    values, counts = np.unique(np.concatenate(earlier), return_counts=True)
    shared = values[counts > 1]
    if not len(shared):
        return links
    member = np.zeros((len(lists), len(shared)), np.float32)
    for k, found in enumerate(earlier):
        member[k, np.searchsorted(shared, found[np.isin(found, shared)])] = 1
    return links & (member @ member.T < 0.5)


def _roots(links: np.ndarray) -> np.ndarray:
    """For each row the first row of its connected part."""
    root = np.full(len(links), -1)
    for start in range(len(links)):
        if root[start] < 0:
            root[start], edge = start, [start]
            while edge:
                found = np.flatnonzero(links[edge.pop()] & (root < 0))
                root[found] = start
                edge += found.tolist()
    return root


def _verified(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in sorted_groups(batches, ["dimension", "filter", "i", "j"]):
            nodes, copies, homes = (column_of(rows, c) for c in ("node", "copies", "home"))
            filters, i, j = (column_of(rows, c) for c in ("filter", "i", "j"))
            data, lists = rows.column("data"), rows.column("filters")
            out: tuple[list, list, list] = ([], [], [])
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if b - a < 2:
                    continue
                matrix = np.stack([np.frombuffer(data[k].as_buffer()) for k in range(a, b)])
                links = _linked(matrix, homes[a:b], i[a] != j[a], threshold)
                some = np.flatnonzero(links.any(axis=1))
                if not len(some):
                    continue
                links = links[np.ix_(some, some)]
                links = _first_here(links, [lists[a + k].values.to_numpy() for k in some], filters[a])
                kept = np.flatnonzero(links.any(axis=1))
                if not len(kept):
                    continue
                links, some = links[np.ix_(kept, kept)], some[kept] + a
                out[0].append(nodes[some])
                out[1].append(nodes[some][_roots(links)])
                out[2].append(links @ copies[some])
            arrays = [pa.array(np.concatenate([np.empty(0, np.int64), *c]).astype(np.int64)) for c in out]
            yield pa.RecordBatch.from_arrays(arrays, names=["node", "root", "n"])

    return run


def near_duplicate_vectors(
    table: DataFrame, *, id_column: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    ``n_links`` counts the other rows whose vector was found at cosine ``threshold`` or more,
    ``component_id`` is the least id reachable by links, ``kept`` says whether that is the row's own.
    Equal vectors are one node and count as linked. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing, nor do vectors of different dimensions. Null
    ids are passed over in the least id; a row with a null id is kept if it is alone. Rows
    that share an id are vectors of their own. An empty table gives an empty one.
    """
    spark = table.sparkSession
    for_texts(spark)
    scratch = Scratch(spark, "vectors")
    rows = scratch.write(
        table.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).alias("v")).mapInArrow(
            _digested, "id long, code binary, data binary"
        )
    )
    classes = (
        rows.where("code is not null")
        .groupBy("code")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("data").alias("data"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    coded = scratch.write(
        classes.mapInArrow(
            _filtered, "code binary, first long, copies long, data binary, node long, filters array<int>"
        )
    )
    members = coded.select(
        "node", "copies", "data", "filters", F.length("data").alias("dimension"), F.explode("filters").alias("filter")
    )
    key = ["dimension", "filter"]
    sizes = members.groupBy(*key).agg(F.count(F.lit(1)).alias("size"))
    hot = scratch.write(sizes.where(F.col("size") > MOST))
    few = hot.count() <= MOST_BROADCAST
    parts = F.ceil(F.coalesce("size", F.lit(1)) / (MOST // 2)).cast("int")
    home = F.pmod(F.hash("node"), parts)
    pairs = F.when(parts == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), parts - 1),
            lambda k: F.struct(F.least(k, home).alias("i"), F.greatest(k, home).alias("j")),
        )
    )
    met = (
        members.join(F.broadcast(hot) if few else hot.hint("merge"), key, "left")
        .withColumn("home", home)
        .withColumn("pair", F.explode(pairs))
        .select("node", "copies", "data", "filters", *key, "home", "pair.i", "pair.j")
        .repartition(*key, "i", "j")
        .sortWithinPartitions(*key, "i", "j")
    )
    links = scratch.write(met.mapInArrow(_verified(threshold), "node long, root long, n long"))
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(spark, links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    nodes = scratch.write(
        coded.select("code", "first", "copies", "node")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = scratch.write(nodes.groupBy("root").agg(F.min("first").alias("component_id")))
    named = scratch.write(
        nodes.join(least.hint("merge"), "root").select(
            "code",
            "component_id",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    found = rows.where("code is not null").select("id", "code").join(named.hint("merge"), "code").drop("code")
    alone = rows.where("code is null").select("id", F.col("id").alias("component_id"), F.lit(0).cast("bigint").alias("n_links"))
    return (
        found.unionByName(alone)
        .select(
            F.col("id").alias("vec_id"),
            "n_links",
            "component_id",
            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )
