"""Hard negatives by inner product, found in cover trees.

Vectors get one component more, the root of M^2 - |x|^2 with M the greatest norm, so that all
lie on a sphere and a great inner product with an anchor is a small distance to it. A cover
tree halves the covering radius of its nodes level by level: a node's centre is one of its vectors, all
its vectors lie within its radius, and the centres below it are more than half of that radius apart. From the
distance to the centre and the radius follow the least and the greatest inner product that a vector of the node can
have. The search keeps the nodes that may still matter, opens the most promising ones first, passes over nodes whose
range of scores lies outside the wanted windows or below what is already found, and computes
the vectors of the leaves exactly, in integers.

The forest is spread over Spark: a bounded number of vectors, chosen by hash, are the tops; each vector goes to its
nearest top, and a top that attracts many (copies of one vector, a dense cluster) is dealt out over as
many trees as keep a tree near ``CELL`` vectors. Anchors visit every tree, whose root mostly
turns them away; what the trees return is merged by a window with a limit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorstream.llm.common import Scratch, for_texts

#: Vectors of a tree, on average at most; tops of the forest, which the driver holds.
CELL, TOPS = 4096, 64
#: Vectors of a leaf, and nodes that a search opens at a time.
LEAF, OPENED = 24, 16
#: Share of the squared norms that bounds in floating point give way.
SLACK = 1e-9


class CoverTree:
    """Integer vectors (rows of ``points``) with their labels, ids and places."""

    def __init__(self, points: np.ndarray, labels: np.ndarray, ids: np.ndarray, places: np.ndarray) -> None:
        wide = points.astype(np.float64)
        squares = (wide * wide).sum(axis=1)
        self.top = float(squares.max(initial=0.0))  # the squared norm of all augmented vectors
        augmented = np.column_stack([wide, np.sqrt(np.maximum(self.top - squares, 0.0))])
        order = np.arange(len(points))
        # Per node: centre, radius, its rows of ``order``, its children among the nodes.
        centre, radius, begin, end, child, children = [0], [np.inf], [0], [len(points)], [0], [0]
        node = 0
        while node < len(centre):
            rows = order[begin[node] : end[node]].copy()
            away = _distances(augmented, rows, centre[node])
            radius[node] = float(away.max(initial=0.0))
            if len(rows) > LEAF and radius[node] > 0:
                child[node] = len(centre)
                at = begin[node]
                for middle, some in _net(augmented, rows, centre[node], away, radius[node] / 2):
                    order[at : at + len(some)] = some
                    centre.append(middle)
                    radius.append(0.0)
                    begin.append(at)
                    at += len(some)
                    end.append(at)
                    child.append(0)
                    children.append(0)
                    children[node] += 1
            node += 1
        self.radius, self.begin, self.end = np.array(radius), np.array(begin), np.array(end)
        self.child, self.children = np.array(child), np.array(children)
        self.centres = wide[np.array(centre)]
        self.points, self.labels = points[order], labels[order]
        self.ids, self.places = ids[order], places[order]
        spans = [(self.labels[b:e].min(), self.labels[b:e].max()) for b, e in zip(begin, end)]
        self.least_label, self.most_label = (np.array(x) for x in zip(*spans))
        self.largest = max((abs(int(x)) for x in (points.min(initial=0), points.max(initial=0))), default=0)

    def bounds(self, nodes: np.ndarray, anchor: np.ndarray, square: float) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that a vector of each node may have with the anchor."""
        score = self.centres[nodes] @ anchor
        radius = self.radius[nodes]
        total = square + self.top
        distance = np.sqrt(np.maximum(total - 2 * score, 0.0))
        reach = np.sqrt(square) * radius
        most = np.minimum(score + reach, (total - np.maximum(distance - radius, 0.0) ** 2) / 2)
        least = np.maximum(score - reach, (total - (distance + radius) ** 2) / 2)
        return least - SLACK * total - SLACK, most + SLACK * total + SLACK

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact integer inner products."""
        bound = len(anchor) * self.largest * max((abs(int(x)) for x in (anchor.min(initial=0), anchor.max(initial=0))))
        if bound < 1 << 62:
            return self.points[rows] @ anchor
        return self.points[rows].astype(object) @ anchor.astype(object)

    def rows_of(self, nodes: np.ndarray) -> np.ndarray:
        sizes = self.end[nodes] - self.begin[nodes]
        return np.arange(sizes.sum()) + np.repeat(self.begin[nodes] - np.cumsum(sizes) + sizes, sizes)

    def below(self, nodes: np.ndarray) -> np.ndarray:
        sizes = self.children[nodes]
        return np.arange(sizes.sum()) + np.repeat(self.child[nodes] - np.cumsum(sizes) + sizes, sizes)

    def search(self, anchor: np.ndarray, goals: list[Goal]) -> None:
        """Offers the goals every vector that may be among their best."""
        wide = anchor.astype(np.float64)
        square = float(wide @ wide)
        nodes = np.zeros(1, np.int64)
        least, most = self.bounds(nodes, wide, square)
        while len(nodes):
            wanted, promise = np.zeros(len(nodes), bool), np.full(len(nodes), -np.inf)
            for goal in goals:
                may = goal.may_hold(least, most, self.least_label[nodes], self.most_label[nodes])
                wanted |= may
                promise = np.where(may, np.maximum(promise, np.minimum(most, goal.high)), promise)
            nodes, least, most = nodes[wanted], least[wanted], most[wanted]
            first = np.argsort(-promise[wanted], kind="stable")
            opened, rest = nodes[first[:OPENED]], first[OPENED:]
            inner = self.children[opened] > 0
            rows = self.rows_of(opened[~inner])
            if len(rows):
                found = self.scores(rows, anchor)
                for goal in goals:
                    goal.offer(found, self.labels[rows], self.ids[rows], self.places[rows])
            below = self.below(opened[inner])
            if len(below):
                low, high = self.bounds(below, wide, square)
                least, most = np.concatenate([least[rest], low]), np.concatenate([most[rest], high])
                nodes = np.concatenate([nodes[rest], below])
            else:
                nodes, least, most = nodes[rest], least[rest], most[rest]


def _distances(points: np.ndarray, rows: np.ndarray, centre: int) -> np.ndarray:
    away = points[rows] - points[centre]
    return np.sqrt((away * away).sum(axis=1))


def _net(
    points: np.ndarray, rows: np.ndarray, centre: int, away: np.ndarray, radius: float
) -> Iterator[tuple[int, np.ndarray]]:
    """Centres more than ``radius`` apart, the given one first, each with the rows within it."""
    while True:
        inside = away <= radius
        yield centre, rows[inside]
        rows = rows[~inside]
        if not len(rows):
            return
        # The row farthest from the centre before.
        centre = int(rows[np.argmax(away[~inside])])
        away = _distances(points, rows, centre)


class Goal:
    """The ``count`` best rows with scores in a window, of one label or of all others."""

    def __init__(self, count: int, label: int, same: bool, low: float, high: float, but: int | None = None) -> None:
        self.count, self.label, self.same, self.low, self.high, self.but = count, label, same, low, high, but
        self.best: list[tuple[int, int, int]] = []  # (-score, id, place), ascending

    def may_hold(self, least, most, least_label, most_label) -> np.ndarray:
        floor = self.low if len(self.best) < self.count else max(self.low, -self.best[-1][0])
        fits = (most >= floor) & (least <= self.high)
        if self.same:
            return fits & (least_label <= self.label) & (self.label <= most_label)
        return fits & ((least_label != self.label) | (most_label != self.label))

    def offer(self, scores, labels, ids, places) -> None:
        fits = (labels == self.label) == self.same
        fits &= (scores >= self.low) & (scores <= self.high)
        if self.but is not None:
            fits &= places != self.but
        if len(self.best) == self.count:
            fits &= scores >= -self.best[-1][0]
        if fits.any():
            some = zip((-scores[fits]).tolist(), ids[fits].tolist(), places[fits].tolist())
            self.best = sorted([*self.best, *some])[: self.count]


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows, the shorter ones filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _widened(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, max(0, width - matrix.shape[1]))))


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


#: Rows that a task reads, sorted by cell and kind: the vectors of a tree, then the anchors that search it.
ROWS = "cell long, kind int, place long, id long, label long, v array<bigint>, scores array<bigint>"
VECTOR, ANCHOR = 0, 1
FOUND = "place long, goal long, found_id long, found_place long, score long"
_MOST = (1 << 63) - 1


def _searching(goals_of: Callable) -> Callable:
    """Builds the tree of each cell and searches it; ``goals_of`` gives an anchor's goals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, parts, tree = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([_numbers(batch, "cell"), _numbers(batch, "kind")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            out: list[tuple] = []
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                rows = batch.slice(begin, end - begin)
                if keys[0, begin] != cell:
                    cell, parts, tree = keys[0, begin], [], None
                if keys[1, begin] == VECTOR:
                    parts.append(rows)
                    continue
                if tree is None and parts:
                    held = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                    tree = CoverTree(_matrix(held.column("v")), *(_numbers(held, n) for n in ("label", "id", "place")))
                    parts = []
                if tree is not None:
                    _answer(tree, rows, goals_of, out)
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in FOUND.split(", ")]
            )

    return run


def _answer(tree: CoverTree, anchors: pa.RecordBatch, goals_of, out: list[tuple]) -> None:
    vectors = _matrix(anchors.column("v"))
    width = max(vectors.shape[1], tree.points.shape[1])
    if width > tree.points.shape[1]:
        tree.points, tree.centres = _widened(tree.points, width), _widened(tree.centres, width)
    vectors = _widened(vectors, width)
    places, labels = _numbers(anchors, "place"), _numbers(anchors, "label")
    for k, known in enumerate(anchors.column("scores").to_pylist()):
        goals = goals_of(int(labels[k]), int(places[k]), known)
        tree.search(vectors[k], list(goals.values()))
        for number, goal in goals.items():
            for score, id_, place in goal.best:
                out.append((int(places[k]), number, id_, place, max(-_MOST, min(_MOST, -score))))


def _cells(vectors: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """The vectors with the number of their tree, and how many trees there are."""
    total = vectors.count()
    count = min(TOPS, -(-total // CELL)) or 1
    tops = [r.v for r in vectors.orderBy(F.xxhash64("place"), "place").select("v").limit(count).collect()]
    width = max(map(len, tops), default=0)
    held = np.array([t + [0] * (width - len(t)) for t in tops], np.float64).reshape(len(tops), width)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _matrix(batch.column("v")).astype(np.float64)
            wide = max(width, points.shape[1])
            points, middles = _widened(points, wide), _widened(held, wide)
            # |p - t|^2 without |p|^2, which is the same for every top.
            apart = (middles * middles).sum(axis=1) - 2 * points @ middles.T
            region = pa.array(np.argmin(apart, axis=1).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, region], names=[*batch.schema.names, "region"])

    schema = "place long, id long, label long, v array<bigint>, region long"
    dealt = scratch.write(vectors.select("place", "id", "label", "v").mapInArrow(nearest, schema))
    sizes = {r.region: r.n for r in dealt.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, cell = 0, F.lit(0).cast("bigint")
    for region, size in sorted(sizes.items()):
        trees = -(-size // CELL)
        salted = F.pmod(F.xxhash64("place"), F.lit(trees)) + F.lit(first)
        cell = F.when(F.col("region") == region, salted).otherwise(cell)
        first += trees
    return dealt.withColumn("cell", cell), first


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    *,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """Negatives of each anchor and positive whose scores lie in a window below the positive's.

    ``vectors`` has ``id`` (bigint), ``label`` (bigint) and ``v`` (array<bigint>), other columns are left
    aside; ``anchors`` is a condition on them. The score of a row is its integer inner product with the anchor; greater scores come
    first, then smaller ids, then one of the equal rows. An anchor's positives are its first ``positives`` other rows of the
    same label; its negatives for one of them the first ``negatives`` rows of other labels with
    low * positive's score <= 100 * score <= high * positive's score.

    Returns (anchor_id, positive_id, rank, negative_id, positive_score, negative_score). Rows with a null label,
    vector, component or id take no part. Shorter vectors count as filled with zeros; scores
    beyond 64 bits are compared in full and returned as the greatest number. A row that is there twice is two rows: each is the
    other's positive. Anchors without positives or negatives give no rows, and so does an empty table.
    """
    spark = vectors.sparkSession
    for_texts(spark)
    scratch = Scratch(spark, "negatives")
    whole = F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull())
    usable = vectors.where(F.col("id").isNotNull() & F.col("label").isNotNull() & whole)
    kept = scratch.write(
        usable.select(
            F.col("id").cast("bigint"),
            F.col("label").cast("bigint"),
            "v",
            F.coalesce(anchors, F.lit(False)).alias("asks"),
            F.monotonically_increasing_id().alias("place"),
        )
    )
    celled, trees = _cells(kept, scratch)
    if not trees:
        return spark.createDataFrame([], RESULT)
    everywhere = F.explode(F.expr(f"sequence(0L, {trees - 1}L)")).alias("cell")
    none = F.lit(None).cast("array<bigint>").alias("scores")
    columns = [c.split()[0] for c in ROWS.split(", ")]
    forest = celled.select("cell", F.lit(VECTOR).alias("kind"), "place", "id", "label", "v", none)

    def searched(asking: DataFrame, goals_of) -> DataFrame:
        asked = asking.select(everywhere, F.lit(ANCHOR).alias("kind"), "place", "id", "label", "v", "scores")
        both = forest.unionByName(asked).select(*columns)
        dealt = both.repartition("cell").sortWithinPartitions("cell", "kind", "place")
        return scratch.write(dealt.mapInArrow(_searching(goals_of), FOUND))

    def first(found: DataFrame, count: int) -> DataFrame:
        best = Window.partitionBy("place", "goal").orderBy(F.desc("score"), "found_id", "found_place")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= count)

    def same_label(label: int, place: int, _) -> dict[int, Goal]:
        return {0: Goal(positives, label, True, -np.inf, np.inf, but=place)}

    def other_labels(label: int, _, known: list[int]) -> dict[int, Goal]:
        return {s: Goal(negatives, label, False, -(-low * s // 100), high * s // 100) for s in known}

    asking = kept.where("asks")
    near = scratch.write(first(searched(asking.withColumn("scores", none), same_label), positives))
    scores = near.groupBy("place").agg(F.collect_set("score").alias("scores"))
    far = first(searched(asking.join(scores.hint("merge"), "place"), other_labels), negatives)
    pairs = near.select("place", F.col("found_id").alias("positive_id"), "score", "found_place")
    return (
        pairs.join(asking.select("place", F.col("id").alias("anchor_id")).hint("merge"), "place")
        .join(
            far.select(
                "place",
                F.col("goal").alias("score"),
                "rank",
                F.col("found_id").alias("negative_id"),
                F.col("score").alias("negative_score"),
            ).hint("merge"),
            ["place", "score"],
        )
        .select(
            "anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"
        )
    )


RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)
