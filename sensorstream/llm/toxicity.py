"""Toxicity: a factorization machine over hashed terms.

Terms of a document are its distinct words in lower case and their beginnings of 4 to 6
letters, which inflected words share. The score is a logistic function of a bias, a weight
per term, and the product of two term vectors for each pair of terms (Rendle,
"Factorization machines", 2010); the pairs say what neither term says alone, such as an insult
beside the mention of a group. All pairs together cost one pass: half of the squared sum
of the vectors less the sum of their squares. Terms that the labelled sample does not tie
to either class, by themselves or in a pair with another term, weigh nothing, so a long clean text does not add up
to a toxic one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sensorstream.llm.common import for_texts, fresh_name, with_arrow
from sensorstream.llm.sampling import PER_CLASS, fold, labelled_sample
from sensorstream.llm.words import Memo, hashed, held

WORD = re.compile(r"\w+")
#: Terms are hashed to so many bits.
TERM_BITS = 20
PREFIXES = (4, 5, 6)
#: Length of a term's vector.
RANK = 4
#: Terms that take part in the model, at most (parameter ``most_terms``); the others weigh nothing.
MODEL_TERMS = 4096
#: A term takes part if it depends on the class with a G-test statistic of so much at least;
#: by chance, one in some ten thousand terms does.
LEAST_G = 15.0
#: So do both terms of a pair that says by so much more than its terms do, each by itself, whether it is there. There are
#: some two million pairs, of which one in ten thousand million reaches this by chance. Pairs are looked at
#: among so many terms, the most frequent ones in ``LEAST_TEXTS`` texts or more.
LEAST_PAIR_G, PAIR_TERMS, LEAST_TEXTS = 45.0, 2048, 16
#: Texts, or rows of the table of pairs, in memory at once.
AT_ONCE = 256
#: Passes over the sample. In the first half each term of a text is left out with this chance, so that terms
#: that come in numbers learn to speak in fewer; the second half settles on whole texts.
EPOCHS, LEFT_OUT = 24, 0.5
FOLDS, HELD_OUT = 3, 1
#: Rows scored 0.7 or more are toxic.
THRESHOLD = 0.7


def terms_of(word: str) -> list[int]:
    """Hashed terms of one word in lower case."""
    found = [hashed(word)]
    found += [hashed(word[:k], k) for k in PREFIXES if len(word) > k]
    return [f & ((1 << TERM_BITS) - 1) for f in found]


def terms(text: str) -> set[int]:
    """Distinct hashed terms of a text."""
    return {t for word in set(WORD.findall(text.lower())) for t in terms_of(word)}


@dataclass(frozen=True)
class ToxicityModel:
    chosen: dict[int, int]  # term -> row of the weights
    weights: np.ndarray
    vectors: np.ndarray
    bias: float

    def margin(self, rows: list[int]) -> float:
        """Log-odds of label 1 for a text with the terms of these rows."""
        v = self.vectors[rows]
        pairs = 0.5 * ((v.sum(axis=0) ** 2).sum() - (v * v).sum())
        return float(self.bias + self.weights[rows].sum() + pairs)

    def score(self, text: str, memo: Memo) -> float:
        """Probability of label 1; that of no known term for an empty text."""
        rows = {r for found in set(map(memo.__getitem__, set(WORD.findall(text.lower())))) for r in found}
        margin = self.margin(sorted(rows)) if rows else self.bias
        return float(1 / (1 + np.exp(-np.clip(margin, -35, 35))))

    def rows_of(self, word: str) -> tuple[int, ...]:
        return tuple(self.chosen[t] for t in terms_of(word) if t in self.chosen)


def g_statistic(toxic: np.ndarray, clean: np.ndarray, many_toxic: float, many_clean: float) -> np.ndarray:
    """How far counts of texts in the two classes depend on the class, by the G-test."""
    statistic = np.zeros(np.shape(toxic))
    for seen, many in ((toxic, many_toxic), (clean, many_clean)):
        expected = (toxic + clean) * (many / (many_toxic + many_clean))
        for observed, awaited in ((seen, expected), (many - seen, many - expected)):
            statistic += 2 * observed * np.log(np.maximum(observed, 1e-9) / np.maximum(awaited, 1e-9))
    return statistic


def _meetings(texts: list[np.ndarray], frequent: np.ndarray) -> np.ndarray:
    """In how many of the texts any two of the terms meet; whole numbers, exact as floats."""
    place = np.full(1 << TERM_BITS, -1, np.int32)
    place[frequent] = np.arange(len(frequent))
    met = np.zeros((len(frequent), len(frequent)), np.float32)
    for begin in range(0, len(texts), AT_ONCE):
        held = np.zeros((len(texts[begin : begin + AT_ONCE]), len(frequent)), np.float32)
        for row, found in zip(held, texts[begin:]):
            there = place[found]
            row[there[there >= 0]] = 1
        met += held.T @ held
    return met


def choose_terms(index: list[np.ndarray], labels: np.ndarray, most: int = MODEL_TERMS) -> np.ndarray:
    """Terms that depend on the class by themselves or in pairs, the strongest first."""
    toxic, clean = np.zeros((2, 1 << TERM_BITS), np.int32)
    for found, label in zip(index, labels):
        (toxic if label else clean)[found] += 1
    known = np.flatnonzero(toxic + clean)
    toxic, clean = toxic[known].astype(float), clean[known].astype(float)
    many_toxic, many_clean = max(labels.sum(), 1), max((1 - labels).sum(), 1)
    statistic = g_statistic(toxic, clean, many_toxic, many_clean)
    # Pairs: in how many texts of either class two terms meet, as products of tables of texts by terms.
    frequent = np.argsort(-(toxic + clean), kind="stable")[:PAIR_TERMS]
    frequent = frequent[(toxic + clean)[frequent] >= LEAST_TEXTS]
    own = statistic[frequent]
    met = [_meetings([f for f, label in zip(index, labels) if label == wanted], known[frequent]) for wanted in (1, 0)]
    best = np.zeros(len(known))
    # A few rows of the table of pairs at a time: the statistic needs several tables of its size.
    for begin in range(0, len(frequent), AT_ONCE):
        rows = np.arange(begin, min(begin + AT_ONCE, len(frequent)))
        both = [m[rows].astype(np.float64) for m in met]
        pairs = g_statistic(*both, many_toxic, many_clean) - own[rows][:, None] - own
        pairs[rows - begin, rows] = 0
        best[frequent[rows]] = pairs.max(axis=1, initial=0)
    strength = np.where(statistic >= LEAST_G, statistic, 0) + np.where(best >= LEAST_PAIR_G, best, 0)
    order = np.argsort(-strength, kind="stable")[:most]
    return known[order[strength[order] > 0]]


def train(
    index: list[np.ndarray],
    labels: np.ndarray,
    *,
    epochs: int = EPOCHS,
    rate: float = 0.15,
    l2: float = 1e-4,
    most_terms: int = MODEL_TERMS,
) -> ToxicityModel:
    """Fit by AdaGrad on rows of terms and labels (0 or 1); the rarer class weighs up to 4 times.

    Without rows of both classes the score is constant: the smoothed share of label 1.
    """
    share = (labels.sum() + 1) / (len(labels) + 2)
    bias = float(np.log(share / (1 - share)))
    chosen = choose_terms(index, labels, most_terms) if 0 < labels.sum() < len(labels) else np.empty(0, int)
    place = {int(t): k for k, t in enumerate(chosen)}
    rng = np.random.default_rng(11)
    many, few = max(labels.sum(), (1 - labels).sum()), min(labels.sum(), (1 - labels).sum())
    heavy = (labels == (2 * labels.sum() < len(labels))) * (min(4.0, many / max(few, 1)) - 1.0) + 1.0
    w, v = np.zeros(len(chosen)), rng.normal(0, 0.05, (len(chosen), RANK))
    gw, gv, gb = np.full(len(chosen), 1e-2), np.full(v.shape, 1e-2), 1e-2
    rows = [np.array([place[t] for t in found.tolist() if t in place], int) for found in index]
    for epoch in range(epochs if len(chosen) else 0):
        for k in rng.permutation(len(rows)):
            r, label = rows[k], labels[k]
            if 2 * epoch < epochs and len(r):
                r = r[rng.random(len(r)) >= LEFT_OUT]
                if not len(r):
                    continue
            vr = v[r]
            total = vr.sum(axis=0)
            margin = bias + w[r].sum() + 0.5 * ((total**2).sum() - (vr * vr).sum())
            error = (1 / (1 + np.exp(-np.clip(margin, -35, 35))) - label) * heavy[k]
            gb += error * error
            bias -= rate * error / np.sqrt(gb)
            if len(r):
                step = error + l2 * w[r]
                gw[r] += step * step
                w[r] -= rate * step / np.sqrt(gw[r])
                step = error * (total - vr) + l2 * vr
                gv[r] += step * step
                v[r] = vr - 0.2 * rate * step / np.sqrt(gv[r])
    return ToxicityModel(place, w.astype(np.float32), v.astype(np.float32), bias)


def fit(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    *,
    per_class: int = PER_CLASS,
    most_terms: int = MODEL_TERMS,
) -> ToxicityModel:
    """Fit on labelled rows outside the held-out fold, ``per_class`` of each class at most.

    Only their hashed terms reach the driver.
    """
    for_texts(spark)
    usable = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    sample = labelled_sample(docs, labels, "toxic", usable, per_class)

    def count(batches):
        for batch in batches:
            found = [sorted(terms(t or "")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(found, pa.list_(pa.int32()))], names=["label", "terms"]
            )

    table = (
        sample.select("text", F.col("label").cast("int").alias("label"))
        .mapInArrow(count, "label int, terms array<int>")
        .toArrow()
    )
    rows = sorted(
        zip(table.column("label").to_pylist(), table.column("terms").to_numpy()),
        key=lambda r: (r[0], len(r[1]), r[1][:8].tolist()),
    )  # whatever order they came in
    return train([found for _, found in rows], np.array([label for label, _ in rows], int), most_terms=most_terms)


def with_score(docs: DataFrame, model: ToxicityModel, name: str, text: str = "text") -> DataFrame:
    """Adds the score (double, 0 to 1) as the column ``name``, which must be new.

    Null text counts as empty, and texts without a known term share one score. Whole texts are read, however long; equal
    texts score alike. An empty table gives an empty one.
    """
    if name in docs.columns:
        raise ValueError(f"there is a column {name} already")
    for_texts(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by most_terms

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        model = shared.value
        memo = _memo_for(model)
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        return [pa.array([model.score(t or "", memo) for t in texts], pa.float64())]

    return with_arrow(docs, [(name, DoubleType())], compute)


def _memo_for(model: ToxicityModel) -> Memo:
    """The worker's memo for this model, which its memo keeps alive; that of the model before goes."""
    return held(("toxicity", id(model)), lambda: Memo(model.rows_of))


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below ``threshold``, with their own columns."""
    score = fresh_name("score")
    return with_score(docs, model, score).where(F.col(score) < threshold).drop(score)
