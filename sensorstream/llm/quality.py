"""Document quality: logistic regression over hashed word n-grams, trained by FTRL.

Tokens are words and runs of marks. Features are the hashed uni- and bigrams of the
tokens and, so that unseen words count too, those of their shapes: letters in
lower, upper or mixed case, digits, marks (kept as they are), length class, and whether a
token repeats the one before it. A document's vector holds relative frequencies; its
score is the sparse dot product with the weights, through the logistic function. Training follows
"follow the regularised leader" with per-coordinate rates (McMahan and others,
"Ad click prediction", 2013) on a bounded sample of labelled rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sensorstream.llm.common import for_texts, fresh_name, with_arrow
from sensorstream.llm.sampling import PER_CLASS, fold, labelled_sample
from sensorstream.llm.words import TOKEN, Memo, hashed, held, numbered, sums

#: log2 of the number of weights.
WEIGHT_BITS = 18
FOLDS, HELD_OUT = 5, 0
#: Rows scored 0.3 or more are good enough to keep.
THRESHOLD = 0.3
EPOCHS = 4
#: Relative frequencies are scaled up so that one regular step size fits.
SCALE = 20.0
#: Texts whose features are held at once, in tokens.
TOKENS_AT_ONCE = 400_000
_MASK = (1 << 32) - 1


def shape(token: str) -> str:
    """What a token looks like, whatever its letters."""
    if not (token[0].isalnum() or token[0] == "_"):
        return token[:4]
    if token.isdigit():
        return "0"
    case = "x" if token.islower() else "X" if token.isupper() else "Xx" if token[0].isupper() else "xX"
    return f"{case}{min(len(token), 16) // 4}"


def _number(token: str) -> int:
    """Hash of the token in the low half, of its shape in the high half."""
    return (hashed(shape(token), 1) >> 1) << 32 | hashed(token.lower())


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left * 2654435761 + right * 40503 + 977) >> 7


def features(texts: list[str], memo: Memo) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of all texts on end, the bounds of each text's, and its tokens' number.

    A text of n tokens has 4 n features, without any for none.
    """
    numbers, bounds = numbered([TOKEN.findall(t) for t in texts], memo)
    if not len(numbers):
        return numbers, bounds, np.diff(bounds)
    words, shapes = numbers & _MASK, numbers >> 32
    starts = np.zeros(len(numbers), bool)
    starts[bounds[:-1][np.diff(bounds) > 0]] = True
    before = np.concatenate([[0], words[:-1]])
    before_shape = np.concatenate([[0], shapes[:-1]])
    before[starts], before_shape[starts] = 1, 1
    again = np.where(words == before, 12345, 0)
    stacked = np.stack(
        [words >> 3, _mix(before, words), _mix(shapes, again) + 1, _mix(before_shape, shapes) + 7], axis=1
    )
    return (stacked & ((1 << WEIGHT_BITS) - 1)).ravel(), bounds * 4, np.diff(bounds)


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        """Probability of label 1 for each text; that of no words at all for an empty one."""
        memo, out, begin = _memo(), [np.empty(0)], 0
        for end in _portions(texts):
            found, bounds, tokens = features(texts[begin:end], memo)
            dots = sums(self.weights[found], bounds) * SCALE / np.maximum(4 * tokens, 1)
            out.append(1 / (1 + np.exp(-np.clip(dots + self.bias, -35, 35))))
            begin = end
        return np.concatenate(out)


def _memo() -> Memo:
    return held("quality", lambda: Memo(_number))


def _portions(texts: list[str]) -> list[int]:
    """Ends of runs of texts of bounded length together, one text at least."""
    ends, held = [], 0
    for k, text in enumerate(texts):
        if held and held + len(text) > 4 * TOKENS_AT_ONCE:
            ends.append(k)
            held = 0
        held += len(text)
    return [*ends, len(texts)] if texts else []


def train(
    rows: list[tuple[np.ndarray, np.ndarray, int]],
    *,
    epochs: int = EPOCHS,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.5,
) -> QualityModel:
    """FTRL-proximal over (features, frequencies, label) rows.

    The classes weigh alike up to a factor of 4. Without rows of both classes the score is constant:
    the smoothed share of label 1.
    """
    size = 1 << WEIGHT_BITS
    z, n = np.zeros(size), np.zeros(size)
    good = sum(label for _, _, label in rows)
    share = (good + 1) / (len(rows) + 2)
    if not 0 < good < len(rows):
        return QualityModel(np.zeros(size, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(7)
    bias, bias_n = 0.0, 0.0
    rare = min(4.0, max(good, len(rows) - good) / min(good, len(rows) - good))
    rare_label = int(good * 2 < len(rows))
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            index, value, label = rows[k]
            zi, ni = z[index], n[index]
            w = -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2) * (np.abs(zi) > l1)
            p = 1 / (1 + np.exp(-np.clip(w @ value + bias, -35, 35)))
            error = (p - label) * (rare if label == rare_label else 1.0)
            g = error * value
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
            z[index] = zi + g - sigma * w
            n[index] = ni + g * g
            bias_n += error * error
            bias -= 0.3 * error / (1 + np.sqrt(bias_n))
    w = -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2) * (np.abs(z) > l1)
    return QualityModel(w.astype(np.float32), float(bias))


def fit(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS
) -> QualityModel:
    """Fit on labelled rows outside the held-out fold, ``per_class`` of each class at most.

    Only their features reach the driver.
    """
    for_texts(spark)
    usable = fold(F.col("doc_id"), FOLDS) != HELD_OUT
    sample = labelled_sample(docs, labels, "quality", usable, per_class)

    def count(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found, bounds, _ = features(texts, _memo())
            index, times = [], []
            for a, b in zip(bounds[:-1], bounds[1:]):
                values, counts = np.unique(found[a:b], return_counts=True)
                index.append(values.astype(np.int32))
                times.append(counts.astype(np.float32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(index, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.float32()))],
                names=["label", "index", "times"],
            )

    table = (
        sample.select("text", F.col("label").cast("int").alias("label"))
        .mapInArrow(count, "label int, index array<int>, times array<float>")
        .toArrow()
    )
    rows = []
    for label, index, times in zip(*(table.column(c).to_numpy() for c in ("label", "index", "times"))):
        total = max(float(times.sum()), 1.0)
        rows.append((index, times * (SCALE / total), int(label)))
    rows.sort(key=lambda r: (r[2], len(r[0]), r[0][:8].tolist()))  # whatever order they came in
    return train(rows)


def with_score(docs: DataFrame, model: QualityModel, name: str, text: str = "text") -> DataFrame:
    """Adds the score (double, 0 to 1). Null text counts as empty."""
    for_texts(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 1 MB, whatever the input

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
        return [pa.array(shared.value.scores([t or "" for t in texts]))]

    return with_arrow(docs, [(name, DoubleType())], compute)


def keep_good(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored ``threshold`` or more, with their own columns."""
    score = fresh_name("score")
    return with_score(docs, model, score).where(F.col(score) >= threshold).drop(score)
