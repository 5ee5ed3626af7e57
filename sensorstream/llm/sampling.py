"""Bounded samples of labelled documents, for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each class that a classifier is fitted on, at most.
PER_CLASS = 4000


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``: what the held-out rows are chosen by."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int = PER_CLASS
) -> DataFrame:
    """(text, label) of up to ``per_class`` labelled documents of each class.

    ``usable`` is a condition on ``doc_id`` of the labels. Which rows are taken follows
    a hash of their id, so it does not depend on order or partitions. The chosen ids, at
    most twice ``per_class`` rows, are broadcast to the documents. Of documents that share an id,
    the one with the least hash of its text counts.
    """
    labels = labels.where(usable & F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("label"))
    spread = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = [
        labels.where(F.col("label") == k).distinct().orderBy(spread, "doc_id").limit(per_class)
        for k in (0, 1)
    ]
    joined = docs.select("doc_id", "text").join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
    least = F.min(F.struct(F.xxhash64("text").alias("spread"), "text"))
    return joined.groupBy("doc_id", "label").agg(least.alias("least")).select("doc_id", "least.text", "label")
