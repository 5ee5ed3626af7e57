"""A training corpus from raw documents, in stages.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again
as the next one's documents. All but the last return the columns of the documents. The
classifiers are fitted on the labels of ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.llm import quality, toxicity
from sensorstream.llm.common import Scratch, files_for
from sensorstream.llm.entries import packed, table
from sensorstream.llm.exact import DigestIndex, buckets_for
from sensorstream.llm.simhash import near_duplicates
from sensorstream.session import new_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.fit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.fit(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each distinct text."""
    many = docs.count()
    buckets = min(buckets_for(spark, many), files_for(many))
    index = DigestIndex(spark, new_folder(spark, "digest-index"), buckets)
    decided, names = index.add(docs)
    index.close()
    return _no_wider(decided.where(F.col(names["kept"])), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by SimHash."""
    grouped, names = near_duplicates(docs, size=3, radius=2)
    return _no_wider(grouped.where(F.col(names["kept"])), docs)


def _no_wider(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the documents, in no more partitions, and so files, than these came in."""
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns)).coalesce(max(docs.rdd.getNumPartitions(), 1))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens along the curve, as pieces of documents."""
    return packed(docs, most_ranges=docs.rdd.getNumPartitions())


STAGES = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("packing", pack),
]

# Trained models and fingerprints have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
