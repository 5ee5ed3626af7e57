"""Connected components of links, by large and small stars.

Each round replaces the links by stars around smaller and smaller nodes (Kiveris
and others, "Connected components in MapReduce and beyond"). The least neighbour of a
node is found with partial aggregation and written; the join back then has two plain
exchanges, of which Spark splits the partitions that one hub makes large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.llm.common import Scratch


def components(spark: SparkSession, links: DataFrame, most: int | None = None) -> DataFrame:
    """(node, root) for every node that ``links`` (a, b: bigint) name; root: the least reachable.

    Links may repeat, run either way or join a node with itself; null ends are ignored.
    No links give no rows. ``most``: about how many links there are at most, if that is known. Tables are written in as
    many files as their links need; a round at most doubles them.
    """
    scratch = Scratch(spark, "components")
    high, low = F.greatest("a", "b"), F.least("a", "b")
    now = scratch.write(
        links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(high.alias("a"), low.alias("b"))
        .distinct(),
        most,
    )
    seen = _digest(now)
    while seen[0]:
        rows = 2 * seen[0]
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.write(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), rows)
        large = scratch.write(
            both.join(least.hint("merge"), "a")
            .where((F.col("b") > F.col("a")) & (F.col("b") != F.col("m")))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct(),
            rows,
        )
        scratch.drop(now, least)
        least = scratch.write(large.groupBy("a").agg(F.min("b").alias("m")), rows)
        others = large.join(least.hint("merge"), "a").where(F.col("b") != F.col("m"))
        now = scratch.write(
            others.select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .distinct(),
            rows,
        )
        scratch.drop(large, least)
        before, seen = seen, _digest(now)
        if before == seen:
            break
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)


def _digest(links: DataFrame) -> tuple[int, int]:
    """Equal for equal sets of links."""
    mixed = F.xxhash64("a", "b")
    row = links.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(mixed), F.lit(0))).first()
    return row[0], row[1]
