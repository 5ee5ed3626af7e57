"""Exact duplicates against a persistent index of digests.

The index is a list of runs. A run is a table of one row per distinct text, in one file per bucket of
digests, each sorted by digest: Spark reads it bucketed and in order, with neither an exchange nor a sort. A batch is
reduced to one row per digest before its only shuffle, so a text that a third of all rows share costs a row per
task, and written as such a table too. Sort-merge anti-joins with one run after the other leave the digests that the index
does not have; these become a new run. Runs of like size are merged when there are ``RUNS`` of them, so a
row is rewritten only a logarithmic number of times, however small the batches. A manifest names the runs
that count; it changes in one step. A batch that is run again after a crash finds its own digests, naming the same
rows, and decides as before.

Only DataFrame functions are used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorstream.llm.common import SPACE, Scratch, fresh_name, text_of
from sensorstream.session import settings

#: A digest with more than this share of a batch is hot; so there are at most 1,000.
HOT_SHARE = 0.001
INDEX = "digest binary, keep_id bigint, n_chars bigint"
BATCH = "digest binary, best struct<less: bigint, none: boolean, id: bigint, at: bigint>, n bigint"
MANIFEST = "run string, n bigint"
#: Runs of like size that are merged into one.
RUNS = 4
#: A scan of one sorted file per bucket says that it is sorted, and is by bucket whatever follows.
IN_ORDER = {
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
}
#: Texts of one bucket, some 50 MB of digests.
BUCKET_TEXTS = 1_000_000


def buckets_for(spark: SparkSession, expected: int) -> int:
    """Buckets of ``BUCKET_TEXTS`` texts each, but two tasks for every core at least.

    A small index needs no more files than the session has shuffle partitions.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(min(partitions, 2 * spark.sparkContext.defaultParallelism), -(-expected // BUCKET_TEXTS), 1)


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACE, "")


class DigestIndex:
    """The texts seen so far, by the SHA-256 of their text without white space.

    ``path`` is a folder on shared storage. Opening it again, in this session or
    another, continues the index; one writes at a time. A new one has ``buckets``, or as many as suit the ``expected``
    number of texts that it will come to hold; without either, as many as the session has
    shuffle partitions. The number stays with the index.
    """

    def __init__(
        self, spark: SparkSession, path: str, buckets: int | None = None, *, expected: int | None = None
    ) -> None:
        self.spark = spark
        self.path = path
        if buckets is None and expected is not None:
            buckets = buckets_for(spark, expected)
        self.buckets = self._layout(buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
        self.tables: dict[str, str] = {}
        self.fresh = False  # whether the last batch has brought a run
        self.generation, self.runs = self._manifest()

    def _files(self, path: str):
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder, folder.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _written(self, path: str) -> bool:
        folder, files = self._files(f"{path}/_SUCCESS")
        return files.exists(folder)

    def _layout(self, buckets: int) -> int:
        """Number of buckets of the index at the path, written when it is new."""
        layout = f"{self.path}/_layout"  # Spark passes over names with an underscore
        if not self._written(layout):
            made = self.spark.createDataFrame([(buckets,)], "buckets int")
            made.coalesce(1).write.mode("overwrite").parquet(layout)
        return self.spark.read.schema("buckets int").parquet(layout).first()[0]

    def _manifest(self) -> tuple[int, dict[str, int]]:
        """The newest whole generation: its number, and the rows of its runs by name."""
        folder, files = self._files(f"{self.path}/_manifest")
        if not files.exists(folder):
            return 0, {}
        names = sorted((int(f.getPath().getName()) for f in files.listStatus(folder)), reverse=True)
        newest = next((n for n in names if self._written(f"{self.path}/_manifest/{n}")), 0)
        if not newest:
            return 0, {}
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/_manifest/{newest}").collect()
        return newest, {r.run: r.n for r in rows}

    def _switch(self, runs: dict[str, int]) -> None:
        """Makes these runs the ones that count, and deletes those that no longer do."""
        made = self.spark.createDataFrame(list(runs.items()), MANIFEST)
        made.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_manifest/{self.generation + 1}")
        gone = [name for name in self.runs if name not in runs]
        self.generation, self.runs = self.generation + 1, runs
        for name in gone:
            self._forget(name)
            folder, files = self._files(f"{self.path}/{name}")
            files.delete(folder, True)

    def _table(self, name: str, columns: str = INDEX, path: str | None = None) -> DataFrame:
        """A run, or a batch laid out like one, as a bucketed table."""
        if name not in self.tables:
            self.tables[name] = f"digests_{uuid.uuid4().hex[:12]}"
            self.spark.sql(
                f"CREATE TABLE {self.tables[name]} ({columns}) USING parquet "
                f"OPTIONS (path '{path or f'{self.path}/{name}'}') "
                f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS"
            )
        return self.spark.table(self.tables[name])

    def _forget(self, name: str) -> None:
        if name in self.tables:
            self.spark.sql(f"DROP TABLE {self.tables.pop(name)}")

    def _lay_out(self, rows: DataFrame, name: str, columns: str = INDEX, path: str | None = None) -> DataFrame:
        """Writes rows that lie in a task per bucket as one sorted file per bucket."""
        self._table(name, columns, path)
        (
            rows.write.mode("append")
            .format("parquet")
            .option("path", path or f"{self.path}/{name}")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.tables[name])
        )
        return self._table(name)

    def read(self) -> DataFrame:
        """All rows of the index."""
        out = self.spark.createDataFrame([], INDEX)
        for name in self.runs:
            out = out.unionAll(self._table(name))
        return out

    def close(self) -> None:
        """Forget the tables' names; the files stay."""
        for name in list(self.tables):
            self._forget(name)

    def add(
        self, docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", carry: list[str] | None = None
    ) -> tuple[DataFrame, dict[str, str]]:
        """Deduplicate a batch against the index and itself, and append what is new.

        Returns ``docs`` (or its columns ``carry``) with new columns, whose names are the second value: ``digest``,
        ``keep_id`` (id of the row that stays for this text, from an earlier batch if it had
        the text), ``group_size`` (rows of this batch with the text) and ``kept``. Of equal
        texts in a batch the longest original stays, then the least id (null last), then
        one of the equal rows. Null text counts as empty. Very long texts are hashed whole. An empty table gives an
        empty one.
        """
        names = {k: fresh_name(k) for k in ("digest", "keep_id", "group_size", "kept")}
        digest, place, size = names["digest"], fresh_name("place"), fresh_name("n_chars")
        scratch = Scratch(self.spark, "exact")
        columns = docs.columns if carry is None else carry
        ids = fresh_name("id")
        hashed = scratch.write(
            docs.select(
                *(F.col(f"`{c}`") for c in columns),
                F.col(id_column).cast("bigint").alias(ids),
                F.unhex(F.sha2(normalised(text_of(text)).cast("binary"), 256)).alias(digest),
                F.length(text_of(text)).cast("bigint").alias(size),
                F.monotonically_increasing_id().alias(place),
            )
        )
        order = F.struct(
            (-F.col(size)).alias("less"),
            F.col(ids).isNull().alias("none"),
            F.col(ids).alias("id"),
            F.col(place).alias("at"),
        )
        best = F.min(order).alias("best")
        grouped = hashed.groupBy(F.col(digest).alias("digest")).agg(best, F.count(F.lit(1)).alias("n"))
        with settings(self.spark, IN_ORDER):
            path = scratch.path()
            # Dealt to more tasks than asked for, each would write a file of every bucket.
            dealt = grouped.repartition(self.buckets, "digest").coalesce(self.buckets)
            batch = self._lay_out(dealt, path, BATCH, path)
            known = [
                batch.join(self._table(run).select("digest", "keep_id").hint("merge"), "digest") for run in self.runs
            ]
            new = self._unknown(batch)
            self._append(new.select("digest", F.col("best.id").alias("keep_id"), (-F.col("best.less")).alias("n_chars")))
            # What the newest run holds of the batch is what the batch has brought.
            own = self._table(list(self.runs)[-1]) if self.fresh else None
            if own is not None:
                known.append(batch.join(own.select("digest", "keep_id").hint("merge"), "digest"))
            decided = known[0] if known else batch.withColumn("keep_id", F.lit(None).cast("bigint"))
            for more in known[1:]:
                decided = decided.unionAll(more)
            decided = scratch.write(decided)
            self._forget(path)
        # Read without their buckets, as a union of bucketed tables would be written file by file.
        with settings(self.spark, {"spark.sql.sources.bucketing.enabled": "false"}):
            self._merge()
        return self._decide(hashed, decided, names, place, columns), names

    def _unknown(self, batch: DataFrame) -> DataFrame:
        """The rows of a laid-out batch whose digest no run has; nothing is moved or sorted for it."""
        for run in self.runs:
            batch = batch.join(self._table(run).hint("merge"), "digest", "left_anti")
        return batch

    def _append(self, new: DataFrame) -> None:
        """A run of the new digests, if there are any. They lie by bucket already."""
        name = f"run-{uuid.uuid4().hex[:12]}"
        self._lay_out(new, name)
        count = self._table(name).count()
        self.fresh = count > 0
        if self.fresh:
            self._switch({**self.runs, name: count})
        else:
            self._forget(name)

    def _merge(self) -> None:
        """Merge runs of like size where there are ``RUNS`` of them."""
        levels: dict[int, list[str]] = {}
        for name, n in self.runs.items():
            levels.setdefault(n.bit_length() // RUNS.bit_length(), []).append(name)
        for same in levels.values():
            if len(same) >= RUNS:
                rows = self._table(same[0])
                for name in same[1:]:
                    rows = rows.unionAll(self._table(name))
                name = f"run-{uuid.uuid4().hex[:12]}"
                self._lay_out(rows.repartition(self.buckets, "digest"), name)
                left = {k: n for k, n in self.runs.items() if k not in same}
                self._switch({name: sum(self.runs[k] for k in same), **left})

    def _decide(self, hashed, decided, names, place, columns) -> DataFrame:
        digest, best, n = names["digest"], fresh_name("best"), fresh_name("n")
        total = decided.agg(F.sum("n")).first()[0] or 0
        is_hot = F.col(n) > max(1.0, HOT_SHARE * total)
        decided = decided.select(
            F.col("digest").alias(digest),
            F.col("best").alias(best),
            F.col("n").alias(n),
            F.col("keep_id").alias(names["keep_id"]),
        )
        hot, cold = decided.where(is_hot), decided.where(~is_hot)
        # At most 1,000 rows are broadcast; their texts' rows need no shuffle at all.
        hot_rows = hashed.join(F.broadcast(hot), digest)
        cold_rows = hashed.join(F.broadcast(hot.select(digest)), digest, "left_anti").join(
            cold.hint("merge"), digest
        )
        stays = F.col(names["keep_id"]).eqNullSafe(F.col(best)["id"]) & (F.col(best)["at"] == F.col(place))
        out = [
            *(F.col(f"`{c}`") for c in columns),
            F.col(digest),
            F.col(names["keep_id"]),
            F.col(n).alias(names["group_size"]),
            stays.alias(names["kept"]),
        ]
        return hot_rows.select(*out).unionAll(cold_rows.select(*out))
