"""The digest index against a plain grouping."""

import hashlib
import re

from pyspark.sql import functions as F

from sensorstream.llm import exact
from sensorstream.llm.exact import DigestIndex
from sensorstream.session import new_folder, settings


def plain(rows):
    """Per row (doc_id, keep_id, group_size, kept, digest), in the order given."""
    groups = {}
    for place, (doc, text) in enumerate(rows):
        text = text or ""
        digest = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", text).encode()).hexdigest()
        groups.setdefault(digest, []).append((-len(text), doc is None, doc or 0, place, doc))
    out = []
    for digest, members in groups.items():
        best = min(members)
        out += [(m[4], best[4], len(members), m == best, digest) for m in members]
    return out


def decided(got, names):
    columns = [F.col(names[c]) for c in ("keep_id", "group_size", "kept")]
    return [tuple(r) for r in got.select("doc_id", *columns, F.lower(F.hex(names["digest"]))).collect()]


def key(row):
    return tuple((x is None, x) for x in row)


def test_one_batch_of_odd_documents(spark, documents, odd_rows):
    docs = documents(odd_rows)
    index = DigestIndex(spark, new_folder(spark, "index"), buckets=4)
    got, names = index.add(docs)
    assert got.columns[: len(docs.columns)] == docs.columns
    assert sorted(decided(got, names), key=key) == sorted(plain(odd_rows), key=key)
    index.close()


def test_hot_and_cold_groups_agree(spark, documents, monkeypatch):
    rows = [(k, "same text" if k % 3 else f"text {k // 6}") for k in range(300)]
    for share in (0.0, 0.001, 1.0):
        monkeypatch.setattr(exact, "HOT_SHARE", share)
        index = DigestIndex(spark, new_folder(spark, "index"), buckets=4)
        assert sorted(decided(*index.add(documents(rows)))) == sorted(plain(rows))


def test_later_batches_meet_the_index(spark, documents):
    path = new_folder(spark, "index")
    first = DigestIndex(spark, path, buckets=4)
    rows = [(1, "a b"), (2, "ab"), (3, "c")]
    once = sorted(decided(*first.add(documents(rows))))
    first.close()
    again = DigestIndex(spark, path, buckets=9)  # as after a restart, under other settings
    assert again.buckets == 4
    assert sorted(decided(*again.add(documents(rows)))) == once  # a batch that runs again decides alike
    later = decided(*again.add(documents([(4, "a  b  "), (5, "d"), (6, "c")])))
    assert sorted(r[:4] for r in later) == [(4, 1, 1, False), (5, 5, 1, True), (6, 3, 1, False)]
    stored = again.read()
    assert stored.count() == 3 and stored.select("digest").distinct().count() == 3


def test_buckets_grow_with_the_texts_expected(spark, documents):
    cores = spark.sparkContext.defaultParallelism
    few = min(2 * cores, int(spark.conf.get("spark.sql.shuffle.partitions")))
    assert exact.buckets_for(spark, 0) == exact.buckets_for(spark, 1000) == few
    assert exact.buckets_for(spark, 30_000_000_000) == 30_000
    index = DigestIndex(spark, new_folder(spark, "index"), expected=2)
    rows = [(1, "a"), (2, "a "), (3, None)]
    assert index.buckets == few and sorted(decided(*index.add(documents(rows)))) == sorted(plain(rows))


def files_of(index):
    """Data files of each run."""
    return {run: len(index._table(run).inputFiles()) for run in index.runs}


def test_batches_meet_sorted_runs_without_a_sort(spark, documents):
    index = DigestIndex(spark, new_folder(spark, "index"), buckets=4)
    for k in range(3):
        index.add(documents([(100 * k + i, f"text {k} {i}") for i in range(60)]))
    assert list(files_of(index).values()) == [4, 4, 4]  # one file per bucket, whatever came before
    with settings(spark, exact.IN_ORDER):
        path = new_folder(spark, "batch")
        rows = spark.range(9).select(
            F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("digest"),
            F.lit(1).cast("bigint").alias("keep_id"),
            F.lit(1).cast("bigint").alias("n_chars"),
        )
        batch = index._lay_out(rows.repartition(4, "digest"), path, exact.INDEX, path)
        plan = index._unknown(batch)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 3
        assert "Sort [" not in plan and "Exchange" not in plan
    index.close()


def test_runs_of_like_size_are_merged(spark, documents):
    path = new_folder(spark, "index")
    index = DigestIndex(spark, path, buckets=3)
    for k in range(9):
        index.add(documents([(10 * k + i, f"text {k} {i}") for i in range(8)]))
        assert len(index.runs) < exact.RUNS + 2 and sum(index.runs.values()) == 8 * (k + 1)
    assert max(index.runs.values()) >= 32 and max(files_of(index).values()) <= 3
    index.close()
    again = DigestIndex(spark, path)  # finds the manifest and only what it names
    assert again.runs == index.runs and again.read().count() == 72
    got = decided(*again.add(documents([(900, "text 3 4"), (901, "new")])))
    assert sorted(r[:2] for r in got) == [(900, 34), (901, 901)]
    assert again.read().groupBy("digest").count().where("count > 1").isEmpty()


def test_a_crash_before_the_switch_leaves_the_index_as_it_was(spark, documents, monkeypatch):
    path = new_folder(spark, "index")
    index = DigestIndex(spark, path, buckets=2)
    index.add(documents([(1, "a")]))
    monkeypatch.setattr(DigestIndex, "_switch", lambda self, runs: 1 / 0)
    try:
        index.add(documents([(2, "b")]))
        raise AssertionError("the switch was not reached")
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    again = DigestIndex(spark, path)
    assert again.read().count() == 1
    assert sorted(r[:2] for r in decided(*again.add(documents([(3, "b"), (4, "a")])))) == [(3, 3), (4, 1)]


def test_carried_columns(spark, documents):
    index = DigestIndex(spark, new_folder(spark, "index"), buckets=2)
    got, names = index.add(documents([(1, "a b"), (2, "ab")]), carry=["doc_id", "kept"])
    assert got.columns == ["doc_id", "kept", names["digest"], names["keep_id"], names["group_size"], names["kept"]]
    assert sorted(r[:2] for r in decided(got, names)) == [(1, 1), (2, 1)]


def test_empty_batch(spark, documents):
    index = DigestIndex(spark, new_folder(spark, "index"), buckets=4)
    got, _ = index.add(documents([]))
    assert got.count() == 0 and index.read().count() == 0
