"""Compaction of stored collections."""

import os

import pytest
from pyspark.sql import functions as F

from sensorstream.plans.archive import documents
from sensorstream.sources import compaction
from sensorstream.sources.collections import FOLDERS, create_folders, find
from sensorstream.sources.compaction import compact, documents_of, snapshot_of, vacuum
from sensorstream.streaming.sinks import batch_store
from test_streaming import text


def data_files(path):
    return [f for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


@pytest.fixture
def fill(spark):
    def write(store, batches, rows=6):
        store_batch = batch_store(store, FOLDERS)
        for b in batches:
            # Two days, and a message without a time.
            texts = [text(b % 4, (k % 2) * 86_400 + b, 50 + k) for k in range(rows - 1)] + ['{"id":1}']
            frame = spark.createDataFrame([("1", t, b, k) for k, t in enumerate(texts)], "key string, value string, b int, k int")
            sent = frame.select(
                "key", "value", F.lit("temperature-topic").alias("topic"), F.col("b").alias("partition"),
                F.col("k").cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp"),
            )
            store_batch(documents(sent), b)

    return write


def content(frame):
    return sorted((r.partition, r.offset, r.raw) for r in frame.collect())


def test_find_is_the_same_before_and_after(spark, folder, fill):
    store = folder("store")
    create_folders(spark, store)
    assert compact(spark, store, "temperature").version == 0  # nothing to do yet
    fill(store, range(12))
    before = content(find(spark, store, "temperature"))
    held = documents_of(spark, store, "temperature")  # a reader that has begun
    done = compact(spark, store, "temperature")
    assert (done.version, done.through, len(done.segments)) == (1, 10, 1)
    assert content(find(spark, store, "temperature")) == content(held) == before and len(before) == 72
    segment = f"{store}/_segments/temperature/{next(iter(done.segments))}"
    assert len(data_files(segment)) == 3  # one file for each day, and one for no day
    fill(store, range(12, 15))
    assert len(find(spark, store, "temperature").collect()) == 90
    day = find(spark, store, "temperature", F.col("day") == "2010-01-02")
    assert day.count() == 45 and "PartitionFilters: [isnotnull(day" in day._jdf.queryExecution().toString()
    # A batch that is replayed after its compaction changes nothing.
    fill(store, [10, 14])
    assert len(find(spark, store, "temperature").collect()) == 90


def test_segments_are_merged_and_swept(spark, folder, fill):
    store = folder("store")
    create_folders(spark, store)
    at = None
    for k in range(6):
        fill(store, range(3 * k, 3 * k + 3))
        older, at = at, compact(spark, store, "temperature")
        if older:
            # The snapshot before can still be read.
            assert documents_of(spark, store, "temperature", older).count() == 18 * (k + 1)
    assert len(at.segments) < 6 and any("merged" in s for s in at.segments)
    rows = content(find(spark, store, "temperature"))
    assert len(rows) == len(set(rows)) == 108
    vacuum(spark, store, "temperature")
    assert content(find(spark, store, "temperature")) == rows
    assert snapshot_of(spark, store, "temperature") == at
    left = [n for n in os.listdir(f"{store}/_segments/temperature") if n.startswith("segment")]
    assert sorted(left) == sorted(at.segments)


def test_files_are_of_the_wanted_size(spark, folder, fill):
    store = folder("store")
    create_folders(spark, store)
    fill(store, range(3), rows=4000)
    whole = sum(n for (_, b), n in compaction._batch_sizes(spark, store, "temperature").items() if b < 2)
    done = compact(spark, store, "temperature", file_bytes=whole // 8)
    sizes = [
        os.path.getsize(os.path.join(d, f))
        for d, _, fs in os.walk(f"{store}/_segments/temperature/{next(iter(done.segments))}")
        for f in fs
        if f.endswith(".parquet")
    ]
    assert 6 <= len(sizes) <= 14 and max(sizes) < whole // 4
    assert find(spark, store, "temperature").count() == 12_000


def test_an_unfinished_manifest_does_not_count(spark, folder, fill):
    store = folder("store")
    create_folders(spark, store)
    fill(store, range(4))
    done = compact(spark, store, "temperature")
    os.makedirs(f"{store}/_segments/temperature/manifest/2")
    assert snapshot_of(spark, store, "temperature") == done
    assert find(spark, store, "temperature").count() == 24
