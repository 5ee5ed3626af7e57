"""Files that roll by bytes."""

import glob
import os
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sensorstream.session import settings
from sensorstream.sources.rolling import read_rolled, write_rolled


def files(path):
    found = sorted(glob.glob(f"{path}/file=*/part-*"), key=lambda f: int(f.split("file=")[1].split("/")[0]))
    return [open(f, "rb").read() for f in found]


def rolled(spark, folder, rows, limit, parts=5):
    frame = spark.createDataFrame(rows, "k int, value string").repartition(parts)
    path = folder("rolled")
    write_rolled(frame, path, F.col("value"), ["k"], file_bytes=limit)
    return path


def test_all_rows_in_order_in_files_of_the_size(spark, folder):
    rng = random.Random(5)
    rows = [(k, "é" * rng.randrange(20) + str(k)) for k in range(3000)]
    path = rolled(spark, folder, rng.sample(rows, len(rows)), 4_000)
    wanted = "".join(t + "\n" for _, t in rows).encode()
    got = files(path)
    assert b"".join(got) == wanted
    assert len(got) == -(-len(wanted) // 4_000)
    assert all(abs(len(f) - 4_000) <= 50 for f in got[:-1]) and len(got[-1]) <= 4_050
    assert read_rolled(spark, path).count() == 3000


def test_ties_and_nulls(spark, folder):
    """A third of the rows and more share one key, and some have neither key nor text."""
    rows = [(7, f"t{k:04}") for k in range(1500)] + [(k, f"a{k}") for k in range(500)] + [(None, None), (None, "x")]
    got = files(rolled(spark, folder, rows, 1_000))
    lines = b"".join(got).decode().split("\n")[:-1]
    assert sorted(lines) == sorted(t or "" for _, t in rows)
    assert set(lines[:2]) == {"", "x"} and lines[-492:] == [f"a{k}" for k in range(8, 500)]
    assert max(map(len, got)) <= 1_006


def test_long_lines_and_no_rows(spark, folder):
    got = files(rolled(spark, folder, [(1, "a" * 50), (2, "b"), (3, "c" * 25), (4, "d")], 10))
    # Each line starts its own file, and no file is left empty.
    assert [f.decode() for f in got] == ["a" * 50 + "\n", "b\n" + "c" * 25 + "\n", "d\n"]
    assert files(rolled(spark, folder, [], 10)) == []
    with pytest.raises(ValueError):
        rolled(spark, folder, [], 0)


def test_names_of_the_caller(spark, folder):
    frame = spark.createDataFrame([(2, "b", 9), (1, "a", 9)], "file int, value string, at int")
    path = folder("rolled")
    write_rolled(frame, path, F.concat("value", F.col("at").cast("string")), ["file"], file_bytes=3)
    assert files(path) == [b"a9\n", b"b9\n"]


def test_folders_are_listed_in_a_few_tasks(spark, folder):
    """Not in a task for each folder."""
    path = rolled(spark, folder, [(k, "a" * 9) for k in range(100)], 10)
    context, group = spark.sparkContext, path
    context.setJobGroup(group, "listing")
    try:
        frame = read_rolled(spark, path)
    finally:
        context.setJobGroup("others", "others")
    status = context.statusTracker()
    stages = [s for job in status.getJobIdsForGroup(group) for s in status.getJobInfo(job).stageIds]
    tasks = [status.getStageInfo(s).numTasks for s in stages]
    assert tasks and max(tasks) <= 4 * context.defaultParallelism < 100
    assert {(r.file, r.value) for r in frame.collect()} == {(k, "a" * 9) for k in range(100)}
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"


def forks():
    """Processes and threads started on this machine so far."""
    with open("/proc/stat") as stat:
        return next(int(line.split()[1]) for line in stat if line.startswith("processes"))


def test_no_process_for_each_file(spark, folder):
    rolled(spark, folder, [(1, "a")], 10)
    before = forks()
    path = rolled(spark, folder, [(k, "a" * 9) for k in range(2000)], 10)
    assert forks() - before < 2000
    assert len(files(path)) == 2000 and os.path.exists(f"{path}/_SUCCESS")
    assert {n for n in os.listdir(path) if not n.startswith("file=")} == {"_SUCCESS", "._SUCCESS.crc"}


@pytest.mark.parametrize("limit", [1, 511, 513, 3_000, 1 << 30])
def test_as_sparks_own_writer(spark, folder, limit):
    """Bytes, modes and checksums are those of Spark's writer; files go over many batches and tasks over many files."""
    rows = [(k, "é" * (k % 60) + str(k)) for k in range(300)]
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
        path = rolled(spark, folder, rows, limit)
    again = folder("again")
    read_rolled(spark, path).repartition("file").sortWithinPartitions("file").write.partitionBy("file").text(again)

    def kept(at):
        found = sorted(glob.glob(f"{at}/file=*/*") + glob.glob(f"{at}/file=*/.*.crc") + glob.glob(f"{at}/file=*"))
        kinds = [(f"{f[len(at):].split('/')[1]}", f.endswith(".crc"), os.stat(f).st_mode, f) for f in found]
        return sorted((*k[:3], open(k[3], "rb").read() if os.path.isfile(k[3]) else None) for k in kinds)

    assert kept(path) == kept(again)
    assert {r.value for r in read_rolled(spark, path).collect()} == {text for _, text in rows}
    one = glob.glob(f"{path}/file=0/part-*")[0]
    with open(one, "r+b") as file:
        file.write(b"?")
    with pytest.raises(Exception, match="[Cc]hecksum"):
        read_rolled(spark, path).collect()


def test_modes(spark, folder):
    frame = lambda text: spark.createDataFrame([(1, text), (2, text)], "k int, value string")
    path = folder("rolled")

    def put(text, mode, limit=2):
        write_rolled(frame(text), path, F.col("value"), ["k"], file_bytes=limit, mode=mode)
        return files(path)

    assert put("a", "error") == [b"a\n", b"a\n"]
    with pytest.raises(AnalysisException):
        put("b", "error")
    assert put("c", "ignore") == [b"a\n", b"a\n"]
    assert sorted(put("d", "append")) == [b"a\n", b"a\n", b"d\n", b"d\n"]
    # Folders that are not written again stay, as the tests' session overwrites by folder.
    assert put("e", "overwrite", 9) == [b"e\ne\n", *files(path)[1:]] and len(files(path)) == 3
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
        assert put("f", "overwrite") == [b"f\n", b"f\n"]


def test_folders_are_no_partitions(spark, folder):
    """Which Spark takes in with a time that grows by their number squared; a condition on the file still leaves files out."""
    path = rolled(spark, folder, [(k, f"{k:09}") for k in range(300)], 10)
    read = read_rolled(spark, path)
    assert read.schema.simpleString() == "struct<value:string,file:bigint>"
    scans = lambda df: df._jdf.queryExecution().executedPlan().collectLeaves()
    assert scans(read).head().relation().location().partitionSpec().partitionColumns().isEmpty()
    one = read.where(F.col("file") == 17)
    assert [tuple(r) for r in one.collect()] == [("000000017", 17)]
    assert scans(one).head().metrics().apply("numFiles").value() == 1
