import json

import pytest
from pyspark.sql import functions as F

from sensorstream.__main__ import main, parser
from sensorstream.sources.collections import find
from sensorstream.sources.files import read_file_log, write_file_log
from test_sources import series


@pytest.fixture
def dump(spark, tmp_path):
    """Two files, each one indented array of a sensor's readings."""
    rows = [r.asDict() for r in series(spark, sensors=2, seconds=30).collect()]
    for sensor in (0, 1):
        mine = [r for r in rows if r["id"] == sensor]
        (tmp_path / f"sensor_{sensor}.json").write_text(json.dumps(mine, indent=4))
    return str(tmp_path / "sensor_*.json")


def test_publish_archive_recompute_alert(spark, dump, folder):
    log, store, again, heat = folder("log"), folder("store"), folder("again"), folder("heat")
    main(["publish", dump, "--log", log, "--partitions", "2"])
    assert read_file_log(spark, log).count() == 60
    main(["archive", "--log", log, "--store", store])
    assert find(spark, store, "temperature").count() == find(spark, store, "humidity").count() == 30
    main(["recompute", "--store", store, "--output", again])
    assert spark.read.parquet(again).count() == 39
    main(["overheat", "--log", log, "--output", heat, "--mode", "update"])
    assert spark.read.parquet(heat).drop("batch_id").exceptAll(spark.read.parquet(again)).isEmpty()
    main(["overheat", "--log", log, "--alerts-only", "--mode", "update"])
    with pytest.raises(SystemExit):
        main(["overheat", "--log", log, "--files-per-batch", "1"])


def test_every_window_is_printed(spark, dump, folder, capsys):
    log, checkpoint = folder("log"), folder("checkpoint")
    main(["publish", dump, "--log", log])
    job = ["overheat", "--log", log, "--mode", "update", "--checkpoint", checkpoint, "--strict"]
    main(job)
    lines = [x for x in capsys.readouterr().out.splitlines() if x.startswith("sensor_id=")]
    assert len(lines) == 39
    main(job)  # the checkpoint holds: nothing is new
    assert not [x for x in capsys.readouterr().out.splitlines() if x.startswith("sensor_id=")]


def test_job_options(spark, dump, folder, capsys):
    log = folder("log")
    main(["publish", dump, "--log", log])

    def printed(*options):
        main(["overheat", "--log", log, "--mode", "update", *options])
        return [x for x in capsys.readouterr().out.splitlines() if x.startswith("sensor_id=")]

    assert len(printed("--size", "30 seconds", "--slide", "30 seconds")) == 1
    hot = printed("--mean-threshold", "1", "--alerts-only")
    assert len(hot) == 39
    assert len(printed("--mean-threshold", "1", "--alerts-only", "--min-count", "10")) < len(hot)
    assert not printed("--mean-threshold", "200", "--constant-threshold", "200", "--alerts-only")
    local = printed("--source-tz", "Europe/Berlin", "--decimals", "2")
    assert any("first_ts=2010-01-02 12:25:00" in x and "window_end=2010-01-02 11:25:" in x for x in local)
    assert len(printed("--arrival-order", "--time", "log", "--delay", "1 minute")) > 0


def test_quarantine(spark, dump, folder, messages):
    log, out = folder("log"), folder("aside")
    main(["publish", dump, "--log", log])
    write_file_log(messages(["nope"]), log)
    main(["quarantine", "--log", log, "--output", out, "--files-per-batch", "1"])
    assert [r.raw for r in spark.read.parquet(out).collect()] == ["nope"]


def test_archive_fills_tables(spark, dump, folder, messages):
    log, store = folder("log"), folder("store")
    main(["publish", dump, "--log", log])
    spark.sql("DROP TABLE IF EXISTS sensors.temperature")
    spark.sql("DROP TABLE IF EXISTS sensors.humidity")
    archive = ["archive", "--log", log, "--store", store, "--tables", "--files-per-batch", "2"]
    main(archive)
    main(["publish", dump, "--log", log])
    write_file_log(messages(['{"id":3}']), log)
    main(archive)
    for name, n in (("temperature", 61), ("humidity", 60)):
        assert spark.table(f"sensors.{name}").count() == find(spark, store, name).count() == n
        stored = spark.table(f"sensors.{name}").withColumn("file", F.input_file_name())
        files = stored.groupBy("batch_id", "day").agg(F.countDistinct("file").alias("f"))
        assert files.where("f > 2").isEmpty()


def test_count(spark, tmp_path, folder, capsys):
    path = tmp_path / "rows.csv"
    path.write_text("".join(f"hi,{ms}\n" for ms in (1, 2, 3, 4, 5, 8, 9, 15)))
    out = folder("counts")
    main(["count", str(path), "--output", out])
    rows = spark.read.option("header", True).csv(out)
    assert rows.count() == 8 and rows.agg(F.sum("n")).first()[0] == 19
    main(["count", str(path)])
    assert "k=hi" in capsys.readouterr().out
    path.write_text("".join(f"key{k},1\n" for k in range(40)))
    main(["count", str(path)])
    assert all(f"k=key{k} " in out_text for out_text in [capsys.readouterr().out] for k in range(40))


def test_a_job_needs_a_source():
    with pytest.raises(SystemExit):
        parser().parse_args(["overheat"])
    args = parser().parse_args(["overheat", "--servers", "b:9092"])
    assert args.topics == ["temperature-topic"] and args.starting_offsets == "earliest"
    assert parser().parse_args(["archive", "--servers", "b", "--store", "s"]).topics == [
        "temperature-topic",
        "humidity-topic",
    ]


def test_groups_and_drift(spark, dump, folder, capsys):
    log, store, offsets = folder("log"), folder("store"), folder("offsets")
    group = ["--offsets", offsets, "--group-id", "g"]
    for n in (60, 120):
        main(["publish", dump, "--log", log])
        main(["archive", "--log", log, "--store", store, "--checkpoint", folder("checkpoint"), *group])
        assert sum(find(spark, store, c).count() for c in ("temperature", "humidity")) == n
    capsys.readouterr()
    main(["drift", "--store", store])
    lines = capsys.readouterr().out.splitlines()
    assert "topic=humidity-topic  path=id  type=whole  n=60  fault=None" in lines


def test_count_into_files_of_a_size(spark, tmp_path, folder):
    path, out = tmp_path / "rows.csv", folder("counts")
    path.write_text("".join(f"key{k:02},1\n" for k in range(40)))
    main(["count", str(path), "--output", out, "--file-bytes", "200"])
    files = sorted(tmp_path.glob("counts-*/file=*/part-*"), key=lambda f: int(f.parent.name[len("file=") :]))
    lines = "".join(f.read_text() for f in files).splitlines()
    assert lines == sorted(lines) and len({x.split(",")[0] for x in lines}) == 40 and len(files) > 3
    with pytest.raises(SystemExit):
        main(["count", str(path), "--file-bytes", "200"])
