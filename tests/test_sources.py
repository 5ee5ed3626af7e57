import json

import pytest
from pyspark.sql import functions as F

from sensorstream.plans.archive import documents
from sensorstream.plans.publish import publish_to_files
from sensorstream.plans.recompute import recompute
from sensorstream.schemas import LOCATION, READING
from sensorstream.session import new_folder, settings, shared_folder, shuffle_partitions_for
from sensorstream.sources import kafka
from sensorstream.sources.arrays import array_elements
from sensorstream.sources.collections import (
    FOLDERS,
    create_collections,
    create_folders,
    distinct_positions,
    find,
    refresh_collections,
)
from sensorstream.sources.files import (
    read_file_log,
    read_locations,
    read_messages,
    read_readings,
    with_log_position,
    write_arrays,
    write_locations,
    write_readings,
)
from sensorstream.streaming.sinks import batch_store

LOCATIONS_CSV = """sensor_id,address,topography
17,"Unit ""B"", Kiln Lane
back entrance
Harborough","[""farmer's field"", 'marsh', 'quarry, old']"
4,,[]
23,Lighthouse,"['cliff', ""the \\""big\\"" rock"", 'it\\'s wet', 'a\\\\b']"
8,"Glasshouse 3,
Fen Road",
"""
FEATURES = {
    17: ["farmer's field", "marsh", "quarry, old"],
    4: [],
    23: ["cliff", 'the "big" rock', "it's wet", "a\\b"],
    8: None,
}


def series(spark, sensors=3, seconds=20):
    return spark.range(sensors * seconds).select(
        (F.col("id") % sensors).cast("int").alias("id"),
        F.lit(1).alias("location_id"),
        F.lit(1.5).alias("latitude"),
        F.lit(2.5).alias("longitude"),
        F.lit(3.5).alias("elevation"),
        F.when(F.col("id") % sensors < 1, "humidity").otherwise("temperature").alias("sensor_type"),
        F.date_format(
            F.timestamp_seconds(F.lit(1262435100) + F.floor(F.col("id") / sensors)), "yyyy-MM-dd HH:mm:ss"
        ).alias("timestamp"),
        (F.col("id") % 51 + 50).cast("double").alias("value"),
    )


def test_json_array_file(spark, tmp_path):
    reading = {
        "id": 2, "location_id": 1, "latitude": 1.0, "longitude": 2.0, "elevation": 3.0,
        "sensor_type": "temperature", "timestamp": "2010-01-02 12:25:00", "value": 95,
    }
    path = tmp_path / "sensor.json"
    path.write_text(json.dumps([reading, {**reading, "value": 96}], indent=4))
    rows = read_readings(spark, str(path))
    assert rows.schema == READING
    assert [r.value for r in rows.collect()] == [95.0, 96.0]


def test_readings_round_trip(spark, folder):
    path, rows = folder(), series(spark)
    write_readings(rows, path)
    back = read_readings(spark, path, lines=True).select(*READING.names)
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()
    files = back.select(F.input_file_name()).distinct().count()
    assert files <= 4  # by bytes, not by sensor


def test_locations(spark, tmp_path, folder):
    path = tmp_path / "locations.csv"
    path.write_text(LOCATIONS_CSV)
    rows = read_locations(spark, str(path))
    assert rows.schema == LOCATION
    got = {r.location_id: (r.address, r.topography) for r in rows.collect()}
    assert {k: t for k, (_, t) in got.items()} == FEATURES
    assert {k: a for k, (a, _) in got.items()} == {
        17: 'Unit "B", Kiln Lane\nback entrance\nHarborough', 4: None, 23: "Lighthouse", 8: "Glasshouse 3,\nFen Road",
    }
    copy = folder()
    write_locations(rows, copy)
    again = read_locations(spark, copy)
    assert {r.location_id: (r.address, r.topography) for r in again.collect()} == got


@pytest.mark.parametrize("literal", ["road", "['road'", "['road' 'lake']", "['a', b]", "['it's']"])
def test_what_is_no_list_stops_the_job(spark, tmp_path, literal):
    path = tmp_path / "locations.csv"
    path.write_text(f'sensor_id,address,topography\n1,x,"{literal}"\n')
    with pytest.raises(Exception, match="no list of quoted texts"):
        read_locations(spark, str(path)).collect()


def test_publishes_to_one_log_keep_their_positions(spark, folder):
    path = folder()
    for _ in range(3):
        publish_to_files(series(spark, sensors=5, seconds=4), path, partitions=2)
    log = read_file_log(spark, path)
    assert log.count() == 60 == log.select("topic", "partition", "offset").distinct().count()
    assert distinct_positions(log).count() == 60


def test_equal_times_spread_over_tasks(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 2000).cast("string").alias("key"), F.lit("v").alias("value"), F.lit("t").alias("topic"),
        F.lit(None).cast("string").alias("sent_order"),
    )
    with settings(spark, {"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        placed = with_log_position(rows, "sent_order")
        tasks = placed.select(F.shiftright("offset", 33)).distinct().count()
        assert tasks > 1 and placed.select("offset").distinct().count() == 40_000


def test_file_log(spark, folder):
    path = folder()
    publish_to_files(series(spark), path, partitions=4)
    log = read_file_log(spark, path)
    assert log.count() == 60
    assert log.groupBy("key").agg(F.countDistinct("partition").alias("p")).where("p > 1").isEmpty()
    assert log.select("topic", "partition", "offset").distinct().count() == 60
    # Offsets of a sensor ascend with time.
    stamp = F.get_json_object("value", "$.timestamp")
    by_offset = log.groupBy("key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("offset", stamp.alias("t")))), lambda x: x["t"]).alias("t")
    )
    assert all(r.t == sorted(r.t) for r in by_offset.collect())


def test_topic_subscription_prunes_folders(spark, folder):
    path = folder()
    publish_to_files(series(spark), path)
    humid = read_file_log(spark, path, ["humidity-topic"])
    assert humid.count() == 20
    plan = humid._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "(topic#" in plan.split("PartitionFilters: [")[1]


def test_kafka_options():
    assert kafka.read_options("b:9092", ["temperature-topic", "humidity-topic"]) == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "temperature-topic,humidity-topic",
        "startingOffsets": "earliest",
    }
    grouped = kafka.read_options(
        "b:9092", ["t"], starting_offsets="latest", group_id="g", max_offsets_per_trigger=5
    )
    assert grouped["startingOffsets"] == "latest"
    assert grouped["kafka.group.id"] == "g"
    assert grouped["maxOffsetsPerTrigger"] == "5"
    assert kafka.write_options("b:9092") == {"kafka.bootstrap.servers": "b:9092", "kafka.acks": "1"}


def test_kafka_without_connector(spark):
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        kafka.read_topics(spark, "b:9092", ["t"])


def test_documents_and_collections(spark, messages, folder):
    store = folder("store")
    good = '{"id":2,"timestamp":"2010-01-02 12:25:00","value":95}'
    texts = [good, '{"id":3}', "nope", None]
    batch = documents(messages(texts).unionByName(messages([good], "other")))
    create_folders(spark, store)
    assert find(spark, store, "humidity").isEmpty()
    write = batch_store(store, FOLDERS)
    write(batch, 0)
    write(batch, 0)
    assert find(spark, store, "temperature").count() == 2
    aside = [r.raw for r in find(spark, store, "quarantine").collect()]
    assert sorted(map(str, aside)) == sorted(["nope", "None", good])
    assert {r.raw for r in find(spark, store, "temperature").collect()} == {good, '{"id":3}'}
    assert find(spark, store, "temperature", F.col("value") > 90).count() == 1
    # The same log under another batch number, as after a lost checkpoint.
    write(batch, 1)
    assert find(spark, store, "temperature").count() == 4
    assert distinct_positions(find(spark, store, "temperature")).count() == 2


def test_days_prune_a_recomputation(spark, messages, folder):
    store = folder("store")
    texts = [f'{{"id":2,"timestamp":"2010-01-0{d} 12:25:00","value":95}}' for d in (1, 2, 3)] + ['{"id":3}']
    create_folders(spark, store)
    batch_store(store, FOLDERS)(documents(messages(texts)), 0)
    one = recompute(spark, store, where=F.col("day") == "2010-01-02")
    assert one.count() == 10 and recompute(spark, store).count() == 30
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "(day#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_catalog_tables(spark, messages, folder):
    store = folder("store")
    create_collections(spark, store, "sensors_test")
    create_collections(spark, store, "sensors_test")
    assert spark.table("sensors_test.temperature").count() == 0
    text = '{"id":2,"timestamp":"2010-01-02 12:25:00","value":95}'
    batch_store(store, FOLDERS)(documents(messages([text])), 0)
    refresh_collections(spark, "sensors_test")
    assert spark.table("sensors_test.temperature").where("value > 90").count() == 1
    assert spark.table("sensors_test.humidity").count() == 0


def test_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    assert new_folder(spark, "x").startswith(f"{named}/x-")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_shuffle_sizing():
    assert shuffle_partitions_for(0, 8) == 24
    assert shuffle_partitions_for(2 * 2**40, 4000) == 65_536
    assert shuffle_partitions_for(100 * 2**40, 4000) == 100 * 2**40 // 2**25


# --- JSON arrays ------------------------------------------------------------------


@pytest.mark.parametrize("block", ["40", "1k", "128m"])
def test_arrays_are_read_by_many_tasks(spark, tmp_path, block):
    objects = [
        {"id": k, "note": 'a } "q" { b\\', "ü": "}" * (k % 3), "meta": {"of": {"e": [k, {}]}} if k % 5 == 0 else None}
        for k in range(120)
    ]
    compact = [json.dumps(o, ensure_ascii=False, separators=(",", ":")) for o in objects]
    (tmp_path / "one.json").write_text("[" + ",".join(compact) + "]")
    (tmp_path / "lines.json").write_text("[\n  " + " ,\n  ".join(compact) + "\n]\n\n")
    (tmp_path / "bare.json").write_text("".join(compact))
    (tmp_path / "empty.json").write_text(" [ ]\n")
    (tmp_path / "none.json").write_text("")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": block, "spark.sql.files.openCostInBytes": "1"}):
        tasks = spark.read.option("lineSep", "}").text(str(tmp_path / "one.json")).rdd.getNumPartitions()
        got = [r.value for r in array_elements(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(compact * 3)
    assert tasks > 5 or block == "128m"


@pytest.mark.parametrize(
    "text", ['[{"a":1}', '[{"a":1', '[{"a":"1', '[{"a":1}}]', '[1,{"a":1}]', '[{"a":1}] x', 'x [{"a":{"b":1}}]', "7"]
)
def test_what_is_no_array_of_objects_stops_the_job(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    if text == '[{"a":1}':  # nothing is missing but the bracket
        assert [r.value for r in array_elements(spark, str(tmp_path)).collect()] == ['{"a":1}']
    else:
        with pytest.raises(Exception, match="no array of objects"):
            array_elements(spark, str(tmp_path)).collect()


def test_arrays_that_were_written_read_back(spark, folder):
    texts = spark.range(100).select(F.to_json(F.struct("id", F.lit("}{").alias("t"))).alias("value")).repartition(3)
    path = folder()
    write_arrays(texts, path)
    lines = spark.read.text(path).collect()
    assert sum(r.value.startswith("[") for r in lines) == sum(r.value.endswith("]") for r in lines) == 3
    assert read_messages(spark, path).exceptAll(texts).isEmpty() and read_messages(spark, path).count() == 100


def test_messages_are_published_as_sent(spark, folder):
    texts = [
        '{"id":1, "sensor_type":"humidity","timestamp":"2010-01-01 00:00:02","value":1.50,"unit":"C"}',
        '{"id":1,"sensor_type":"humidity","timestamp":"2010-01-01 00:00:01","value":1}',
        '{"id":2,"value":3}',
        "no json",
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    log = folder()
    publish_to_files(frame, log)
    sent = {r.value: r for r in read_file_log(spark, log).collect()}
    assert sorted(sent) == sorted(texts)
    assert [sent[t].topic for t in texts] == ["humidity-topic"] * 2 + ["untyped-topic"] * 2
    assert [sent[t].key for t in texts] == ["1", "1", "2", None]
    assert sent[texts[1]].offset < sent[texts[0]].offset  # by the time in the text
    assert read_file_log(spark, log, ["untyped-topic"]).count() == 2
    publish_to_files(frame, log, topic="other-topic")
    assert read_file_log(spark, log, ["other-topic"]).count() == 4


def test_readings_without_a_type_can_be_read(spark, folder):
    rows = series(spark, 2, 3).withColumn("sensor_type", F.when(F.col("id") == 1, F.col("sensor_type")))
    log = folder()
    publish_to_files(rows, log)
    assert read_file_log(spark, log).where("topic is null").count() == 0
    assert read_file_log(spark, log, ["untyped-topic"]).count() == 3


def test_messages_are_made_once(spark, folder):
    """Placing them by ranges reads them twice."""
    made = spark.sparkContext.accumulator(0)

    def passed(text):
        made.add(1)
        return text

    texts = spark.createDataFrame([(f'{{"id":{n},"timestamp":"{n:04}"}}',) for n in range(50)], "value string")
    path = folder("log")
    publish_to_files(texts.select(F.udf(passed, "string")("value").alias("value")), path, topic="t")
    assert read_file_log(spark, path).select("key").distinct().count() == 50
    assert made.value == 50
