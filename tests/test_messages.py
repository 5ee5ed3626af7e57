import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sensorstream.functions.codec import CORRUPT, decode, encode
from sensorstream.functions.eventtime import parse_event_time
from sensorstream.functions.keys import log_partition, log_place, position_key
from sensorstream.operators.quality import good_readings, quarantined
from sensorstream.operators.routing import by_topic, collection_of, topic_of
from sensorstream.plans.publish import messages_of
from sensorstream.schemas import READING

READING_TEXT = (
    '{"id":2,"location_id":1,"latitude":1.0,"longitude":2.0,"elevation":3.0,'
    '"sensor_type":"temperature","timestamp":"2010-01-02 12:25:00","value":95}'
)
MIXED = [
    '{"id":3,"timestamp":"2010-01-02 12:25:00","value":50}',
    '{"id":3,"timestamp":"2010-01-02 12:25:00","value":"51"}',
    "nope",
    '{"id":3}',
    None,
]


def test_keys(messages):
    texts = ['{"id":3,"value":50}', '{"id":12,"value":50}', '{"id": 3}', '{"id":-1}']
    rows = decode(messages(texts)).select("sensor_id", position_key(F.col("raw")).alias("p"))
    assert [tuple(r) for r in rows.collect()] == [(3, 3), (12, 1), (3, None), (-1, None)]


def test_malformed_messages(messages):
    rows = decode(messages(MIXED), corrupt=True).select("sensor_id", "timestamp", "value", CORRUPT)
    stamp = "2010-01-02 12:25:00"
    assert [tuple(r) for r in rows.collect()] == [
        (3, stamp, 50.0, None),
        (3, stamp, None, MIXED[1]),
        (None, None, None, "nope"),
        (3, None, None, None),
        (None, None, None, None),
    ]


@pytest.mark.parametrize("corrupt", [False, True])
def test_quarantine_split(messages, corrupt):
    decoded = decode(messages(MIXED), corrupt=corrupt)
    assert [r.raw for r in good_readings(decoded).collect()] == MIXED[:1]
    aside = {r.raw: r.missing for r in quarantined(decoded).collect()}
    assert aside == {
        MIXED[1]: "value",
        "nope": "sensor_id,event_time,value",
        MIXED[3]: "event_time,value",
        None: "sensor_id,event_time,value",
    }


@pytest.mark.parametrize(
    "text",
    [
        "{'id':3,'timestamp':'2010-01-02 12:25:00','value':50}",
        '[{"id":3}]',
        '{"id":3,"timestamp":"2010-01-02 12:25:00","value":true}',
        '{"id":99999999999,"timestamp":"2010-01-02 12:25:00","value":50}',
        "",
    ],
)
def test_other_texts_are_set_aside(messages, text):
    decoded = decode(messages([text]))
    assert good_readings(decoded).isEmpty()
    assert [r.raw for r in quarantined(decoded).collect()] == [text]


@pytest.mark.parametrize("bad", [*MIXED[1:], '{"id":1,"timestamp":"soon","value":1}'])
def test_failfast_stops(messages, bad):
    assert decode(messages(MIXED[:1]), mode="FAILFAST").collect()[0].sensor_id == 3
    with pytest.raises((PySparkException, Py4JError)):
        decode(messages([bad]), mode="FAILFAST").collect()


def test_messages_are_parsed_once_and_only_as_needed(messages):
    """Filters on decoded columns stay above the parse instead of repeating it."""
    decoded = decode(messages(MIXED), fields=("id", "timestamp", "value"))
    narrow = good_readings(decoded).select("sensor_id", "event_time", "value")
    plan = narrow._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("gettimestamp(") == 1
    assert "latitude" not in plan and "log_time" not in plan
    assert narrow.count() == 1
    with pytest.raises(ValueError, match="timestamp"):
        decode(messages(MIXED), fields=("id", "value"))


def test_text_survives_decode_and_encode(messages):
    decoded = decode(messages([READING_TEXT])).withColumnRenamed("sensor_id", "id")
    row = encode(decoded).collect()[0]
    assert (row.key, row.value) == ("2", READING_TEXT)
    assert encode(decoded, integral_values=False).collect()[0].value.endswith('"value":95.0}')


def test_fractions_stay_fractions(spark):
    rows = [(i, 0, 0.5, 0.0, 1.0, "humidity", "2010-01-02 12:25:00", v) for i, v in enumerate([50.25, -3.0])]
    texts = [r.value for r in encode(spark.createDataFrame(rows, READING)).collect()]
    assert texts[0].endswith('"value":50.25}') and texts[1].endswith('"value":-3}')


def test_publish_keeps_the_positional_key(spark):
    rows = [(i, 0, 0.5, 0.0, 1.0, t, "2010-01-02 12:25:00", 60.0) for i, t in
            enumerate(["humidity", "humidity", "temperature", "temperature", "temperature"])]
    published = messages_of(spark.createDataFrame(rows, READING))
    got = published.select("key", "topic", position_key(F.col("value")).alias("p")).collect()
    assert [(r.key, r.topic, r.p) for r in got] == [
        ("0", "humidity-topic", 0),
        ("1", "humidity-topic", 1),
        ("2", "temperature-topic", 2),
        ("3", "temperature-topic", 3),
        ("4", "temperature-topic", 4),
    ]
    assert by_topic(published, "humidity-topic").count() == 2


def test_routes(spark):
    row = spark.range(1).select(
        topic_of(F.lit("humidity")).alias("topic"),
        collection_of(F.lit("temperature-topic")).alias("known"),
        collection_of(F.lit("other")).alias("unknown"),
    ).collect()[0]
    assert tuple(row) == ("humidity-topic", "temperature", None)


def test_event_time_parsing(spark):
    texts = ["2010-01-02 12:25:00", "2010-01-02", "2010-02-30 00:00:00", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    utc = frame.select(F.unix_timestamp(parse_event_time(F.col("t"))).alias("s")).collect()
    assert [r.s for r in utc] == [1262435100, None, None, None]
    local = frame.select(F.unix_timestamp(parse_event_time(F.col("t"), "Europe/Berlin")).alias("s"))
    assert local.collect()[0].s == 1262435100 - 3600


def test_equal_keys_share_a_partition(spark):
    frame = spark.range(1000).select((F.col("id") % 50).cast("string").alias("key"))
    placed = frame.select("key", log_partition(F.col("key"), 8).alias("p")).distinct()
    assert placed.count() == 50
    assert {r.p for r in placed.collect()} <= set(range(8))


def test_log_place_orders_like_the_pair(spark):
    pairs = [(0, 5), (0, 2**62), (0, 2**63 - 1), (1, 0), (7, 3), (2**31 - 1, 2**63 - 1)]
    frame = spark.createDataFrame(pairs, "p int, o long")
    places = [r.x for r in frame.select(log_place(F.col("p"), F.col("o")).alias("x")).collect()]
    assert places == sorted(set(places)) and places[0] == 5
