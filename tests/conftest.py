import os
import sys
import uuid

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sensorstream.session import session_builder  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
START = "2010-01-02 12:25:00"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        session_builder("tests", checkpoint_dir=str(home / "checkpoint"))
        .master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A fresh path per use."""
    return lambda name="data": str(tmp_path / f"{name}-{uuid.uuid4().hex[:8]}")


@pytest.fixture
def readings(spark):
    """Decoded readings from (sensor, seconds after the start, value[, offset])."""

    def build(rows):
        rows = [(r[0], float(r[1]), float(r[2]), r[3] if len(r) > 3 else i) for i, r in enumerate(rows)]
        frame = spark.createDataFrame(rows, "sensor_id int, s double, value double, offset long")
        start = F.to_timestamp(F.lit(START))
        return frame.select(
            "sensor_id",
            (start + F.make_dt_interval(secs=F.col("s"))).alias("event_time"),
            "value",
            F.lit(0).alias("partition"),
            "offset",
        )

    return build


@pytest.fixture
def messages(spark):
    """Envelope rows from message texts."""

    def build(texts, topic="temperature-topic"):
        rows = [(t, i) for i, t in enumerate(texts)]
        frame = spark.createDataFrame(rows, "value string, offset long")
        return frame.select(
            F.lit("k").alias("key"),
            "value",
            F.lit(topic).alias("topic"),
            F.lit(0).alias("partition"),
            "offset",
            F.current_timestamp().alias("timestamp"),
        )

    return build
