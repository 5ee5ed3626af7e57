"""Record schemas and the fixed values every job shares."""

from pyspark.sql import types as T

# They must equal the described system's for results to agree.
WINDOW_SIZE = "10 seconds"
WINDOW_SLIDE = "1 second"
OUT_OF_ORDERNESS = "2 seconds"
MEAN_THRESHOLD = 90.0
CONSTANT_THRESHOLD = 89.0
MEAN_DIGITS = 3
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TEMPERATURE_TOPIC = "temperature-topic"
HUMIDITY_TOPIC = "humidity-topic"
DATABASE = "sensors"
COLLECTIONS = ("temperature", "humidity")

# One sensor reading. Field order is part of the wire format.
READING = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("location_id", T.IntegerType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("elevation", T.DoubleType()),
        T.StructField("sensor_type", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# A message log record: what the Kafka source yields, and what the file log stores.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Location dimension. The file's first header says sensor_id, but the column
# holds the location index, so it is read under its real name.
LOCATION = T.StructType(
    [
        T.StructField("location_id", T.IntegerType()),
        T.StructField("address", T.StringType()),
        T.StructField("topography", T.ArrayType(T.StringType())),
    ]
)
LOCATION_HEADER = ("sensor_id", "address", "topography")

# Input of the bounded count job: key and event time in milliseconds.
KEYED_MILLIS = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("ms", T.LongType())]
)
