"""Declared schemas (no inference anywhere)."""

from pyspark.sql import types as T

# Event as it travels on the wire (JSON record).
EVENT_WIRE = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("manufacturer_id", T.ShortType()),
        T.StructField("event_time", T.StringType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("humidity", T.DoubleType()),
    ]
)

# Same fields read as text, for the strict decoder (casts happen afterwards).
EVENT_WIRE_TEXT = T.StructType(
    [T.StructField(f.name, T.StringType()) for f in EVENT_WIRE.fields]
)

EVENT_COLUMNS = [f.name for f in EVENT_WIRE.fields]

MANUFACTURERS = T.StructType(
    [
        T.StructField("id", T.ShortType()),
        T.StructField("manufacturer_name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)

SENSORS = T.StructType(
    [
        T.StructField("sensor_id", T.StringType()),
        T.StructField("manufacturer_id", T.ShortType()),
    ]
)

ENRICHED_COLUMNS = [
    "sensor_id",
    "manufacturer_id",
    "manufacturer_name",
    "country",
    "event_time",
    "event_ts",
    "temperature",
    "humidity",
]

RESULT = T.StructType(
    [
        T.StructField("window_start", T.StringType()),
        T.StructField("window_end", T.StringType()),
        T.StructField("manufacturer_id", T.ShortType()),
        T.StructField("manufacturer_name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("events_count", T.LongType()),
        T.StructField("avg_temperature", T.DoubleType()),
        T.StructField("median_humidity", T.DoubleType()),
    ]
)

RESULT_COLUMNS = [f.name for f in RESULT.fields]

# Key of the upsert output.
UPSERT_KEY = ["window_start", "window_end", "manufacturer_id"]

# A message read back from a published output.
CONSUMED_MESSAGE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("topic_message_number", T.LongType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)
