"""Sensor-event sources.

* ``decode_events``: JSON text -> typed event columns, lenient or strict.
* ``read_event_stream`` / ``read_event_batch``: the same decoder over a log
  topic (Kafka, when its connector is on the classpath) or over a folder of
  JSON-lines files (the file twin of a topic).
* ``sensor_events_from_table`` / ``table_event_stream``: map the generic
  ``events`` table (event_id, ts, user_id, event_type, value, props) to sensor
  events, so the engine runs on the provided tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skein.config import EngineConfig
from skein.functions.timefmt import event_time_wire, event_ts
from skein.schemas import EVENT_COLUMNS, EVENT_WIRE, EVENT_WIRE_TEXT

EVENTS_TABLE_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# Fixed values of the table -> sensor-event mapping: 10 sensors
# ("sensor-001" .. "sensor-010"), two per manufacturer id 1..5 (id 5 has no
# dimension row on purpose), humidity = props.k * 1.25.
SENSOR_COUNT = 10
SENSORS_PER_MANUFACTURER = 2
HUMIDITY_FACTOR = 1.25


def sensor_events_from_table(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``events`` table -> sensor events.

    The typed ``event_ts`` comes straight from ``ts`` (cast to a session-zone
    TIMESTAMP, which streaming watermarks require); ``event_time`` is the wire
    text of the same instant and is pruned by Catalyst when unused.

    ``props.k`` is read with ``json_tuple``: a generator, so the JSON text is
    parsed once per row even though the quality filter and the projection
    both use the value (an inlined ``get_json_object`` is parsed once per
    reference), and filters on other columns still run before it and reach
    the Parquet scan.
    """
    keep = keep or []
    base = [c for c in dict.fromkeys([*keep, "user_id", "ts", "value"])]
    events = events.select(*base, F.json_tuple("props", "k").alias("_k"))
    slot = F.col("user_id") % F.lit(SENSOR_COUNT)
    ts = F.col("ts").cast("timestamp")
    cols = [
        F.concat(F.lit("sensor-"), F.lpad((slot + 1).cast("string"), 3, "0")).alias("sensor_id"),
        (F.floor(slot / F.lit(SENSORS_PER_MANUFACTURER)) + 1).cast("smallint").alias("manufacturer_id"),
        event_time_wire(ts).alias("event_time"),
        F.col("value").alias("temperature"),
        (F.col("_k").cast("double") * F.lit(HUMIDITY_FACTOR)).alias("humidity"),
        ts.alias("event_ts"),
    ]
    return events.select(*keep, *cols)


def _parse_once(parsed: Column) -> Column:
    """Exactly one output row per input row, holding the parsed struct."""
    return F.explode(F.array(parsed)).alias("_e")


def decode_events(raw: DataFrame, cfg: EngineConfig, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON text column -> ``sensor_id, manufacturer_id, event_time,
    temperature, humidity, event_ts``.

    Fields are read as text, so a quoted ``"22.5"`` is a number in both modes.

    lenient  malformed text, missing fields, what isn't a number and ids that
             are no whole number of the id's range give nulls, which the
             quality filter then rejects.
    strict   a missing field, malformed record, bad number, out-of-range
             id or unparseable time raises and fails the query.

    The record is parsed once per row: the parsed struct comes out of a
    one-element ``explode``, so later references (the quality filter pushed
    below this projection, the casts, the timestamp) read the generator's
    output instead of re-parsing the text once per field reference.
    """
    keep = keep or []
    text = F.col(value_col).cast("string")
    if cfg.decode == "lenient":
        parsed = raw.select(*keep, _parse_once(F.from_json(text, EVENT_WIRE_TEXT)))
        out = parsed.select(*keep, *(F.col(f"_e.{f.name}").try_cast(f.dataType).alias(f.name) for f in EVENT_WIRE.fields))
        return out.withColumn("event_ts", event_ts("event_time", cfg.time_mode))

    parsed = raw.select(*keep, _parse_once(F.from_json(text, EVENT_WIRE_TEXT, {"mode": "FAILFAST"})))
    record = F.when(
        F.col("_e").isNull(), F.raise_error(F.lit("malformed event record"))
    ).otherwise(F.col("_e"))
    parsed = parsed.select(*keep, record.alias("_e"))

    def required(name: str) -> Column:
        c = F.col(f"_e.{name}")
        return F.when(c.isNull(), F.raise_error(F.lit(f"missing field {name}"))).otherwise(c)

    def converted(c: Column, name: str, value: Column) -> Column:
        # try_cast + explicit error: the same under any ANSI setting
        return F.when(value.isNull(), F.raise_error(F.concat(F.lit(f"bad {name}: "), c))).otherwise(value)

    target = {f.name: f.dataType for f in EVENT_WIRE.fields}
    out = parsed.select(
        *keep,
        *(converted(required(c), c, required(c).try_cast(target[c])).alias(c) for c in EVENT_COLUMNS),
    )
    ts = event_ts("event_time", cfg.time_mode)
    return out.withColumn("event_ts", converted(F.col("event_time"), "event_time", ts))


def _raw_stream(spark: SparkSession, source: dict, cfg: EngineConfig) -> DataFrame:
    kind = source.get("kind", "files")
    if kind == "kafka":
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", source["bootstrap_servers"])
            .option("subscribe", source["topic"])
            .option("startingOffsets", source.get("starting_offsets", "earliest"))
        )
        # Bound each micro-batch, and split topic partitions into more
        # tasks than there are partitions when the cluster is wider.
        if source.get("max_offsets_per_trigger"):
            reader = reader.option("maxOffsetsPerTrigger", int(source["max_offsets_per_trigger"]))
        if source.get("min_partitions"):
            reader = reader.option("minPartitions", int(source["min_partitions"]))
        return reader.load().select(F.col("value").cast("string").alias("value"))
    reader = _bounded(spark.readStream, source.get("max_files_per_trigger"), source.get("max_bytes_per_trigger") or cfg.bytes_per_trigger)
    return reader.text(source["path"])


def _bounded(reader, files: int | None, size: int | None):
    """A micro-batch of at most so many files, or else so many bytes (whole files)."""
    if files:
        return reader.option("maxFilesPerTrigger", int(files))
    return reader.option("maxBytesPerTrigger", str(int(size or EngineConfig().bytes_per_trigger)))


def read_event_stream(spark: SparkSession, source: dict, cfg: EngineConfig) -> DataFrame:
    """Streaming events from a topic or a folder of JSON-lines files.

    ``source``: ``{"kind": "files", "path": ..., "max_files_per_trigger": n, "max_bytes_per_trigger": n}``
    or ``{"kind": "kafka", "bootstrap_servers": ..., "topic": ...,
    "max_offsets_per_trigger": n, "min_partitions": n}``.
    Replay from the start or resume is decided by the checkpoint location
    of the query that consumes the stream (new location = replay).
    """
    return decode_events(_raw_stream(spark, source, cfg), cfg)


def read_event_batch(spark: SparkSession, path: str, cfg: EngineConfig) -> DataFrame:
    """Bounded twin of :func:`read_event_stream` over JSON-lines files."""
    return decode_events(spark.read.text(path), cfg)


def table_event_stream(
    spark: SparkSession, path_glob: str, max_files_per_trigger: int | None = None, max_bytes_per_trigger: int | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Streaming read of ``events`` parquet files (a glob such as
    ``.../events*.parquet``; the streaming file source needs a folder or a
    glob), mapped to sensor events."""
    reader = _bounded(spark.readStream.schema(EVENTS_TABLE_SCHEMA), max_files_per_trigger, max_bytes_per_trigger)
    return sensor_events_from_table(reader.parquet(path_glob), keep=keep)
