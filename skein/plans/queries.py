"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the provided tables; ``ORACLE`` holds the DuckDB SQL for each one that
has an SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.config import JOBS, EngineConfig
from skein.functions.jsonfmt import result_json as result_json_col
from skein.functions.timefmt import event_ts as parse_event_ts
from skein.operators.enrich import enrich, unknown_manufacturer
from skein.operators.quality import clean, rejects
from skein.plans import oracle as O
from skein.plans.pipeline import results
from skein.session import apply_engine_conf
from skein.sources.dimensions import manufacturers_seed
from skein.sources.events import EVENTS_TABLE_SCHEMA, sensor_events_from_table

DEFAULT = EngineConfig(name="default")
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table; read with its declared schema when the engine has
    one (no schema-inference job)."""
    reader = spark.read
    if name == "events":
        reader = reader.schema(EVENTS_TABLE_SCHEMA)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sensor_events(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    apply_engine_conf(spark)
    return sensor_events_from_table(table(spark, sf_dir, "events"), keep=keep)


def _ts_text(c: str = "event_ts"):
    return F.date_format(c, TS_TEXT)


# ---------------------------------------------------------------- batch
def q_window(window: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cfg = DEFAULT.with_(window=window)
        return results(sensor_events(spark, sf_dir), manufacturers_seed(spark), cfg)

    return run


def _fine_events(spark, sf_dir):
    """The events with readings of four decimals, told from the event id."""
    ev = sensor_events(spark, sf_dir, keep=["event_id"])
    more = lambda c, m: F.col(c) + (F.col("event_id") % m) / F.lit(10000.0)
    return ev.withColumns({"temperature": more("temperature", 97), "humidity": more("humidity", 89)})


def q_window_fine(window: str, rounding: str = "half_up"):
    """Window results over readings that carry more decimals than the results."""

    def run(spark, sf_dir):
        cfg = DEFAULT.with_(window=window, rounding=rounding)
        return results(_fine_events(spark, sf_dir), manufacturers_seed(spark), cfg)

    return run


def precise_events(events):
    """The events with readings of 15 and more digits; a fifth of them a hair below a half cent."""
    close = F.col("event_id") % 5 == 0
    more = lambda c, m: F.col(c) + (F.col("event_id") % m).cast("double") / F.lit(m * 100.0)
    return events.withColumns(
        {
            "temperature": F.when(close, F.floor("temperature") + F.lit(0.01499999999)).otherwise(more("temperature", 9973)),
            "humidity": F.when(close, F.floor("humidity") + F.lit(0.00499999999)).otherwise(more("humidity", 9901)),
        }
    )


def q_window_precise(window: str, **options):
    """Window results over readings of full precision, exact in mean and median."""

    def run(spark, sf_dir):
        cfg = DEFAULT.with_(window=window, **options)
        return results(precise_events(sensor_events(spark, sf_dir, keep=["event_id"])), manufacturers_seed(spark), cfg)

    return run


def q_events_clean(spark, sf_dir):
    ev = clean(sensor_events(spark, sf_dir, keep=["event_id"]), DEFAULT)
    return ev.select("event_id", "sensor_id", "manufacturer_id", "event_time", "temperature", "humidity")


def q_events_rejected(spark, sf_dir):
    ev = rejects(sensor_events(spark, sf_dir, keep=["event_id"]), DEFAULT)
    return ev.select("event_id", "sensor_id", "manufacturer_id", "temperature", "humidity", "reason")


def q_events_enriched(spark, sf_dir):
    ev = clean(sensor_events(spark, sf_dir, keep=["event_id"]), DEFAULT)
    out = enrich(ev, manufacturers_seed(spark), keep=["event_id"])
    return out.select(
        "event_id", "sensor_id", "manufacturer_id", "manufacturer_name", "country",
        "event_time", "temperature", "humidity",
    )


def q_unknown_manufacturer(spark, sf_dir):
    ev = clean(sensor_events(spark, sf_dir, keep=["event_id"]), DEFAULT)
    out = unknown_manufacturer(ev, manufacturers_seed(spark))
    return out.select("event_id", "sensor_id", "manufacturer_id")


def q_event_time(mode: str):
    def run(spark, sf_dir):
        ev = sensor_events(spark, sf_dir, keep=["event_id"])
        parsed = parse_event_ts("event_time", mode)
        return ev.select("event_id", "event_time", F.date_format(parsed, TS_TEXT).alias("parsed_ts"))

    return run


def q_result_json(spark, sf_dir):
    res = q_window("1 minute")(spark, sf_dir)
    return res.select(result_json_col().alias("value"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "window_1min": q_window("1 minute"),
    "window_1day": q_window("1 day"),
    "window_1min_fine": q_window_fine("1 minute"),
    "window_1day_fine": q_window_fine("1 day"),
    "window_1day_fine_half_even": q_window_fine("1 day", "binary_half_even"),
    "window_1min_precise": q_window_precise("1 minute"),
    "window_1day_precise_rank": q_window_precise("1 day", quality_filter=False, median="rank"),
    "events_clean": q_events_clean,
    "events_rejected": q_events_rejected,
    "events_enriched": q_events_enriched,
    "unknown_manufacturer": q_unknown_manufacturer,
    "event_time_iso": q_event_time("iso"),
    "event_time_prefix23": q_event_time("prefix23"),
    "result_json": q_result_json,
}

_REJECT_REASON = """CASE
    WHEN sensor_id IS NULL THEN 'null_sensor_id'
    WHEN manufacturer_id IS NULL THEN 'null_manufacturer_id'
    WHEN event_time IS NULL THEN 'null_event_time'
    WHEN temperature IS NULL THEN 'null_temperature'
    WHEN humidity IS NULL THEN 'null_humidity'
    WHEN event_ts IS NULL THEN 'null_event_ts'
    WHEN NOT (temperature BETWEEN -50.0 AND 80.0) THEN 'temperature_out_of_range'
    WHEN NOT (humidity BETWEEN 0.0 AND 100.0) THEN 'humidity_out_of_range'
  END"""

ORACLE: dict[str, str] = {
    "window_1min": O.BASE + O.window_sql("1 minute"),
    "window_1day": O.BASE + O.window_sql("1 day"),
    "window_1min_fine": O.FINE_BASE + O.window_sql("1 minute"),
    "window_1day_fine": O.FINE_BASE + O.window_sql("1 day"),
    "window_1day_fine_half_even": O.FINE_BASE + O.window_sql("1 day", half_even=True),
    "window_1min_precise": O.PRECISE_BASE + O.window_sql("1 minute"),
    "window_1day_precise_rank": O.PRECISE_BASE + O.window_sql("1 day", "unfiltered"),
    "events_clean": O.BASE
    + "SELECT event_id, sensor_id, manufacturer_id, event_time, temperature, humidity FROM clean",
    "events_rejected": O.BASE
    + f"SELECT * FROM (SELECT event_id, sensor_id, manufacturer_id, temperature, humidity, {_REJECT_REASON} AS reason FROM ev) WHERE reason IS NOT NULL",
    "events_enriched": O.BASE
    + "SELECT event_id, sensor_id, manufacturer_id, manufacturer_name, country, event_time, temperature, humidity FROM enriched",
    "unknown_manufacturer": O.BASE
    + "SELECT event_id, sensor_id, manufacturer_id FROM clean WHERE manufacturer_id NOT IN (SELECT id FROM m)",
    "event_time_iso": O.BASE
    + "SELECT event_id, event_time, strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS parsed_ts FROM ev",
    "event_time_prefix23": O.BASE
    + "SELECT event_id, event_time, strftime(date_trunc('millisecond', event_ts), '%Y-%m-%d %H:%M:%S.%f') AS parsed_ts FROM ev",
    "result_json": O.BASE
    + f"SELECT {O.RESULT_JSON} AS value FROM ({O.window_sql('1 minute')})",
}


# ---------------------------------------------------------------- decode
def q_decode(mode: str):
    """Events -> wire JSON -> decoder (lenient or strict), whole table."""

    def run(spark, sf_dir):
        from skein.functions.jsonfmt import event_value_json
        from skein.sources.events import decode_events

        wire = sensor_events(spark, sf_dir, keep=["event_id"]).select("event_id", event_value_json().alias("value"))
        dec = decode_events(wire, DEFAULT.with_(decode=mode), keep=["event_id"])
        return dec.select(
            "event_id", "sensor_id", "manufacturer_id", "event_time", "temperature", "humidity",
            _ts_text().alias("parsed_ts"),
        )

    return run


#: The kinds of :func:`dirty_wire` that are unusual but whole.
WHOLE_KINDS = (0, 1, 4, 5, 6)


def dirty_wire(ev, whole: bool = False):
    """Events as JSON records of which most are unusual or broken, by the event id's remainder; with ``whole``
    unusual at most."""
    kind = F.element_at(F.array(*map(F.lit, WHOLE_KINDS)), (F.col("event_id") % len(WHOLE_KINDS) + 1).cast("int")) if whole else F.col("event_id") % 12
    text = F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    time = F.when(kind == 4, F.concat(text, F.lit("+03:00"))).when(kind == 5, text)
    time = time.when(kind == 6, F.concat(F.substring(text, 1, 19), F.lit("+00:00"))).otherwise(F.concat(text, F.lit("+00:00")))
    number = F.col("manufacturer_id").cast("string")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    maker = F.when(kind == 1, quoted(number)).when(kind == 3, F.lit("70000")).when(kind == 8, F.concat(number, F.lit(".9"))).otherwise(number)
    heat = F.col("temperature").cast("string")
    heat = F.when(kind == 1, quoted(heat)).when(kind == 9, F.lit('"warm"')).otherwise(heat)
    sensor = F.when(kind == 10, F.lit("null")).otherwise(quoted(F.col("sensor_id")))
    parts = [F.lit('{"sensor_id":'), sensor, F.lit(',"manufacturer_id":'), maker, F.lit(',"event_time":'), quoted(time)]
    parts += [F.when(kind == 2, F.lit("")).otherwise(F.concat(F.lit(',"temperature":'), heat)), F.lit(',"humidity":'), F.col("humidity").cast("string"), F.lit("}")]
    record = F.concat(*parts)
    broken = F.when(kind == 7, F.substring(record, 1, 40)).when(kind == 11, F.lit("not a record")).otherwise(record)
    return ev.select("event_id", broken.alias("value"))


def q_decode_dirty(spark, sf_dir):
    """Lenient decoding of broken and unusual records, whole table."""
    from skein.sources.events import decode_events

    dec = decode_events(dirty_wire(sensor_events(spark, sf_dir, keep=["event_id"])), DEFAULT, keep=["event_id"])
    return dec.select("event_id", "sensor_id", "manufacturer_id", "temperature", "humidity", _ts_text().alias("parsed_ts"))


def q_dirty_rejected(spark, sf_dir):
    """Which of those records the quality rules reject, and why."""
    from skein.sources.events import decode_events

    dec = decode_events(dirty_wire(sensor_events(spark, sf_dir, keep=["event_id"])), DEFAULT, keep=["event_id"])
    return rejects(dec, DEFAULT).select("event_id", "reason")


def q_decode_dirty_strict(spark, sf_dir):
    """Strict decoding of records that are unusual but whole (quoted numbers, other time forms), whole table."""
    from skein.sources.events import decode_events

    dec = decode_events(dirty_wire(sensor_events(spark, sf_dir, keep=["event_id"]), whole=True), DEFAULT.with_(decode="strict"), keep=["event_id"])
    return dec.select("event_id", "sensor_id", "manufacturer_id", "temperature", "humidity", _ts_text().alias("parsed_ts"))


def q_wire_messages(spark, sf_dir):
    """Keyed event messages: key = UTF-8 sensor id (hex here), value = JSON."""
    from skein.functions.jsonfmt import event_key, event_value_json

    ev = sensor_events(spark, sf_dir, keep=["event_id"])
    return ev.select("event_id", F.hex(event_key()).alias("key_hex"), event_value_json().alias("value"))


def q_sql_window(spark, sf_dir):
    from skein.plans.sql_route import sql_results

    return sql_results(spark, sensor_events(spark, sf_dir), manufacturers_seed(spark), DEFAULT)


def q_window_half_even(spark, sf_dir):
    cfg = DEFAULT.with_(rounding="binary_half_even")
    return results(sensor_events(spark, sf_dir), manufacturers_seed(spark), cfg)


REGISTRY.update(
    {
        "decode_lenient": q_decode("lenient"),
        "decode_strict": q_decode("strict"),
        "decode_dirty": q_decode_dirty,
        "decode_dirty_strict": q_decode_dirty_strict,
        "events_dirty_rejected": q_dirty_rejected,
        "wire_messages": q_wire_messages,
        "sql_window_1min": q_sql_window,
        "window_1min_half_even": q_window_half_even,
    }
)

_EV_JSON = O.json_object(
    ["sensor_id", "manufacturer_id", "event_time", "temperature", "humidity"]
)
ORACLE.update(
    {
        "decode_lenient": O.BASE
        + "SELECT event_id, sensor_id, manufacturer_id, event_time, temperature, humidity, "
        "strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS parsed_ts FROM ev",
        "wire_messages": O.BASE + f"SELECT event_id, hex(encode(sensor_id)) AS key_hex, {_EV_JSON} AS value FROM ev",
        "sql_window_1min": O.BASE + O.window_sql("1 minute"),
    }
)
ORACLE["decode_strict"] = ORACLE["decode_lenient"]
ORACLE["decode_dirty"] = O.DIRTY_BASE + "SELECT event_id, sensor_id, manufacturer_id, temperature, humidity, strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS parsed_ts FROM dirty"
ORACLE["decode_dirty_strict"] = ORACLE["decode_dirty"].replace("event_id % 12 AS k", "[0, 1, 4, 5, 6][event_id % 5 + 1] AS k")
ORACLE["events_dirty_rejected"] = O.DIRTY_BASE + f"SELECT * FROM (SELECT event_id, {_REJECT_REASON} AS reason FROM dirty) WHERE reason IS NOT NULL"
ORACLE["window_1min_half_even"] = O.BASE + O.window_sql("1 minute", half_even=True)


# ---------------------------------------------------------------- streams
def _replay(job: str, wire: bool):
    """Replay the whole ``events`` table through a streaming job (one
    available-now run with a fresh checkpoint) and read its output back."""

    def run(spark, sf_dir):
        from skein.schemas import RESULT_COLUMNS
        from skein.streaming.sinks import compact_output

        running = _replayed(spark, sf_dir, job, wire)
        if running.kind == "upsert":
            # The compaction job gives what a reader of the output sees.
            return compact_output(spark, running.output).select("key", "value", *RESULT_COLUMNS)
        return spark.read.parquet(running.output)

    return run


def _replayed(spark, sf_dir, job: str | EngineConfig, wire: bool, change=None, manufacturers=None):
    """The finished replay of a job over the whole table, its events first changed by ``change``."""
    from skein.functions.jsonfmt import event_value_json
    from skein.session import fresh_path, state_partitions
    from skein.sources.events import table_event_stream
    from skein.streaming.jobs import run_to_end, start_job

    apply_engine_conf(spark)
    files = f"{sf_dir.rstrip('/')}/events*.parquet"
    stream = table_event_stream(spark, files, keep=["event_id"] if change else None)
    if change:
        stream = change(stream)
    kwargs = {"raw": stream.select(event_value_json().alias("value"))} if wire else {"events": stream}
    root = fresh_path(spark, "replay", job if isinstance(job, str) else job.name)
    running = start_job(
        spark, job, manufacturers=manufacturers or manufacturers_seed(spark), output=f"{root}/out",
        checkpoint=f"{root}/checkpoint", trigger="available_now",
        state_partitions=state_partitions(spark, files), **kwargs,
    )
    return run_to_end(running)


REGISTRY.update(
    {
        "stream_hybrid_closed": _replay("hybrid", wire=True),
        "stream_bridge_closed": _replay("bridge", wire=False),
        "stream_pure_closed": _replay("pure", wire=True),
        "upsert_compacted": _replay("table_upsert", wire=True),
    }
)

_PURE_SRC = "joined AS (SELECT c.*, m.manufacturer_name, m.country FROM ev c JOIN m ON c.manufacturer_id = m.id WHERE c.event_ts IS NOT NULL)"
ORACLE.update(
    {
        "stream_hybrid_closed": O.BASE
        + f"SELECT {O.RESULT_JSON} AS value FROM ("
        + O.window_sql("1 minute", "enriched", closed_by="enriched")
        + ")",
        "stream_bridge_closed": O.BASE + O.window_sql("1 minute", "enriched", closed_by="enriched"),
        "stream_pure_closed": O.with_ctes(O.MANUFACTURERS_CTE, O.EVENTS_CTE, _PURE_SRC)
        + f"SELECT {O.RESULT_JSON} AS value FROM ("
        + O.window_sql("1 minute", "joined", closed_by="joined")
        + ")",
        "upsert_compacted": O.BASE
        + f"SELECT {O.json_object(['window_start', 'window_end', 'manufacturer_id'])} AS key, {O.RESULT_JSON} AS value, * FROM ("
        + O.window_sql("1 minute")
        + ")",
    }
)


HOT = EngineConfig(name="hot", output="update", watermark_at="source", window="1 day", median="rank")


def hot_events(events):
    """Readings of full precision, and one manufacturer with half of all rows."""
    return precise_events(events).withColumn("manufacturer_id", F.when(F.col("event_id") % 2 == 0, 1).otherwise(F.col("manufacturer_id")).cast("smallint"))


def q_upsert_hot_group(spark, sf_dir):
    """Replay in update mode of a stream with one hot manufacturer and full-precision readings, compacted."""
    from skein.schemas import RESULT_COLUMNS
    from skein.streaming.sinks import compact_output

    running = _replayed(spark, sf_dir, HOT, wire=False, change=hot_events)
    return compact_output(spark, running.output).select(*RESULT_COLUMNS)


def q_stream_pure_precise(spark, sf_dir):
    """Replay of the job without a range filter over full-precision readings: medians by rank selection."""
    from skein.schemas import RESULT_COLUMNS

    cfg = JOBS["pure"].with_(median="rank", emit="row", window="1 hour")
    return spark.read.parquet(_replayed(spark, sf_dir, cfg, wire=False, change=precise_events).output).select(*RESULT_COLUMNS)


REGISTRY.update({"upsert_hot_group": q_upsert_hot_group, "stream_pure_precise": q_stream_pure_precise})
ORACLE["upsert_hot_group"] = O.HOT_BASE + O.window_sql("1 day")
ORACLE["stream_pure_precise"] = O.PRECISE_BASE + O.window_sql("1 hour", "unfiltered", closed_by="unfiltered")


# ---------------------------------------------------------------- dimensions
def observed_sensors(spark, sf_dir):
    """Sensors seen in the event table with their latest reported
    manufacturer: the update feed of the sensor dimension."""
    from skein.operators.dimension import latest_per_key

    ev = sensor_events(spark, sf_dir).filter(F.col("sensor_id").isNotNull() & F.col("manufacturer_id").isNotNull())
    return latest_per_key(ev, "sensor_id", "manufacturer_id", "event_ts")


def q_dim_upsert(spark, sf_dir):
    """Seeded sensor dimension upserted with the sensors the events report,
    written as a new version."""
    from skein.operators.dimension import upsert_dimension, write_version
    from skein.sources.dimensions import sensors_seed

    upserted = upsert_dimension(sensors_seed(spark), observed_sensors(spark, sf_dir), ["sensor_id"])
    return write_version(spark, upserted, "sensors")


def q_dim_fk_violations(spark, sf_dir):
    from skein.operators.dimension import fk_violations

    return fk_violations(q_dim_upsert(spark, sf_dir), "manufacturer_id", manufacturers_seed(spark), "id")


def q_dim_rules(spark, sf_dir):
    from skein.operators.dimension import rule_report

    return rule_report(manufacturers_seed(spark), q_dim_upsert(spark, sf_dir))


REGISTRY.update(
    {
        "dim_upsert": q_dim_upsert,
        "dim_fk_violations": q_dim_fk_violations,
        "dim_rules": q_dim_rules,
    }
)

_OBSERVED = (
    "obs AS (SELECT sensor_id, arg_max(manufacturer_id, (event_ts, manufacturer_id)) AS manufacturer_id "
    "FROM ev WHERE sensor_id IS NOT NULL AND manufacturer_id IS NOT NULL AND event_ts IS NOT NULL GROUP BY sensor_id)"
)
_UPSERTED = (
    "ups AS (SELECT sensor_id, manufacturer_id FROM s WHERE sensor_id NOT IN (SELECT sensor_id FROM obs) "
    "UNION ALL SELECT sensor_id, manufacturer_id FROM obs)"
)
_DIM_BASE = O.with_ctes(O.MANUFACTURERS_CTE, O.SENSORS_CTE, O.EVENTS_CTE, _OBSERVED, _UPSERTED)
ORACLE.update(
    {
        "dim_upsert": _DIM_BASE + "SELECT sensor_id, manufacturer_id FROM ups",
        "dim_fk_violations": _DIM_BASE
        + "SELECT sensor_id, manufacturer_id FROM ups WHERE manufacturer_id IS NOT NULL AND manufacturer_id NOT IN (SELECT id FROM m)",
        "dim_rules": _DIM_BASE
        + """SELECT 'sensors' AS "table", 'foreign_key' AS rule, 'manufacturer_id' AS "column", sensor_id AS "key", CAST(1 AS BIGINT) AS n
             FROM ups WHERE manufacturer_id IS NOT NULL AND manufacturer_id NOT IN (SELECT id FROM m)
             UNION ALL SELECT 'sensors', 'primary_key', 'sensor_id', sensor_id, count(*) FROM ups GROUP BY sensor_id HAVING count(*) > 1
             UNION ALL SELECT 'manufacturers', 'primary_key', 'id', CAST(id AS VARCHAR), count(*) FROM m GROUP BY id HAVING count(*) > 1
             UNION ALL SELECT 'manufacturers', 'unique', 'manufacturer_name', manufacturer_name, count(*) FROM m GROUP BY manufacturer_name HAVING count(*) > 1
             UNION ALL SELECT 'sensors', 'max_length_64', 'sensor_id', sensor_id, 1 FROM ups WHERE length(sensor_id) > 64""",
    }
)


def _dirty_dimensions(spark, sf_dir):
    """Dimensions that break every rule: rows derived from the events' users."""
    ids = table(spark, sf_dir, "events").select((F.col("user_id") % 40).alias("u")).distinct()
    u = F.col("u")
    makers = ids.where(u < 20).select(
        F.when(u == 3, F.lit(None)).otherwise(u % 15).cast("smallint").alias("id"),
        F.when(u == 4, F.lit(None)).when(u % 7 == 5, F.lit("same name")).when(u == 8, F.repeat(F.lit("n"), 129)).otherwise(F.concat(F.lit("maker "), u.cast("string"))).alias("manufacturer_name"),
        F.when(u == 6, F.lit(None)).when(u == 9, F.repeat(F.lit("c"), 65)).otherwise(F.lit("country")).alias("country"),
    )
    sensors = ids.select(
        F.when(u == 11, F.lit(None)).when(u == 12, F.repeat(F.lit("s"), 65)).otherwise(F.concat(F.lit("sensor "), (u % 36).cast("string"))).alias("sensor_id"),
        F.when(u == 13, F.lit(None)).otherwise(u % 25).cast("smallint").alias("manufacturer_id"),
    )
    return makers, sensors


def q_dim_rules_dirty(spark, sf_dir):
    from skein.operators.dimension import rule_report

    return rule_report(*_dirty_dimensions(spark, sf_dir))


REGISTRY["dim_rules_dirty"] = q_dim_rules_dirty
_DIRTY_DIMS = """WITH ids AS (SELECT DISTINCT user_id % 40 AS u FROM events),
m AS (SELECT CASE WHEN u = 3 THEN NULL ELSE CAST(u % 15 AS SMALLINT) END AS id,
        CASE WHEN u = 4 THEN NULL WHEN u % 7 = 5 THEN 'same name' WHEN u = 8 THEN repeat('n', 129) ELSE 'maker ' || u END AS manufacturer_name,
        CASE WHEN u = 6 THEN NULL WHEN u = 9 THEN repeat('c', 65) ELSE 'country' END AS country FROM ids WHERE u < 20),
s AS (SELECT CASE WHEN u = 11 THEN NULL WHEN u = 12 THEN repeat('s', 65) ELSE 'sensor ' || (u % 36) END AS sensor_id,
        CASE WHEN u = 13 THEN NULL ELSE CAST(u % 25 AS SMALLINT) END AS manufacturer_id FROM ids)
"""


def _rule(table_name, rule, column, key, rest, n="CAST(1 AS BIGINT)"):
    return f"""SELECT '{table_name}' AS "table", '{rule}' AS rule, '{column}' AS "column", CAST({key} AS VARCHAR) AS "key", {n} AS n FROM {rest}"""


ORACLE["dim_rules_dirty"] = _DIRTY_DIMS + " UNION ALL ".join(
    [
        _rule("manufacturers", "primary_key", "id", "id", "m GROUP BY id HAVING count(*) > 1", "count(*)"),
        _rule("sensors", "primary_key", "sensor_id", "sensor_id", "s GROUP BY sensor_id HAVING count(*) > 1", "count(*)"),
        _rule("manufacturers", "unique", "manufacturer_name", "manufacturer_name", "m WHERE manufacturer_name IS NOT NULL GROUP BY manufacturer_name HAVING count(*) > 1", "count(*)"),
        _rule("manufacturers", "not_null", "id", "manufacturer_name", "m WHERE id IS NULL"),
        _rule("manufacturers", "not_null", "manufacturer_name", "id", "m WHERE manufacturer_name IS NULL"),
        _rule("manufacturers", "not_null", "country", "id", "m WHERE country IS NULL"),
        _rule("sensors", "not_null", "sensor_id", "manufacturer_id", "s WHERE sensor_id IS NULL"),
        _rule("sensors", "not_null", "manufacturer_id", "sensor_id", "s WHERE manufacturer_id IS NULL"),
        _rule("sensors", "foreign_key", "manufacturer_id", "sensor_id", "s WHERE manufacturer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM m WHERE m.id = s.manufacturer_id)"),
        _rule("manufacturers", "max_length_128", "manufacturer_name", "id", "m WHERE length(manufacturer_name) > 128"),
        _rule("manufacturers", "max_length_64", "country", "id", "m WHERE length(country) > 64"),
        _rule("sensors", "max_length_64", "sensor_id", "sensor_id", "s WHERE length(sensor_id) > 64"),
    ]
)


# ---------------------------------------------------------------- results reader
def _published(spark, sf_dir, times: int = 1) -> dict[str, str]:
    """The four jobs' results, published as file topics (``times`` over, as an at-least-once writer may);
    the upsert topic holds a tombstone for every manufacturer 2 key as well."""
    from skein.config import OUTPUTS
    from skein.session import fresh_path
    from skein.streaming.sinks import changelog_rows, write_messages

    root = fresh_path(spark, "topics")
    ev = sensor_events(spark, sf_dir)
    # Each typed result table is written once; the topics derive from it.
    results(ev, manufacturers_seed(spark), DEFAULT).write.parquet(f"{root}/filtered")
    results(ev, manufacturers_seed(spark), DEFAULT.with_(quality_filter=False)).write.parquet(f"{root}/unfiltered")
    res, pure = spark.read.parquet(f"{root}/filtered"), spark.read.parquet(f"{root}/unfiltered")
    topics = {job: f"{root}/{topic}" for job, topic in OUTPUTS.items()}
    for _ in range(times):
        write_messages(res.select(result_json_col().alias("value")), path=topics["hybrid"])
        write_messages(res.select(result_json_col().alias("value")), path=topics["bridge"])
        write_messages(pure.select(result_json_col().alias("value")), path=topics["pure"])
        keyed = changelog_rows(res, 0)
        gone = keyed.where("manufacturer_id = 2").select("key", F.lit(None).cast("string").alias("value"))
        write_messages(keyed.select("key", "value").unionByName(gone), path=topics["table_upsert"])
    return {OUTPUTS[job]: path for job, path in topics.items()}


def q_message_numbers(spark, sf_dir):
    """The four outputs read back as a consumer, tombstones skipped, messages numbered per topic."""
    from skein.operators.results_reader import read_results

    return read_results(spark, _published(spark, sf_dir)).select("topic", "topic_message_number", "value")


def q_messages_deduped(spark, sf_dir):
    """Repeats of an at-least-once writer dropped by the results' natural key."""
    from skein.operators.results_reader import dedupe_results, read_topics
    from skein.schemas import UPSERT_KEY

    return dedupe_results(read_topics(spark, _published(spark, sf_dir, times=2)), UPSERT_KEY).select("topic", "value")


REGISTRY.update({"message_numbers": q_message_numbers, "messages_deduped": q_messages_deduped})

_THREE = "(VALUES ('iot_window_results'), ('iot_aggregates_upsert'), ('iot_window_results_table_sink')) AS t(topic)"
_PUBLISHED = (
    O.with_ctes(O.MANUFACTURERS_CTE, O.EVENTS_CTE, O.CLEAN_CTE, O.ENRICHED_CTE, _PURE_SRC)
    + f"SELECT topic, {O.RESULT_JSON} AS value, window_start, window_end, manufacturer_id FROM ({O.window_sql('1 minute')}), {_THREE}"
    + f" UNION ALL SELECT 'iot_window_results_datastream', {O.RESULT_JSON}, window_start, window_end, manufacturer_id FROM ({O.window_sql('1 minute', 'joined')})"
)
ORACLE["messages_deduped"] = f"SELECT topic, value FROM ({_PUBLISHED})"
ORACLE["message_numbers"] = (
    "SELECT topic, row_number() OVER (PARTITION BY topic ORDER BY window_start, window_end, CAST(manufacturer_id AS VARCHAR), value) AS topic_message_number, value"
    f" FROM ({_PUBLISHED})"
)


def q_stream_finalized(spark, sf_dir):
    """Bridge replay (closed windows) + the windows still open at its end, from the events of these."""
    from skein.streaming.jobs import finalize_bounded, first_open
    from skein.streaming.metrics import final_watermark

    running = _replayed(spark, sf_dir, "bridge", wire=False)
    since = first_open(spark, final_watermark(running.query), JOBS["bridge"])
    late = table(spark, sf_dir, "events").where(F.col("ts") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))
    emitted = spark.read.parquet(running.output)
    return finalize_bounded(spark, emitted, sensor_events_from_table(late), manufacturers_seed(spark), JOBS["bridge"])


def q_stream_finalized_state(spark, sf_dir):
    """Bridge replay + the windows still open at its end, from the stream's saved state: the source is not read again."""
    import os

    from skein.streaming.state import finalize_from_state

    running = _replayed(spark, sf_dir, "bridge", wire=False)
    checkpoint = f"{os.path.dirname(running.output)}/checkpoint"
    return finalize_from_state(spark, spark.read.parquet(running.output), checkpoint, manufacturers_seed(spark), JOBS["bridge"])


def q_upsert_levels(spark, sf_dir):
    """Replay of the table job in three batches of files, compacted in levels after each; what a reader then sees."""
    from skein.schemas import RESULT_COLUMNS
    from skein.session import default_parallelism, fresh_path
    from skein.sources.events import table_event_stream
    from skein.streaming.jobs import run_to_end, start_job
    from skein.streaming.levels import compact_levels, read_levels

    apply_engine_conf(spark)
    root = fresh_path(spark, "replay", "levels")
    events = table(spark, sf_dir, "events")
    for part in range(3):
        # The table's rows come in three deliveries; the stream resumes after each from its checkpoint.
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part).write.parquet(f"{root}/in/part={part}")
        running = run_to_end(
            start_job(
                spark, UPSERT_OPEN, events=table_event_stream(spark, f"{root}/in/part=*"), manufacturers=manufacturers_seed(spark),
                output=f"{root}/out", checkpoint=f"{root}/checkpoint", trigger="available_now", state_partitions=default_parallelism(spark),
            )
        )
        compact_levels(spark, running.output, fanout=2)
    return read_levels(spark, running.output).select(*RESULT_COLUMNS)


#: Every window stays open: deliveries out of order are all counted.
UPSERT_OPEN = EngineConfig(name="upsert_open", output="update", delay=None, window="1 hour")
REGISTRY.update({"stream_finalized": q_stream_finalized, "stream_finalized_state": q_stream_finalized_state, "upsert_levels": q_upsert_levels})
ORACLE["upsert_levels"] = O.BASE + O.window_sql("1 hour")
# Stated apart: what the watermark has closed, and what it has left open.
ORACLE["stream_finalized"] = (
    O.BASE + O.window_sql("1 minute", closed_by="enriched") + " UNION ALL " + O.window_sql("1 minute", closed_by="enriched", still_open=True)
)
ORACLE["stream_finalized_state"] = ORACLE["stream_finalized"]


# ---------------------------------------------------------------- a dimension that changes
#: What takes effect in the middle of the events' time: two new names, and a manufacturer unknown until then.
LATER_MANUFACTURERS = [(1, "Bosch Sensortec II", "Germany"), (3, "Honeywell II", "Canada"), (5, "Fifth Maker", "France")]


def manufacturer_versions(spark, sf_dir):
    """The seeded manufacturers since ever, and the later ones from an hour in the middle of the events' time, written as a version table."""
    from skein.operators.dimension import write_version
    from skein.operators.versions import dimension_versions

    middle = sensor_events(spark, sf_dir).agg(F.floor((F.unix_micros(F.min("event_ts")) + F.unix_micros(F.max("event_ts"))) / 2).alias("us"))
    rows = ", ".join(f"struct(CAST({i} AS SMALLINT) AS id, '{n}' AS manufacturer_name, '{c}' AS country)" for i, n, c in LATER_MANUFACTURERS)
    later = middle.selectExpr("date_trunc('hour', timestamp_micros(us)) AS valid_from", f"inline(array({rows}))")
    first = manufacturers_seed(spark).select("id", "manufacturer_name", "country", F.lit(None).cast("timestamp").alias("valid_from"))
    return write_version(spark, dimension_versions(first.unionByName(later.where("valid_from IS NOT NULL"))), "manufacturer_versions")


def q_window_versions(spark, sf_dir):
    """Daily results, each event under the manufacturer version of its time."""
    return results(sensor_events(spark, sf_dir), manufacturer_versions(spark, sf_dir), VERSIONED)


def q_stream_versions_closed(spark, sf_dir):
    """Replay of the bridge job over a dimension of which two versions exist."""
    return spark.read.parquet(_replayed(spark, sf_dir, VERSIONED, wire=False, manufacturers=manufacturer_versions(spark, sf_dir)).output)


VERSIONED = EngineConfig(name="versioned", dimension="versions", window="1 day")
REGISTRY.update({"window_1day_versions": q_window_versions, "stream_versions_closed": q_stream_versions_closed})
ORACLE["window_1day_versions"] = O.VERSIONED_BASE.format(later=", ".join(map(str, LATER_MANUFACTURERS))) + O.window_sql("1 day", "named")
ORACLE["stream_versions_closed"] = O.VERSIONED_BASE.format(later=", ".join(map(str, LATER_MANUFACTURERS))) + O.window_sql("1 day", "named", closed_by="named")


# ---------------------------------------------------------------- both outcomes of the quality rules
def q_stream_split(spark, sf_dir):
    """Replay of the dirty records: accepted and rejected events of one scan, read back from the sink's two sides."""
    from skein.session import fresh_path
    from skein.sources.events import decode_events, table_event_stream
    from skein.streaming.sinks import read_split, start_split

    apply_engine_conf(spark)
    raw = dirty_wire(table_event_stream(spark, f"{sf_dir.rstrip('/')}/events*.parquet", keep=["event_id"]))
    events = decode_events(raw, DEFAULT, keep=["event_id"]).select("event_id", "sensor_id", "manufacturer_id", "temperature", "humidity", "event_time", "event_ts")
    root = fresh_path(spark, "replay", "split")
    query = start_split(events, DEFAULT, path=f"{root}/out", checkpoint=f"{root}/checkpoint")
    query.awaitTermination()
    good, bad = (read_split(spark, f"{root}/out", events.schema, accepted) for accepted in (True, False))
    rows = good.withColumns({"outcome": F.lit("accepted"), "reason": F.lit(None).cast("string")}).unionByName(bad.withColumn("outcome", F.lit("rejected")))
    return rows.select("event_id", "outcome", "reason", "sensor_id", "manufacturer_id", "temperature", "humidity", _ts_text().alias("parsed_ts"))


REGISTRY["stream_split"] = q_stream_split
ORACLE["stream_split"] = O.DIRTY_BASE + (
    f"SELECT event_id, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS outcome, reason, sensor_id, manufacturer_id, temperature, humidity, parsed_ts"
    f" FROM (SELECT *, {_REJECT_REASON} AS reason, strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS parsed_ts FROM dirty)"
)
