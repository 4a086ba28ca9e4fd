"""Expression cases: time parsing, decoding, filter bounds, median, rounding, JSON."""

import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from py4j.protocol import Py4JJavaError

from skein.config import EngineConfig
from skein.functions.jsonfmt import result_json
from skein.functions.rounding import binary_half_even
from skein.functions.timefmt import event_time_wire, event_ts, window_text
from skein.operators.quality import clean, rejects
from skein.sources.events import decode_events

TS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _parse(spark, texts, mode, strict=False):
    df = spark.createDataFrame([(t,) for t in texts], "event_time string")
    return [r[0] for r in df.select(F.date_format(event_ts("event_time", mode, strict), TS)).collect()]


def test_time_iso_and_prefix23(spark):
    texts = [
        "2026-06-05T18:13:42.123456+00:00",
        "2026-06-05T18:13:42+00:00",
        "2026-06-05T18:13:42.123456+03:00",
        "2026-06-05T18:13:42",
        "junk",
    ]
    assert _parse(spark, texts, "iso") == [
        "2026-06-05 18:13:42.123456",
        "2026-06-05 18:13:42.000000",
        "2026-06-05 15:13:42.123456",
        "2026-06-05 18:13:42.000000",
        None,
    ]
    assert _parse(spark, texts, "prefix23") == [
        "2026-06-05 18:13:42.123000",
        None,
        "2026-06-05 18:13:42.123000",
        "2026-06-05 18:13:42.000000",
        None,
    ]


def test_time_strict_raises_on_junk(spark):
    with pytest.raises((PySparkException, Py4JJavaError)):
        _parse(spark, ["junk"], "iso", strict=True)


def test_wire_time_and_window_text(spark):
    df = spark.createDataFrame([(dt.datetime(2026, 6, 5, 18, 13, 42, 123456),)], "ts timestamp")
    row = df.select(event_time_wire("ts"), window_text(F.date_trunc("minute", "ts"))).first()
    assert row[0] == "2026-06-05T18:13:42.123456+00:00"
    assert row[1] == "2026-06-05 18:13:00.000"


# Fixed value: the documented sample record.
GOOD = '{"sensor_id":"sensor-001","manufacturer_id":1,"event_time":"2026-06-05T18:13:42.123456+00:00","temperature":22.4,"humidity":55.1}'


def _variant(**changes):
    d = json.loads(GOOD)
    for k, v in changes.items():
        if v is KeyError:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


LENIENT_CASES = [
    ("{bad", None),
    ("[1,2]", None),
    (_variant(manufacturer_id=99999), "null_manufacturer_id"),
    (_variant(manufacturer_id="x"), "null_manufacturer_id"),
    (_variant(temperature="warm"), "null_temperature"),
    (_variant(manufacturer_id=1.9), "null_manufacturer_id"),
    (_variant(manufacturer_id="1.9"), "null_manufacturer_id"),
    (_variant(humidity=KeyError), "null_humidity"),
    (_variant(sensor_id=None), "null_sensor_id"),
]


def test_both_decoders_read_quoted_numbers(spark):
    raw = spark.createDataFrame([(_variant(temperature="22.5", manufacturer_id="1", humidity="55"),)], "value string")
    for mode in ("lenient", "strict"):
        r = decode_events(raw, EngineConfig(decode=mode)).first()
        assert (r.temperature, r.manufacturer_id, r.humidity) == (22.5, 1, 55.0)


@pytest.mark.parametrize("text,reason", LENIENT_CASES)
def test_lenient_decode_rejects(spark, text, reason):
    cfg = EngineConfig()
    raw = spark.createDataFrame([(text,)], "value string")
    dec = decode_events(raw, cfg)
    assert clean(dec, cfg).count() == 0
    got = [r.reason for r in rejects(dec, cfg).collect()]
    assert got == [reason or "null_sensor_id"]


def test_lenient_decode_accepts(spark):
    cfg = EngineConfig()
    raw = spark.createDataFrame(
        [(GOOD,), (_variant(temperature=22),), (_variant(sensor_id=7),)], "value string"
    )
    rows = clean(decode_events(raw, cfg), cfg).orderBy("sensor_id").collect()
    assert [(r.sensor_id, r.manufacturer_id, r.temperature) for r in rows] == [
        ("7", 1, 22.4),
        ("sensor-001", 1, 22.4),
        ("sensor-001", 1, 22.0),
    ]


STRICT_FAIL = [
    "{bad",
    "[1,2]",
    _variant(manufacturer_id=99999),
    _variant(manufacturer_id="x"),
    _variant(humidity=KeyError),
    _variant(sensor_id=None),
    _variant(manufacturer_id=1.9),
    _variant(event_time="junk"),
]


@pytest.mark.parametrize("text", STRICT_FAIL)
def test_strict_decode_raises(spark, text):
    raw = spark.createDataFrame([(text,)], "value string")
    with pytest.raises((PySparkException, Py4JJavaError)):
        decode_events(raw, EngineConfig(decode="strict")).collect()


def test_strict_decode_accepts_text_numbers(spark):
    raw = spark.createDataFrame(
        [(_variant(temperature="22.5"),), (_variant(manufacturer_id="1"),), (_variant(sensor_id=7),)],
        "value string",
    )
    rows = decode_events(raw, EngineConfig(decode="strict")).collect()
    assert [(r.sensor_id, r.manufacturer_id, r.temperature) for r in rows] == [
        ("sensor-001", 1, 22.5),
        ("sensor-001", 1, 22.4),
        ("7", 1, 22.4),
    ]


def test_filter_boundaries(spark):
    cfg = EngineConfig()
    ts = dt.datetime(2026, 6, 5, 18, 13)
    rows = [
        ("s", 1, "t", ts, -50.0, 0.0),
        ("s", 1, "t", ts, 80.0, 100.0),
        ("s", 1, "t", ts, -50.01, 50.0),
        ("s", 1, "t", ts, 80.01, 50.0),
        ("s", 1, "t", ts, 20.0, -0.01),
        ("s", 1, "t", ts, 20.0, 100.01),
        (None, 1, "t", ts, 20.0, 50.0),
        ("s", None, "t", ts, 20.0, 50.0),
        ("s", 1, None, ts, 20.0, 50.0),
        ("s", 1, "t", None, 20.0, 50.0),
        ("s", 1, "t", ts, None, 50.0),
        ("s", 1, "t", ts, 20.0, None),
    ]
    df = spark.createDataFrame(
        rows,
        "sensor_id string, manufacturer_id short, event_time string, event_ts timestamp, temperature double, humidity double",
    )
    assert clean(df, cfg).count() == 2
    reasons = sorted(r.reason for r in rejects(df, cfg).collect())
    assert reasons == sorted(
        [
            "temperature_out_of_range",
            "temperature_out_of_range",
            "humidity_out_of_range",
            "humidity_out_of_range",
            "null_sensor_id",
            "null_manufacturer_id",
            "null_event_time",
            "null_event_ts",
            "null_temperature",
            "null_humidity",
        ]
    )
    assert clean(df, cfg).count() + rejects(df, cfg).count() == len(rows)


def _one_window(spark, temperatures, humidities, rounding="half_up"):
    """Mean and median of one group through the engine's aggregate, both routes."""
    from skein.operators.windows import window_aggregate
    from skein.plans.sql_route import window_results_sql

    rows = [(dt.datetime(2026, 6, 5, 18, 13, 1), 1, "m", "c", t, h) for t, h in zip(temperatures, humidities)]
    df = spark.createDataFrame(rows, "event_ts timestamp, manufacturer_id short, manufacturer_name string, country string, temperature double, humidity double")
    cfg = EngineConfig(rounding=rounding)
    r = window_aggregate(df, cfg).first()
    if rounding == "half_up":
        df.createOrReplaceTempView("one_window")
        for chained in (True, False):
            q = spark.sql(window_results_sql(cfg, "one_window", chained)).first()
            assert (q.avg_temperature, q.median_humidity) == (r.avg_temperature, r.median_humidity)
    return r.avg_temperature, r.median_humidity


@pytest.mark.parametrize(
    "values,expected",
    [
        ([5.0], 5.0), ([3.0, 1.0, 2.0], 2.0), ([1.0, 2.0, 4.0, 10.0], 3.0), ([54.91, 54.92, 54.93, 54.94], 54.93),
        ([0.006, 0.006, 0.001, 0.001], 0.0), ([0.01, 0.02], 0.02), ([12.3449, 12.3451], 12.35), ([12.3449], 12.34),
    ],
)
def test_median(spark, values, expected):
    assert _one_window(spark, [1.0] * len(values), values)[1] == expected


@pytest.mark.parametrize(
    "values,expected",
    [
        ([0.01, 0.02], 0.02), ([-0.01, -0.02], -0.02), ([22.4, 22.2, 22.33], 22.31),
        # rounded once at the end: the readings' further decimals count
        ([0.006, 0.006, 0.001, 0.001], 0.0), ([0.0049, 0.0049, 0.0049], 0.0), ([1.004999, 1.005001], 1.01), ([1e17, 1e17], 1e17),
    ],
)
def test_mean_half_up(spark, values, expected):
    assert _one_window(spark, values, [1.0] * len(values))[0] == expected


def test_mean_of_absurd_readings(spark):
    """Beyond the exact range the plain sum is taken; nothing fails."""
    assert _one_window(spark, [1e300, 3e300], [1.0, 1e200])[0] == 2e300


def test_half_even_mode_uses_the_readings(spark):
    assert _one_window(spark, [0.006, 0.006, 0.001, 0.001], [0.006, 0.006, 0.001, 0.001], "binary_half_even") == (0.0, 0.0)
    assert _one_window(spark, [2.67, 2.68], [1.0, 1.01], "binary_half_even") == (round(2.675, 2), round(1.005, 2))


def test_binary_half_even_matches_python(spark):
    values = [2.675, 1.005, 0.125, 2.665, 0.145, 1.115, -0.125, 50.625, 22.305]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(binary_half_even("v")).collect()]
    assert got == [round(v, 2) for v in values]


def test_result_json_shape(spark):
    row = ("2026-06-05 18:13:00.000", "2026-06-05 18:14:00.000", 2, "Sensirion", "Zürich", 20, 22.31, None)
    df = spark.createDataFrame(
        [row],
        "window_start string, window_end string, manufacturer_id short, manufacturer_name string, "
        "country string, events_count long, avg_temperature double, median_humidity double",
    )
    text = df.select(result_json()).first()[0]
    assert text == (
        '{"window_start":"2026-06-05 18:13:00.000","window_end":"2026-06-05 18:14:00.000",'
        '"manufacturer_id":2,"manufacturer_name":"Sensirion","country":"Zürich","events_count":20,'
        '"avg_temperature":22.31,"median_humidity":null}'
    )


@pytest.mark.parametrize("text", STRICT_FAIL)
def test_strict_decode_raises_without_ansi(spark, text):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        raw = spark.createDataFrame([(text,)], "value string")
        with pytest.raises((PySparkException, Py4JJavaError)):
            decode_events(raw, EngineConfig(decode="strict")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
