"""Property test: batch window results equal an exact brute force."""

import datetime as dt
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import dimension
from skein.config import EngineConfig
from skein.plans.pipeline import results

BASE = dt.datetime(2026, 6, 5, 18, 0, 0)

event_rows = st.lists(
    st.tuples(
        st.integers(min_value=1, max_value=3),                   # manufacturer (3 unknown)
        st.integers(min_value=0, max_value=3 * 60 * 1000 - 1),  # millis into 3 minutes
        st.integers(min_value=-5001, max_value=8001),            # temperature cents
        st.integers(min_value=-1, max_value=10001),              # humidity cents
    ),
    min_size=1,
    max_size=60,
)


def half_up(x: Fraction) -> int:
    """Round to integer, ties away from zero."""
    sign = -1 if x < 0 else 1
    a = abs(x)
    whole = a.numerator // a.denominator
    if a - whole >= Fraction(1, 2):
        whole += 1
    return sign * whole


def brute_force(rows):
    groups = {}
    for mid, ms, tc, hc in rows:
        if mid not in (1, 2) or not (-5000 <= tc <= 8000) or not (0 <= hc <= 10000):
            continue
        ts = BASE + dt.timedelta(milliseconds=ms)
        key = (ts.replace(second=0, microsecond=0).strftime("%Y-%m-%d %H:%M:%S.000"), mid)
        groups.setdefault(key, []).append((tc, hc))
    out = {}
    for key, vals in groups.items():
        n = len(vals)
        hs = sorted(h for _, h in vals)
        mean = half_up(Fraction(sum(t for t, _ in vals), n)) / 100.0
        median = half_up(Fraction(hs[(n - 1) // 2] + hs[n // 2], 2)) / 100.0
        out[key] = (n, mean, median)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=event_rows)
def test_window_results_match_brute_force(spark, rows):
    data = [
        ("sensor-001", mid, f"t{ms}", BASE + dt.timedelta(milliseconds=ms), tc / 100.0, hc / 100.0)
        for mid, ms, tc, hc in rows
    ]
    df = spark.createDataFrame(
        data,
        "sensor_id string, manufacturer_id short, event_time string, event_ts timestamp, "
        "temperature double, humidity double",
    )
    got = {
        (r.window_start, r.manufacturer_id): (r.events_count, r.avg_temperature, r.median_humidity)
        for r in results(df, dimension(spark), EngineConfig()).collect()
    }
    assert got == brute_force(rows)


def test_hot_manufacturer_matches_brute_force(spark):
    """~90% of rows on one manufacturer, spread over many input partitions."""
    from pyspark.sql import functions as F

    n = F.col("id")
    ev = spark.range(0, 6000, 1, 12).select(
        F.format_string("sensor-%03d", n % 20).alias("sensor_id"),
        F.when(n % 10 == 9, 2).otherwise(1).cast("short").alias("manufacturer_id"),
        F.lit("t").alias("event_time"),
        F.timestamp_micros(F.lit(1780682400000000) + (n * 7919 % 6000) * 500000).alias("event_ts"),
        ((F.xxhash64(n) % 6000) / 100.0).alias("temperature"),
        (F.pmod(F.xxhash64(n, F.lit(1)), F.lit(10300)) / 100.0).alias("humidity"),
    )
    cfg = EngineConfig(window="10 minutes")
    got = {
        (r.window_start, r.manufacturer_id): (r.events_count, r.avg_temperature, r.median_humidity)
        for r in results(ev, dimension(spark), cfg).collect()
    }
    rows = ev.select(
        "manufacturer_id", F.unix_micros("event_ts").alias("us"),
        F.round(F.col("temperature") * 100).cast("long").alias("tc"),
        F.round(F.col("humidity") * 100).cast("long").alias("hc"),
    ).collect()
    groups = {}
    for r in rows:
        if not (-5000 <= r.tc <= 8000) or not (0 <= r.hc <= 10000):
            continue
        start = r.us // 600_000_000 * 600
        key = (dt.datetime.fromtimestamp(start, dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.000"), r.manufacturer_id)
        groups.setdefault(key, []).append((r.tc, r.hc))
    want = {}
    for key, vals in groups.items():
        n = len(vals)
        hs = sorted(h for _, h in vals)
        want[key] = (
            n,
            half_up(Fraction(sum(t for t, _ in vals), n)) / 100.0,
            half_up(Fraction(hs[(n - 1) // 2] + hs[n // 2], 2)) / 100.0,
        )
    assert got == want
    hot = sum(v[0] for k, v in want.items() if k[1] == 1)
    assert hot > 0.85 * sum(v[0] for v in want.values())
