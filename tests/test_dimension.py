"""Dimension upsert cases, integrity rules, empty-dimension check, snapshot pin."""

import pytest

from skein.operators.dimension import rule_report, upsert_dimension
from skein.schemas import MANUFACTURERS, SENSORS
from skein.sources.dimensions import (
    MANUFACTURER_ROWS,
    load_dimension,
    manufacturers_seed,
    require_non_empty,
    sensors_seed,
)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_update_insert_rerun(spark):
    base = manufacturers_seed(spark)
    updates = spark.createDataFrame(
        [(2, "Sensirion", "Schweiz", "new country"), (5, "Acme", "Nowhere", None)], MANUFACTURERS
    )
    once = upsert_dimension(base, updates, ["id"])
    got = {r.id: (r.manufacturer_name, r.country) for r in once.collect()}
    assert got[2] == ("Sensirion", "Schweiz")
    assert got[5] == ("Acme", "Nowhere")
    assert got[1] == ("Bosch Sensortec", "Germany")
    assert len(got) == 5
    twice = upsert_dimension(once, updates, ["id"])
    assert _rows(twice) == _rows(once)


def test_rule_violations(spark):
    mans = spark.createDataFrame(
        [r for r in MANUFACTURER_ROWS]
        + [(1, "Dup Id", "X", None), (6, None, "Y", None), (7, "Sensirion", "Z", None), (8, "N" * 129, "W", None)],
        MANUFACTURERS,
    )
    sensors = spark.createDataFrame(
        [("sensor-001", 1), ("sensor-001", 2), ("sensor-x", 9), ("s" * 65, 1)], SENSORS
    )
    got = {(r.table, r.rule, r.column, r.key) for r in rule_report(mans, sensors).collect()}
    assert ("manufacturers", "primary_key", "id", "1") in got
    assert ("manufacturers", "not_null", "manufacturer_name", "6") in got
    assert ("manufacturers", "unique", "manufacturer_name", "Sensirion") in got
    assert ("manufacturers", "max_length_128", "manufacturer_name", "8") in got
    assert ("sensors", "primary_key", "sensor_id", "sensor-001") in got
    assert ("sensors", "foreign_key", "manufacturer_id", "sensor-x") in got
    assert ("sensors", "max_length_64", "sensor_id", "s" * 65) in got


def test_clean_seed_has_no_violations(spark):
    assert rule_report(manufacturers_seed(spark), sensors_seed(spark)).count() == 0


def test_empty_dimension_raises(spark):
    empty = spark.createDataFrame([], MANUFACTURERS)
    with pytest.raises(RuntimeError):
        require_non_empty(empty, "manufacturers")
    with pytest.raises(RuntimeError):
        load_dimension(spark, empty, "manufacturers")


def test_snapshot_is_pinned(spark, workdir):
    src = f"{workdir}/dim"
    manufacturers_seed(spark).write.parquet(src)
    snap = load_dimension(spark, spark.read.parquet(src), "manufacturers", "snapshot", ["id", "country"])
    spark.createDataFrame([(9, "Other", "Q", None)], MANUFACTURERS).write.mode("overwrite").parquet(src)
    assert sorted(r.id for r in snap.collect()) == [1, 2, 3, 4]


def test_latest_per_key_ties_and_old_times(spark):
    import datetime as dt

    from skein.operators.dimension import latest_per_key

    t = dt.datetime(2026, 6, 5, 18, 13, 42, 123456)
    old = dt.datetime(1960, 1, 1, 0, 0, 0, 1)
    rows = [
        ("a", 1, t), ("a", 3, t), ("a", 2, t - dt.timedelta(seconds=1)),   # tie at t -> larger value 3
        ("b", -5, old), ("b", 7, old - dt.timedelta(microseconds=1)),      # pre-1970, negative id
        ("c", 4, None), ("c", 2, old),                                    # no time -> skipped
    ]
    df = spark.createDataFrame(rows, "sensor_id string, manufacturer_id short, event_ts timestamp")
    got = {r.sensor_id: r.manufacturer_id for r in latest_per_key(df, "sensor_id", "manufacturer_id", "event_ts").collect()}
    assert got == {"a": 3, "b": -5, "c": 2}


def test_duplicate_ids_fail_early(spark):
    twice = spark.createDataFrame([(1, "a", "x", None), (1, "b", "y", None)], MANUFACTURERS)
    for mode in ("snapshot", "refresh"):
        with pytest.raises(RuntimeError, match="occurs 2 times"):
            load_dimension(spark, twice, "manufacturers", mode)


def test_no_descriptions_in_the_seed(spark):
    assert manufacturers_seed(spark).where("description is not null").count() == 0
