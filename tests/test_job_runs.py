"""The four jobs end to end through start_job on staged JSON files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from helpers import dimension, event, stage_files
from skein.schemas import RESULT
from skein.streaming.jobs import run_to_end, start_job
from skein.streaming.sinks import compact, read_changelog

LIFECYCLE = [
    [event(1, "18:13:10"), event(1, "18:13:20", hum=60.0), event(2, "18:13:50"), event(9, "18:13:55")],
    [event(1, "18:14:09.999000")],
    [event(1, "18:13:30", hum=70.0)],
    [event(1, "18:14:10")],
    [event(1, "18:13:40")],
    [event(1, "18:16:00")],
]


def _raw(spark, folder):
    return spark.readStream.option("maxFilesPerTrigger", 1).text(folder)


def _start(spark, workdir, job, batches):
    folder = stage_files(os.path.join(workdir, "in"), batches)
    return run_to_end(
        start_job(
            spark, job, raw=_raw(spark, folder), manufacturers=dimension(spark),
            output=os.path.join(workdir, "out"), checkpoint=os.path.join(workdir, "ck"),
            trigger="available_now",
        )
    )


def _key(r):
    return (r.window_start[11:16], r.manufacturer_id, r.events_count, r.avg_temperature, r.median_humidity)


def test_table_upsert_job(spark, workdir):
    job = _start(spark, workdir, "table_upsert", LIFECYCLE)
    log = read_changelog(spark, job.output)
    versions = sorted((r.version, _key(r)) for r in log.collect())
    assert versions[0] == (0, ("18:13", 1, 2, 20.0, 55.0))
    latest = sorted(_key(r) for r in compact(log).collect())
    assert latest == [
        ("18:13", 1, 4, 20.0, 55.0),
        ("18:13", 2, 1, 20.0, 50.0),
        ("18:14", 1, 2, 20.0, 50.0),
        ("18:16", 1, 1, 20.0, 50.0),
    ]
    keys = {json.loads(r.key)["manufacturer_id"] for r in log.collect()}
    assert keys == {1, 2}


def test_table_upsert_prefix23_drops_time_without_fraction(spark, workdir):
    rows = [[event(1, "18:13:10"), {**event(1, "18:13:20"), "event_time": "2026-06-05T18:13:20+00:00"}]]
    job = _start(spark, workdir, "table_upsert", rows)
    assert [_key(r)[2] for r in compact(read_changelog(spark, job.output)).collect()] == [1]


def test_hybrid_json_and_bridge_rows(spark, workdir):
    hybrid = _start(spark, os.path.join(workdir, "h"), "hybrid", LIFECYCLE)
    bridge = _start(spark, os.path.join(workdir, "b"), "bridge", LIFECYCLE)
    parsed = spark.read.parquet(hybrid.output).select(F.from_json("value", RESULT).alias("r")).select("r.*")
    typed = spark.read.parquet(bridge.output)
    assert sorted(map(_key, parsed.collect())) == sorted(map(_key, typed.collect()))
    # watermark on enriched rows: unknown id 9 does not move event time, so
    # the 18:13 window closes one batch later but with the same content
    assert ("18:13", 1, 4, 20.0, 55.0) in sorted(map(_key, typed.collect()))


def test_pure_job_accepts_quoted_numbers(spark, workdir):
    rows = [[{**event(1, "18:13:10"), "temperature": "21.5"}, event(1, "18:20:00", temp=500.0)]]
    job = _start(spark, workdir, "pure", rows)
    got = [json.loads(r.value) for r in spark.read.parquet(job.output).collect()]
    assert [(g["events_count"], g["avg_temperature"]) for g in got] == [(1, 21.5)]


def test_pure_job_fails_on_malformed_record(spark, workdir):
    folder = stage_files(os.path.join(workdir, "in"), [[event(1, "18:13:10"), "{bad"]])
    job = start_job(
        spark, "pure", raw=_raw(spark, folder), manufacturers=dimension(spark),
        output=os.path.join(workdir, "out"), checkpoint=os.path.join(workdir, "ck"),
        trigger="available_now",
    )
    with pytest.raises(Exception):
        run_to_end(job)


def test_default_trigger_runs_continuously(spark, workdir):
    folder = stage_files(os.path.join(workdir, "in"), LIFECYCLE[:2])
    job = start_job(
        spark, "bridge", raw=_raw(spark, folder), manufacturers=dimension(spark),
        output=os.path.join(workdir, "out"), checkpoint=os.path.join(workdir, "ck"),
    )
    try:
        job.query.processAllAvailable()
        assert job.query.isActive
        assert job.query.lastProgress["batchId"] >= 1
    finally:
        job.query.stop()


def test_pure_job_survives_extreme_values(spark, workdir):
    """No range filter in the pure job: an absurd but valid reading is
    aggregated (float arithmetic) instead of failing the stream."""
    rows = [[event(1, "18:13:10", temp=1e300), event(1, "18:13:20", temp=20.0), event(1, "18:20:00")]]
    job = _start(spark, workdir, "pure", rows)
    got = [json.loads(r.value) for r in spark.read.parquet(job.output).collect()]
    assert len(got) == 1 and got[0]["events_count"] == 2
    assert got[0]["avg_temperature"] > 1e299


def test_compaction_job_keeps_the_latest_rows(spark, workdir):
    from skein.streaming.sinks import compact_output, read_current

    job = _start(spark, workdir, "table_upsert", LIFECYCLE[:4])
    want = sorted(_key(r) for r in compact(read_changelog(spark, job.output)).collect())
    versions = len([d for d in os.listdir(job.output) if d.startswith("version=")])
    got = compact_output(spark, job.output)
    assert sorted(_key(r) for r in got.collect()) == want and versions > 1
    assert not [d for d in os.listdir(job.output) if d.startswith("version=")]
    # A second run without new versions changes nothing; new versions count on top of the base.
    assert sorted(_key(r) for r in compact_output(spark, job.output).collect()) == want
    row = got.where("manufacturer_id = 1").first()
    newer = spark.createDataFrame([row], got.schema).withColumn("events_count", F.lit(99).cast("long"))
    newer.drop("version").write.parquet(f"{job.output}/version=1000")
    after = {(r.window_start, r.manufacturer_id): r.events_count for r in read_current(spark, job.output).collect()}
    assert after[(row.window_start, 1)] == 99 and len(after) == len(want)
    assert {(r.window_start, r.manufacturer_id): r.events_count for r in compact_output(spark, job.output).collect()} == after
    assert os.listdir(f"{job.output}_bases") == ["upto=1000"]


def test_late_rows_stay_dropped_when_finalized(spark, workdir):
    from skein.config import JOBS
    from skein.sources.events import read_event_batch
    from skein.streaming.jobs import finalize_bounded, first_open
    from skein.streaming.metrics import final_watermark

    batches = [[event(1, "18:20:00")], [event(1, "18:20:01")], [event(1, "18:13:10")], [event(1, "18:20:30")]]
    job = _start(spark, workdir, "bridge", batches)
    cfg = JOBS["bridge"]
    since = first_open(spark, final_watermark(job.query), cfg)
    assert since.strftime("%H:%M:%S") == "18:20:00"
    events = read_event_batch(spark, os.path.join(workdir, "in"), cfg)
    late = events.where(F.col("event_ts") >= F.lit(since))
    got = finalize_bounded(spark, spark.read.schema(RESULT).parquet(job.output), late, dimension(spark), cfg)
    assert [(r.window_start[11:16], r.events_count) for r in got.collect()] == [("18:20", 3)]


def test_refreshed_dimension_keeps_counted_windows(spark, workdir):
    """A manufacturer that leaves the dimension between counting and closing leaves its window without a name."""
    from skein.config import EngineConfig
    from skein.plans.pipeline import results
    from skein.sources.events import read_event_batch

    folder = stage_files(os.path.join(workdir, "in"), [[event(1, "18:13:10"), event(2, "18:13:20")]])
    cfg = EngineConfig(dimension="refresh")
    events = read_event_batch(spark, folder, cfg)
    got = results(events, dimension(spark), cfg)
    join = [p for p in got._jdf.queryExecution().analyzed().toString().split("\n") if "LeftOuter" in p]
    assert join and got.count() == 2
