"""Dimension versions, the split of accepted and rejected events, and late-row totals."""

import glob
import os

import pytest
from helpers import DAY, event, stage_files

from skein.config import EngineConfig
from skein.operators.versions import dimension_versions
from skein.plans.pipeline import results
from skein.plans.queries import VERSIONED
from skein.sources.dimensions import load_dimension
from skein.sources.events import decode_events, read_event_stream
from skein.streaming.jobs import run_to_end, start_job
from skein.streaming.metrics import LateRowTotals, dropped_late_rows
from skein.streaming.sinks import read_split, start_split

CFG = EngineConfig()
MINUTE = VERSIONED.with_(window="1 minute")


def versions(spark, rows):
    updates = spark.createDataFrame(rows, "id smallint, manufacturer_name string, country string, since string")
    return dimension_versions(updates.selectExpr("id", "manufacturer_name", "country", "CAST(since AS timestamp) AS valid_from"))


def decoded(spark, rows):
    import json

    return decode_events(spark.createDataFrame([(json.dumps(r),) for r in rows], "value string"), CFG)


ROWS = [event(1, "10:00:01"), event(1, "10:00:29.999999"), event(1, "10:00:30"), event(2, "10:00:10"), event(2, "10:00:40"), event(3, "10:00:05")]
DIM = [(1, "Old", "A", None), (1, "New", "B", f"{DAY} 10:00:30"), (2, "Late", "C", f"{DAY} 10:00:20"), (2, "Later", "D", f"{DAY} 11:00:00")]
WANT = [(1, "New", "B", 1), (1, "Old", "A", 2), (2, "Late", "C", 1)]


def summary(df):
    return sorted((r.manufacturer_id, r.manufacturer_name, r.country, r.events_count) for r in df.collect())


def test_event_takes_the_version_of_its_time(spark):
    assert summary(results(decoded(spark, ROWS), versions(spark, DIM), MINUTE)) == WANT


def test_versions_follow_one_another(spark):
    got = {(r.id, r.manufacturer_name): (str(r.valid_from), str(r.valid_to)) for r in versions(spark, DIM).collect()}
    assert got[(1, "Old")] == ("None", f"{DAY} 10:00:30") and got[(1, "New")] == (f"{DAY} 10:00:30", "None")
    assert got[(2, "Late")][1] == got[(2, "Later")][0]


def test_extra_columns_do_not_clash(spark):
    events = decoded(spark, ROWS).selectExpr("*", "'x' AS valid_from", "7 AS id", "1 AS valid_to")
    assert summary(results(events, versions(spark, DIM), MINUTE)) == WANT


def test_stream_equals_batch(spark, workdir):
    # Deliveries out of order: the version follows the event's time, not its arrival.
    folder = stage_files(f"{workdir}/in", [ROWS[2:4], ROWS[:2] + ROWS[4:], [event(1, "10:05:00")]])
    stream = read_event_stream(spark, {"path": folder, "max_files_per_trigger": 1}, CFG)
    cfg = MINUTE.with_(delay="1 minute")
    job = run_to_end(
        start_job(spark, cfg, events=stream, manufacturers=versions(spark, DIM), output=f"{workdir}/out", checkpoint=f"{workdir}/ck", trigger="available_now", state_partitions=2)
    )
    assert summary(spark.read.parquet(job.output)) == WANT


def test_versions_must_be_unique_and_append(spark):
    with pytest.raises(RuntimeError, match="occurs 2 times"):
        load_dimension(spark, versions(spark, [*DIM, DIM[1]]), "m", "versions", None, ["id", "valid_from"])
    with pytest.raises(ValueError, match="append"):
        EngineConfig(dimension="versions", output="update")


def run_split(spark, folder, workdir):
    events = read_event_stream(spark, {"path": folder, "max_files_per_trigger": 1}, CFG)
    query = start_split(events, CFG, path=f"{workdir}/out", checkpoint=f"{workdir}/ck")
    query.awaitTermination()
    return query, [sorted(map(str, read_split(spark, f"{workdir}/out", events.schema, side).collect())) for side in (True, False)]


def test_split_keeps_every_event_once_over_a_retry(spark, workdir):
    folder = stage_files(f"{workdir}/in", [[event(1, "10:00:01"), event(1, "10:00:02", temp=500.0), "broken"], [event(2, "10:00:03", hum=-1.0), event(2, "10:00:04")]])
    query, (good, bad) = run_split(spark, folder, workdir)
    assert (len(good), len(bad)) == (2, 3)
    assert sum("temperature_out_of_range" in r for r in bad) == 1 and sum("humidity_out_of_range" in r for r in bad) == 1
    # The last batch's commit is lost: it runs again on restart.
    commits = sorted(glob.glob(f"{workdir}/ck/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    for name in (commits[-1], os.path.join(os.path.dirname(commits[-1]), f".{os.path.basename(commits[-1])}.crc")):
        if os.path.exists(name):
            os.remove(name)
    again, outputs = run_split(spark, folder, workdir)
    assert [good, bad] == outputs and again.recentProgress


def test_split_scans_the_source_once(spark, workdir):
    folder = stage_files(f"{workdir}/in", [[event(1, "10:00:01"), "broken"]])
    query, _ = run_split(spark, folder, workdir)
    plan = query._jsq.explainInternal(False)
    assert plan.count("FileScan text") == 1 and "Exchange" not in plan


def late_run(spark, workdir, name, kept):
    """(the listener's total, the sum over the progress that Spark kept) of a stream with five late deliveries."""
    late = [[event(1, "12:00:00")]] + [[event(1, "10:00:01"), event(1, "10:00:02")] for _ in range(5)]
    folder = stage_files(f"{workdir}/in", late)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(kept))
    totals = LateRowTotals.attach(spark)
    try:
        stream = read_event_stream(spark, {"path": folder, "max_files_per_trigger": 1}, CFG)
        paths = {"output": f"{workdir}/{name}/out", "checkpoint": f"{workdir}/{name}/ck"}
        job = run_to_end(start_job(spark, MINUTE, events=stream, manufacturers=versions(spark, DIM), trigger="available_now", state_partitions=1, **paths))
        spark._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        return totals.total(job.query), dropped_late_rows(job.query)
    finally:
        spark.streams.removeListener(totals)
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_late_totals_outlive_the_kept_progress(spark, workdir):
    exact, whole = late_run(spark, workdir, "all", 100)
    assert exact == whole >= 4  # with all progress kept, both are whole
    again, part = late_run(spark, workdir, "few", 2)
    assert again == exact > part


def test_late_totals_count_a_batch_once():
    totals = LateRowTotals()
    for batch, rows in [(0, 3), (1, 0), (1, 4), (1, 4), (0, 3), (250, 2), (250, 0)]:
        totals.add("q", batch, rows)
    assert totals._seen["q"] == (9, 250, 2)
