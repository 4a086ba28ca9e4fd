"""Levelled compaction, and windows finished from the saved state."""

import os
import random

import pytest
from pyspark.sql import functions as F

from helpers import dimension, event, stage_files
from skein.streaming.levels import _manifest, compact_levels, read_levels
from skein.streaming.sinks import CHANGELOG


def write_version(spark, path, version, groups):
    """A changelog folder: {(window, manufacturer): count}."""
    rows = [(f"{w}|{m}", "{}", f"2026-06-05 18:{w:02d}:00.000", f"2026-06-05 18:{w + 1:02d}:00.000", m, "n", "c", n, 1.0, 2.0, version) for (w, m), n in groups.items()]
    df = spark.createDataFrame(rows, CHANGELOG).drop("version")
    df.coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")


def seen(df):
    return {(int(r.window_start[14:16]), r.manufacturer_id): r.events_count for r in df.collect()}


def run_bytes(path, run):
    folder = f"{path}_runs/run={run}"
    return sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".parquet"))


def test_latest_rows_after_any_compactions(spark, workdir):
    rng, path, want = random.Random(3), f"{workdir}/out", {}
    for version in range(14):
        groups = {(rng.randint(0, 9), rng.randint(1, 4)): 100 * version + i for i in range(rng.randint(1, 8))}
        write_version(spark, path, version, groups)
        want.update(groups)
        if rng.random() < 0.6:
            compact_levels(spark, path, fanout=2, grace=rng.randint(0, 2))
        assert seen(read_levels(spark, path)) == want
    compact_levels(spark, path, fanout=2, grace=0)
    assert seen(read_levels(spark, path)) == want
    assert compact_levels(spark, path) is None  # nothing new
    live = [r.run for r in _manifest(spark, path)[max(_manifest(spark, path))]]
    assert sorted(f"run={r}" for r in live) == sorted(os.listdir(f"{path}_runs"))
    assert not [f for f in os.listdir(path) if f.startswith("version=")]


def test_written_bytes_follow_the_new_versions(spark, workdir):
    path = f"{workdir}/out"
    big = {(w, m): w * m for w in range(58) for m in range(1, 400)}
    write_version(spark, path, 0, big)
    base = run_bytes(path, compact_levels(spark, path, fanout=4, grace=0))
    small = []
    for version in range(1, 4):
        write_version(spark, path, version, {(1, 1): version})
        small.append(compact_levels(spark, path, fanout=5, grace=9))
    assert len(small) == 3 and all(run_bytes(path, r) < base / 3 for r in small)
    assert seen(read_levels(spark, path)) == {**big, (1, 1): 3}


def test_reader_keeps_its_files_for_the_grace(spark, workdir):
    path = f"{workdir}/out"
    write_version(spark, path, 0, {(1, 1): 1, (2, 2): 2})
    reader_of_versions = read_levels(spark, path)
    compact_levels(spark, path, fanout=2)
    write_version(spark, path, 1, {(1, 1): 10})
    reader_of_runs = read_levels(spark, path)
    # While a compaction merges the runs that the second reader has planned:
    merged = compact_levels(spark, path, fanout=2)
    assert [r.run for r in _manifest(spark, path)[1]] == [merged]
    assert seen(reader_of_runs) == {(1, 1): 10, (2, 2): 2}
    write_version(spark, path, 2, {(3, 3): 3})
    compact_levels(spark, path, fanout=2)
    # The first reader's version is gone by now (two generations later), the newest state is whole.
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|FileNotFound"):
        reader_of_versions.collect()
    assert seen(read_levels(spark, path)) == {(1, 1): 10, (2, 2): 2, (3, 3): 3}


def test_incomplete_versions_and_failed_compactions(spark, workdir, monkeypatch):
    import skein.streaming.levels as L

    path = f"{workdir}/out"
    write_version(spark, path, 0, {(1, 1): 1})
    os.makedirs(f"{path}/version=1")  # being written
    before = seen(read_levels(spark, path))
    with monkeypatch.context() as m:
        m.setattr(L, "_retire", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            compact_levels(spark, path)
    assert seen(read_levels(spark, path)) == before == {(1, 1): 1}
    write_version(spark, path, 1, {(1, 1): 2})
    assert seen(read_levels(spark, path)) == {(1, 1): 2}
    compact_levels(spark, path)
    assert seen(read_levels(spark, path)) == {(1, 1): 2}
    with pytest.raises(ValueError):
        compact_levels(spark, path, fanout=1)


def test_empty_output(spark, workdir):
    assert read_levels(spark, f"{workdir}/none").count() == 0
    assert compact_levels(spark, f"{workdir}/none") is None


def test_late_rows_stay_dropped_when_finished_from_the_state(spark, workdir):
    from skein.config import JOBS
    from skein.schemas import RESULT
    from skein.streaming.jobs import run_to_end, start_job
    from skein.streaming.state import finalize_from_state, open_cells

    batches = [[event(1, "18:20:00")], [event(1, "18:20:01", temp=500.0), event(9, "18:20:02")], [event(1, "18:13:10")], [event(1, "18:20:30", hum=60.0)]]
    folder = stage_files(os.path.join(workdir, "in"), batches)
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(folder)
    run_to_end(start_job(spark, "bridge", raw=raw, manufacturers=dimension(spark), output=f"{workdir}/out", checkpoint=f"{workdir}/ck", trigger="available_now"))
    emitted = spark.read.schema(RESULT).parquet(f"{workdir}/out")
    got = finalize_from_state(spark, emitted, f"{workdir}/ck", dimension(spark), JOBS["bridge"])
    assert [(r.window_start[11:16], r.manufacturer_id, r.events_count, r.median_humidity) for r in got.collect()] == [("18:20", 1, 2, 55.0)]
    assert open_cells(spark, f"{workdir}/ck").agg(F.sum("n")).first()[0] == 2
    # As it was after the first batch.
    assert open_cells(spark, f"{workdir}/ck", batch_id=0).agg(F.sum("n")).first()[0] == 1


def test_finishing_from_the_state_reads_no_source(spark, workdir):
    from test_plans import plan_text
    from skein.config import JOBS
    from skein.schemas import RESULT
    from skein.streaming.jobs import run_to_end, start_job
    from skein.streaming.state import finalize_from_state

    folder = stage_files(os.path.join(workdir, "in"), [[event(1, "18:20:00")]])
    run_to_end(start_job(spark, "bridge", raw=spark.readStream.text(folder), manufacturers=dimension(spark), output=f"{workdir}/out", checkpoint=f"{workdir}/ck", trigger="available_now"))
    df = finalize_from_state(spark, spark.read.schema(RESULT).parquet(f"{workdir}/out"), f"{workdir}/ck", dimension(spark), JOBS["bridge"])
    text = plan_text(df)
    assert folder not in text and df.count() == 1
