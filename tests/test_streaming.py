"""Staged micro-batch fixtures: window life cycle, late rows, watermark placement."""

import os


from helpers import collect_batches, dimension, event, stage_files
from skein.config import EngineConfig
from skein.plans.pipeline import results
from skein.sources.events import read_event_stream
from skein.streaming.metrics import batch_progress, dropped_late_rows

LIFECYCLE = [
    [event(1, "18:13:10"), event(1, "18:13:20", hum=60.0), event(2, "18:13:50"), event(9, "18:13:55")],
    [event(1, "18:14:09.999000")],
    [event(1, "18:13:30", hum=70.0)],
    [event(1, "18:14:10")],
    [event(1, "18:13:40")],
    [event(1, "18:16:00")],
]
SOURCE_WM = EngineConfig(watermark_at="source", quality_filter=False)


def _stream(spark, folder, cfg):
    return read_event_stream(spark, {"kind": "files", "path": folder, "max_files_per_trigger": 1}, cfg)


def test_append_window_lifecycle(spark, workdir):
    folder = stage_files(os.path.join(workdir, "in"), LIFECYCLE)
    res = results(_stream(spark, folder, SOURCE_WM), dimension(spark), SOURCE_WM)
    q, seen = collect_batches(res, os.path.join(workdir, "ck"))
    emitted = {b: rows for b, rows in seen.items() if rows}
    assert emitted == {
        4: [("18:13", 1, 4, 20.0, 55.0), ("18:13", 2, 1, 20.0, 50.0)],
        6: [("18:14", 1, 2, 20.0, 50.0)],
    }
    wms = [b["watermark"] for b in batch_progress(q)]
    assert wms[1].startswith("2026-06-05T18:13:45")
    assert wms[4].startswith("2026-06-05T18:14:00.000")
    assert wms[6].startswith("2026-06-05T18:15:50")


def test_update_changelog_lifecycle(spark, workdir):
    folder = stage_files(os.path.join(workdir, "in"), LIFECYCLE)
    cfg = SOURCE_WM.with_(output="update")
    res = results(_stream(spark, folder, cfg), dimension(spark), cfg)
    _, seen = collect_batches(res, os.path.join(workdir, "ck"), "update")
    emitted = {b: rows for b, rows in seen.items() if rows}
    assert emitted == {
        0: [("18:13", 1, 2, 20.0, 55.0), ("18:13", 2, 1, 20.0, 50.0)],
        1: [("18:14", 1, 1, 20.0, 50.0)],
        2: [("18:13", 1, 3, 20.0, 60.0)],
        3: [("18:14", 1, 2, 20.0, 50.0)],
        4: [("18:13", 1, 4, 20.0, 55.0)],
        5: [("18:16", 1, 1, 20.0, 50.0)],
    }


def test_late_rows_dropped_and_counted(spark, workdir):
    files = [[event(1, t)] for t in ("18:13:10", "18:14:10", "18:14:11", "18:13:40", "18:13:41")]
    folder = stage_files(os.path.join(workdir, "in"), files)
    cfg = SOURCE_WM
    res = results(_stream(spark, folder, cfg), dimension(spark), cfg)
    q, seen = collect_batches(res, os.path.join(workdir, "ck"))
    assert seen[2] == [("18:13", 1, 1, 20.0, 50.0)]
    assert seen.get(3, []) == [] and seen.get(4, []) == []
    per_batch = {b["batch_id"]: b["dropped_late"] for b in batch_progress(q)}
    assert per_batch[3] == 1 and per_batch[4] == 1
    assert dropped_late_rows(q) == 2


def _count_only(spark, folder, cfg, dim_ids=(1,)):
    res = results(_stream(spark, folder, cfg), dimension(spark, dim_ids), cfg)
    return res


def test_watermark_placement_filter(spark, workdir):
    rows = [[event(1, "18:13:10", temp=20.0), event(1, "18:20:00", temp=500.0)]]
    # watermark at the source + guarded filter: the rejected row still
    # advances event time and closes the 18:13 window.
    folder = stage_files(os.path.join(workdir, "a"), rows)
    cfg = EngineConfig(watermark_at="source")
    q, seen = collect_batches(_count_only(spark, folder, cfg), os.path.join(workdir, "cka"))
    assert [r for rs in seen.values() for r in rs] == [("18:13", 1, 1, 20.0, 50.0)]
    assert batch_progress(q)[-1]["watermark"].startswith("2026-06-05T18:19:50")
    # watermark on enriched rows: the rejected row does not move it.
    folder = stage_files(os.path.join(workdir, "b"), rows)
    cfg = EngineConfig(watermark_at="enriched")
    q, seen = collect_batches(_count_only(spark, folder, cfg), os.path.join(workdir, "ckb"))
    assert [r for rs in seen.values() for r in rs] == []
    assert batch_progress(q)[-1]["watermark"].startswith("2026-06-05T18:13:00")


def test_watermark_placement_join(spark, workdir):
    rows = [[event(1, "18:13:10"), event(1, "18:20:00", temp=500.0), event(9, "18:30:00")]]
    folder = stage_files(os.path.join(workdir, "a"), rows)
    q, seen = collect_batches(
        _count_only(spark, folder, EngineConfig(watermark_at="source")), os.path.join(workdir, "cka")
    )
    assert batch_progress(q)[-1]["watermark"].startswith("2026-06-05T18:29:50")
    assert [r for rs in seen.values() for r in rs] == [("18:13", 1, 1, 20.0, 50.0)]
    folder = stage_files(os.path.join(workdir, "b"), rows)
    q, seen = collect_batches(
        _count_only(spark, folder, EngineConfig(watermark_at="enriched")), os.path.join(workdir, "ckb")
    )
    assert batch_progress(q)[-1]["watermark"].startswith("2026-06-05T18:13:00")
    assert [r for rs in seen.values() for r in rs] == []


def test_no_delay_keeps_every_window_open(spark, workdir):
    """delay=None (update output only): late rows are still counted."""
    files = [[event(1, t)] for t in ("18:13:10", "18:14:10", "18:14:11", "18:13:40", "18:13:41")]
    folder = stage_files(os.path.join(workdir, "in"), files)
    cfg = EngineConfig(delay=None, output="update", quality_filter=False)
    res = results(_stream(spark, folder, cfg), dimension(spark), cfg)
    q, seen = collect_batches(res, os.path.join(workdir, "ck"), "update")
    latest = {}
    for b in sorted(seen):
        for r in seen[b]:
            latest[(r[0], r[1])] = r[2]
    assert latest == {("18:13", 1): 3, ("18:14", 1): 2}
    assert dropped_late_rows(q) == 0


def test_append_needs_delay():
    import pytest

    with pytest.raises(ValueError):
        EngineConfig(delay=None, output="append")


def test_sql_route_append_stream_matches_dataframe_route(spark, workdir):
    from skein.plans.sql_route import sql_results

    folder = stage_files(os.path.join(workdir, "in"), LIFECYCLE)
    cfg = SOURCE_WM
    res = sql_results(spark, _stream(spark, folder, cfg), dimension(spark), cfg)
    _, seen = collect_batches(res, os.path.join(workdir, "ck"))
    assert {b: rows for b, rows in seen.items() if rows} == {
        4: [("18:13", 1, 4, 20.0, 55.0), ("18:13", 2, 1, 20.0, 50.0)],
        6: [("18:14", 1, 2, 20.0, 50.0)],
    }


def test_batch_reader_over_the_same_files(spark, workdir):
    """Bounded read of the staged files: every window, the late row included
    (no watermark in batch)."""
    from skein.sources.events import read_event_batch

    folder = stage_files(os.path.join(workdir, "in"), LIFECYCLE)
    res = results(read_event_batch(spark, folder, SOURCE_WM), dimension(spark), SOURCE_WM)
    got = sorted((r.window_start[11:16], r.manufacturer_id, r.events_count, r.avg_temperature, r.median_humidity)
                 for r in res.collect())
    assert got == [
        ("18:13", 1, 4, 20.0, 55.0),
        ("18:13", 2, 1, 20.0, 50.0),
        ("18:14", 1, 2, 20.0, 50.0),
        ("18:16", 1, 1, 20.0, 50.0),
    ]


def test_python_rounding_mode_on_a_stream(spark, workdir):
    rows = [[event(1, "18:13:10", temp=2.67, hum=1.0), event(1, "18:13:20", temp=2.68, hum=1.01)],
            [event(1, "18:15:00")]]
    folder = stage_files(os.path.join(workdir, "in"), rows)
    cfg = SOURCE_WM.with_(rounding="binary_half_even")
    res = results(_stream(spark, folder, cfg), dimension(spark), cfg)
    _, seen = collect_batches(res, os.path.join(workdir, "ck"))
    emitted = [r for rs in seen.values() for r in rs]
    # mean 2.675 and median 1.005 as doubles: Python's round gives 2.67 / 1.0
    assert emitted == [("18:13", 1, 2, round(2.675, 2), round(1.005, 2))]
