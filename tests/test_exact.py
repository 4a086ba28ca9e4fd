"""Exact sums, rank selection and the cell sinks."""

import json
import math
import os
import random
from decimal import Decimal, getcontext
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from helpers import dimension, event, stage_files
from skein.config import JOBS, EngineConfig
from skein.functions.rounding import bin_sql, mean_sql, median_sql, plain_mean_sql, units_sql
from skein.operators.rank import from_ordered_bits, middle_values, ordered_bits
from test_plans import plan_text

getcontext().prec = 1000
ZERO = "CAST(0 AS DECIMAL(38,0))"


def reading(rng):
    kind = rng.randint(0, 7)
    if kind == 0:
        return rng.choice([0.01499999999, 0.015, -0.005, 2.675, 1e-300, -1e-300, 0.0, -0.0, 1e14 + 0.5, 999999999999999.9, 5e-324, 8.9999999999e9, 9.0e9])
    if kind == 1:
        return round(rng.uniform(-50, 80), 2)
    if kind == 2:
        return rng.uniform(-1, 1) * 10 ** rng.randint(-30, 14)
    if kind == 3:
        return float(rng.randint(-(10**9), 10**9))
    if kind == 4:
        return round(rng.uniform(-50, 80), rng.randint(0, 9))
    if kind == 5:
        return rng.uniform(-1, 1) * 10 ** rng.randint(-307, -20)
    return rng.choice([1e10, 1.0e7, 2.5e8, 12345678.9, -1e7, rng.uniform(-50, 80)])


def rounded(x: Fraction) -> float:
    whole = math.floor(abs(x) * 100 + Fraction(1, 2))
    return (-1 if x < 0 else 1) * whole / 100 if whole else 0.0


def exact(x: float) -> Fraction:
    return Fraction(Decimal(repr(x)))


def means(spark, groups):
    rows = [(i, v) for i, g in enumerate(groups) for v in g]
    df = spark.createDataFrame(rows, "g int, x double").repartition(4)
    bins = df.groupBy("g", F.expr(bin_sql("x")).alias("bin")).agg(
        F.sum(F.expr(units_sql("x"))).alias("s"), F.count("*").alias("n"), F.sum(F.when(F.expr(bin_sql("x")).isNull(), F.col("x"))).alias("odd")
    )
    listed = bins.groupBy("g").agg(F.expr("collect_list(CASE WHEN bin IS NOT NULL THEN struct(bin, s) END)").alias("e"), F.sum("n").alias("n"), F.sum("odd").alias("odd"))
    out = listed.select("g", F.expr(mean_sql(ZERO, "e", "n", "odd")).alias("m"), F.expr(plain_mean_sql(ZERO, "e", "n", "odd")).alias("p"))
    return {r.g: (r.m, r.p) for r in out.collect()}


def test_means_are_exact_at_any_scale(spark):
    rng = random.Random(7)
    groups = [[reading(rng) for _ in range(rng.randint(1, 6))] for _ in range(600)]
    got = means(spark, groups)
    for i, g in enumerate(groups):
        want = sum(map(exact, g)) / len(g)
        assert got[i][0] == rounded(want), g
        assert math.isclose(got[i][1], float(want), rel_tol=1e-12, abs_tol=1e-9), g


def test_means_of_what_is_no_number(spark):
    inf = math.inf
    got = means(spark, [[math.nan, 1.0], [inf, 1e300], [inf, -inf], [1e300, 3e300], [-1e15, 1e15, 0.5]])
    assert math.isnan(got[0][0]) and got[1][0] == inf and math.isnan(got[2][0]) and got[3][0] == 2e300
    assert math.isclose(got[4][0], 0.5 / 3)  # readings of 10^15: doubles


def test_medians_are_rounded_once(spark):
    rng = random.Random(8)
    pairs = [tuple(sorted((reading(rng), reading(rng)))) for _ in range(300)] + [(50.01, 50.02), (0.01499999999,) * 2, (1.005, 1.005), (-0.004, 0.003)]
    pairs = [p for p in pairs if abs(p[1]) < 1e15 and abs(p[0]) < 1e15]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a double, b double")
    got = {r.i: r.m for r in df.select("i", F.expr(median_sql("a", "b")).alias("m")).collect()}
    for i, (a, b) in enumerate(pairs):
        assert got[i] == rounded((exact(a) + exact(b)) / 2), (a, b)
    odd = spark.createDataFrame([(math.nan, 1.0), (-math.inf, math.inf), (1.0, math.inf), (None, None)], "a double, b double")
    rest = [r.m for r in odd.select(F.expr(median_sql("a", "b")).alias("m")).collect()]
    assert math.isnan(rest[0]) and math.isnan(rest[1]) and rest[2] == math.inf and rest[3] is None


def test_ordered_bits(spark):
    values = [-math.inf, -1e300, -1.5, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.5, 1e300, math.inf]
    df = spark.createDataFrame([(v,) for v in [*values, -0.0, math.nan, None]], "x double").withColumn("c", ordered_bits("x"))
    rows = df.select("x", "c", from_ordered_bits("c").alias("y")).collect()
    codes = [r.c for r in rows]
    assert codes[:11] == sorted(set(codes[:11])) and codes[11] == codes[5] and codes[12] > codes[10] and codes[13] is None
    assert [r.y for r in rows[:11]] == values


def test_middle_values_of_hot_and_odd_groups(spark):
    rng = random.Random(4)
    pick = lambda: rng.choice([rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300), round(rng.gauss(50, 5), 2), 0.0, -0.0, math.inf, -math.inf, None, 5e-324])
    rows = [(g, pick(), rng.randint(1, 3)) for g in range(20) for _ in range(rng.randint(1, 40))] + [(99, rng.gauss(50, 1), 1) for _ in range(4000)] + [(100, None, 1)]
    df = spark.createDataFrame(rows, "g int, x double, w long").repartition(5)
    for weight in (None, "w"):
        want = {}
        for g in range(101):
            v = sorted(x + 0.0 for a, x, w in rows if a == g and x is not None for _ in range(w if weight else 1))
            if v:
                want[g] = (len(v), v[(len(v) - 1) // 2], v[len(v) // 2])
        assert {r.g: (r.n, r.low, r.high) for r in middle_values(df, ["g"], "x", weight).collect()} == want
    assert middle_values(df.limit(0), ["g"], "x").count() == 0


def test_rank_and_histogram_agree(spark):
    from conftest import SF001
    from skein.plans.queries import precise_events, sensor_events
    from skein.plans.pipeline import results
    from skein.sources.dimensions import manufacturers_seed

    ev = precise_events(sensor_events(spark, SF001, keep=["event_id"]))
    both = [sorted(map(str, results(ev, manufacturers_seed(spark), EngineConfig(window="1 day", median=m)).collect())) for m in ("histogram", "rank")]
    assert both[0] == both[1] and both[0]


def _update_job(spark, workdir, batches, median):
    from skein.streaming.jobs import run_to_end, start_job

    folder = stage_files(os.path.join(workdir, "in"), batches)
    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(folder)
    cfg = EngineConfig(name="cells", output="update", watermark_at="source", median=median)
    return run_to_end(start_job(spark, cfg, raw=raw, manufacturers=dimension(spark), output=f"{workdir}/out", checkpoint=f"{workdir}/ck", trigger="available_now", state_partitions=4))


BATCHES = [
    [event(1, "18:13:10", hum=50.0), event(1, "18:13:20", hum=60.0), event(2, "18:13:50")],
    [event(1, "18:13:30", hum=70.0, temp=21.0)],
    [event(1, "18:13:40", hum=50.0), event(2, "18:14:00")],
]


@pytest.mark.parametrize("median", ["histogram", "rank"])
def test_update_output_from_cells(spark, workdir, median):
    from skein.streaming.sinks import read_changelog

    job = _update_job(spark, workdir, BATCHES, median)
    log = sorted((r.version, r.window_start[11:16], r.manufacturer_id, r.events_count, r.avg_temperature, r.median_humidity) for r in read_changelog(spark, job.output).collect())
    # A version for every changed group; cells of earlier batches count.
    assert log == [
        (0, "18:13", 1, 2, 20.0, 55.0), (0, "18:13", 2, 1, 20.0, 50.0),
        (1, "18:13", 1, 3, 20.33, 60.0),
        (2, "18:13", 1, 4, 20.25, 55.0), (2, "18:14", 2, 1, 20.0, 50.0),
    ]


def test_retried_batch_changes_nothing(spark, workdir):
    """The commit of the last batch is lost: the stream runs it again, over its own folders."""
    from skein.streaming.sinks import read_changelog

    key = lambda r: (r.version, r.key, r.value)
    job = _update_job(spark, workdir, BATCHES, "histogram")
    want = sorted(map(key, read_changelog(spark, job.output).collect()))
    commits = f"{workdir}/ck/commits"
    last = max(int(c) for c in os.listdir(commits) if c.isdigit() and os.path.isdir(f"{job.output}/version={c}"))
    for c in os.listdir(commits):
        if c.strip(".").split(".")[0].isdigit() and int(c.strip(".").split(".")[0]) >= last:
            os.remove(f"{commits}/{c}")
    again = _update_job_again(spark, workdir)
    assert sorted(map(key, read_changelog(spark, again.output).collect())) == want


def _update_job_again(spark, workdir):
    from skein.streaming.jobs import run_to_end, start_job

    raw = spark.readStream.option("maxFilesPerTrigger", 1).text(os.path.join(workdir, "in"))
    cfg = EngineConfig(name="cells", output="update", watermark_at="source")
    return run_to_end(start_job(spark, cfg, raw=raw, manufacturers=dimension(spark), output=f"{workdir}/out", checkpoint=f"{workdir}/ck", trigger="available_now", state_partitions=4))


def test_hot_group_is_spread_over_the_state(spark, workdir):
    """One manufacturer with all rows of one window: its cells lie in every state partition."""
    rows = [[event(1, "18:13:10", hum=i / 10, temp=20 + i / 7) for i in range(400)]]
    _update_job(spark, workdir, rows, "rank")
    state = spark.read.format("statestore").load(f"{workdir}/ck")
    parts = {r.partition_id: r["count"] for r in state.groupBy("partition_id").count().collect()}
    assert len(parts) == 4 and sum(parts.values()) == 400 and max(parts.values()) < 200
    assert state.select("key.window").distinct().count() == 1


def test_hot_group_plan(spark):
    """Reading and bin are keys of the only shuffle of raw rows, also in the job's SQL."""
    from conftest import SF001
    from skein.sources.dimensions import manufacturers_seed
    from skein.plans.queries import sensor_events
    from skein.streaming.jobs import job_cells

    # The batch twin: a stream in update mode has no plan before it starts.
    stream = sensor_events(spark, SF001)
    for cfg in (JOBS["table_upsert"], EngineConfig(name="x", output="update")):
        text = plan_text(job_cells(spark, stream, manufacturers_seed(spark), cfg))
        dealt = [line for line in text.splitlines() if "hashpartitioning" in line]
        assert len(dealt) == 1 and " h#" in dealt[0] and "bin#" in dealt[0], text


def test_rank_medians_of_a_closed_window(spark, workdir):
    from skein.streaming.jobs import run_to_end, start_job

    folder = stage_files(os.path.join(workdir, "in"), [[event(1, "18:13:10", hum=0.00499999999), event(1, "18:13:20", hum=0.00499999999), event(1, "18:20:00", temp=500.0)]])
    raw = spark.readStream.text(folder)
    cfg = JOBS["pure"].with_(median="rank")
    job = run_to_end(start_job(spark, cfg, raw=raw, manufacturers=dimension(spark), output=f"{workdir}/out", checkpoint=f"{workdir}/ck", trigger="available_now"))
    got = [json.loads(r.value) for r in spark.read.parquet(job.output).collect()]
    assert [(g["events_count"], g["median_humidity"]) for g in got] == [(2, 0.0)]
