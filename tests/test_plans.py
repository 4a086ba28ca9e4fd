"""Physical-plan checks: one shuffle, broadcast join, pushdown, pruning, no
Python in the default path."""

import contextlib
import io
import re

from conftest import SF01
from skein.plans.queries import REGISTRY


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_flagship_plan(spark):
    text = plan_text(REGISTRY["window_1min"](spark, SF01))
    # two shuffles, both of partially aggregated rows: the histogram by
    # (group, humidity value), then the histogram rows by group
    shuffles = re.findall(r"^\(\d+\) Exchange", text, flags=re.M)
    assert len(shuffles) == 2, text
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text and "SortAggregate" not in text
    assert "ArrowEvalPython" not in text and "BatchEvalPython" not in text
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(value,-50.0)" in pushed and "LessThanOrEqual(value,80.0)" in pushed
    schema = re.search(r"ReadSchema: struct<(.*)>", text).group(1)
    assert "event_type" not in schema and "event_id" not in schema
    # raw rows meet only the codegen'd hash aggregate (partial count per
    # group and humidity value); the percentile runs on histogram rows
    assert "partial_count(1)" in text
    tree = text.split("\n\n")[0]
    assert tree.rindex("ObjectHashAggregate") < tree.rindex("Exchange")


def test_sql_route_same_shape(spark):
    text = plan_text(REGISTRY["sql_window_1min"](spark, SF01))
    assert len(re.findall(r"^\(\d+\) Exchange", text, flags=re.M)) == 2
    assert "BroadcastHashJoin" in text


def test_half_even_uses_python_only_after_aggregation(spark):
    text = plan_text(REGISTRY["window_1min_half_even"](spark, SF01))
    assert "ArrowEvalPython" in text
    # the Python node sits above the final aggregate, i.e. on one row per group
    lines = [ln for ln in text.splitlines() if re.match(r"^\s*[:+\- ]*\w+", ln)]
    tree = "\n".join(lines[: lines.index(next(ln for ln in lines if "Exchange" in ln))])
    assert "ArrowEvalPython" in tree


def test_streaming_plans(spark):
    from conftest import SF001
    from skein.config import JOBS
    from skein.plans.pipeline import results
    from skein.sources.dimensions import manufacturers_seed
    from skein.sources.events import table_event_stream
    from skein.streaming.jobs import job_results

    stream = table_event_stream(spark, f"{SF001}/events*.parquet")
    dim = manufacturers_seed(spark)
    append_tree = plan_text(results(stream, dim, JOBS["bridge"])).split("\n\n")[0]
    # append: the histogram and the per-group median are two chained
    # stateful aggregations after one watermark on the enriched rows
    assert append_tree.count("StateStoreSave") == 2, append_tree
    assert append_tree.count("EventTimeWatermark") == 1
    assert "BroadcastHashJoin" in append_tree
    import tempfile

    upd = job_results(spark, stream, dim, JOBS["table_upsert"])
    q = (
        upd.writeStream.outputMode("update").format("noop")
        .option("checkpointLocation", tempfile.mkdtemp(prefix="skein-test-"))
        .trigger(availableNow=True).start()
    )
    assert q.awaitTermination(300)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain()
    update_tree = buf.getvalue()
    assert update_tree.count("StateStoreSave") == 1, update_tree
    # watermark at the source: the guarded quality filter stays above it
    assert update_tree.index("Filter") < update_tree.index("EventTimeWatermark")


def test_dim_upsert_scans_the_events_once(spark):
    from skein.plans.queries import observed_sensors
    from skein.operators.dimension import upsert_dimension
    from skein.sources.dimensions import sensors_seed

    text = plan_text(upsert_dimension(sensors_seed(spark), observed_sensors(spark, SF01), ["sensor_id"]))
    assert len(re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M)) == 1, text


def test_no_job_runs_before_the_query(spark):
    """Building the flagship's plan starts no job (no size probes)."""
    sc = spark.sparkContext
    sc.setJobGroup("probe", "plan only")
    try:
        df = REGISTRY["window_1min"](spark, SF01)
        plan_text(df)
        assert not sc.statusTracker().getJobIdsForGroup("probe")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_numbering_has_one_range_shuffle_and_narrow_totals(spark, workdir):
    from skein.operators.results_reader import number_messages

    msgs = spark.createDataFrame([("t", '{"k":1}', 0, 0)], "topic string, value string, partition int, offset long")
    text = plan_text(number_messages(msgs, ["k"]))
    assert "rangepartitioning" not in text  # the stored ranges are read, not dealt again
    assert any("value" not in s for s in re.findall(r"ReadSchema: struct<(.*)>", text))


def test_finalized_reads_open_events_only(spark):
    import datetime as dt

    from skein.plans.queries import table
    from skein.sources.events import sensor_events_from_table
    from pyspark.sql import functions as F

    since = F.lit(str(dt.datetime(2024, 1, 1))).cast("timestamp_ntz")
    text = plan_text(sensor_events_from_table(table(spark, SF01, "events").where(F.col("ts") >= since)))
    assert "GreaterThanOrEqual(ts" in re.search(r"PushedFilters: \[(.*)\]", text).group(1)


def test_state_partitions_follow_the_input(spark):
    from skein.session import default_parallelism, state_partitions

    assert state_partitions(spark, f"{SF01}/events*.parquet") == default_parallelism(spark)
    assert state_partitions(spark, f"{SF01}/events*.parquet", target_bytes=1000) > 100


def test_cluster_session_needs_a_shared_folder():
    import pytest

    from skein.session import build_session, is_local

    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"):
        assert not is_local(master)
        with pytest.raises(RuntimeError, match="checkpoint"):
            build_session(master=master)
    assert is_local("local[4]") and is_local("local")
