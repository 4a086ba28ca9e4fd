"""The four job variants, each one configuration of the same pipeline.

=============  ============================================================
hybrid         lenient JSON -> filter -> join -> watermark -> window ->
               JSON string per closed window (append)
table_upsert   SQL route; watermark at the source, guarded filter ->
               changelog (update) -> upsert folder; compact to read
bridge         as hybrid, typed rows, back through a ``window_results``
               view and ``SELECT`` of the 8 columns into an append sink
pure           raw strings, strict parse, no quality filter, snapshot
               dimension, JSON strings (append)
=============  ============================================================
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skein.config import JOBS, OUTPUTS, EngineConfig
from skein.operators.enrich import DIM_COLUMNS
from skein.operators.versions import VERSION_COLUMNS
from skein.plans.pipeline import results
from skein.plans.sql_route import (
    cells_sql,
    create_enriched_view,
    register_sources,
    select_results,
    window_results_sql,
)
from skein.schemas import RESULT
from skein.sources.dimensions import load_dimension
from skein.sources.events import decode_events
from skein.streaming.cells import start_cells, stream_cells
from skein.streaming.sinks import publish_changelog, start_append


@dataclass
class RunningJob:
    name: str
    query: StreamingQuery
    output: str
    kind: str  # "append" or "upsert"


def job_results(spark: SparkSession, events: DataFrame, manufacturers: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Window results of a job configuration (streaming or batch input)."""
    if cfg.name == "table_upsert":
        register_sources(spark, events, manufacturers, cfg)
        create_enriched_view(spark, cfg)
        return spark.sql(window_results_sql(cfg, chained=not (events.isStreaming and cfg.output == "update")))
    res = results(events, manufacturers, cfg)
    if cfg.name == "bridge":
        # Typed rows back to a table: declared schema check, a view, and the
        # INSERT-style select of the 8 columns.
        res.to(RESULT).createOrReplaceTempView("window_results")
        return select_results(spark)
    return res


def job_cells(spark: SparkSession, events: DataFrame, manufacturers: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The job's pipeline up to the cells (see :mod:`skein.streaming.cells`); the table job's in SQL."""
    if cfg.name != "table_upsert":
        return stream_cells(events, manufacturers, cfg)
    register_sources(spark, events, manufacturers, cfg)
    create_enriched_view(spark, cfg)
    return spark.sql(cells_sql(cfg, group="manufacturer_id"))


def run_paths(spark: SparkSession, job: str, *, replay: bool = False) -> tuple[str, str]:
    """(output, checkpoint) folders of a job under the shared folder.

    ``replay=False``: stable folders, so a restart resumes where the last
    run committed.  ``replay=True``: new folders, so the job reads its input
    from the beginning again (and writes a new output, leaving the old one
    untouched).
    """
    from skein.session import shared_root

    run = uuid.uuid4().hex if replay else "current"
    base = f"{shared_root(spark)}/jobs/{OUTPUTS.get(job, job)}/{run}"
    return f"{base}/output", f"{base}/checkpoint"


def start_job(
    spark: SparkSession,
    name_or_cfg: str | EngineConfig,
    *,
    events: DataFrame | None = None,
    raw: DataFrame | None = None,
    manufacturers: DataFrame,
    output: str | None = None,
    checkpoint: str | None = None,
    trigger: str | None = None,
    replay: bool = False,
    kafka: dict | None = None,
    state_partitions: int | None = None,
) -> RunningJob:
    """Start one job.

    ``events`` are decoded events; ``raw`` is a ``value`` text column to be
    decoded with the job's decoder.  The dimension is checked non-empty and
    pinned (snapshot) or kept live (refresh).  One checkpoint folder per job
    (its reader identity); a new folder replays the input from the start,
    the same folder resumes.
    """
    cfg = JOBS[name_or_cfg] if isinstance(name_or_cfg, str) else name_or_cfg
    trigger = trigger or cfg.trigger_interval
    if output is None or checkpoint is None:
        default_out, default_ck = run_paths(spark, cfg.name, replay=replay)
        output, checkpoint = output or default_out, checkpoint or default_ck
    if events is None:
        if raw is None:
            raise ValueError("give events or raw")
        events = decode_events(raw, cfg)
    # Update output, and medians by rank selection, are worked out from cells in plain batches.
    by_cells = cfg.output == "update" or cfg.median == "rank"
    if cfg.dimension == "versions":
        if by_cells:
            raise ValueError("cells are counted per manufacturer: dimension versions need append output and median='histogram'")
        dim = load_dimension(spark, manufacturers, "manufacturers", "versions", VERSION_COLUMNS, ["id", "valid_from"])
    else:
        dim = load_dimension(spark, manufacturers, "manufacturers", cfg.dimension, DIM_COLUMNS)
    res = (job_cells if by_cells else job_results)(spark, events, dim, cfg)
    # The setting is read when the query starts (the stream keeps its own
    # copy of the session settings), so it is set around start() only.
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    if state_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    try:
        if by_cells:
            publish = publish_changelog(kafka) if kafka else None
            q = start_cells(res, dim, cfg, path=output, checkpoint=checkpoint, trigger=trigger, publish=publish)
            return RunningJob(cfg.name, q, output, "upsert" if cfg.output == "update" else "append")
        q = start_append(res, path=output, checkpoint=checkpoint, emit=cfg.emit, trigger=trigger, kafka=kafka)
        return RunningJob(cfg.name, q, output, "append")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)


def run_to_end(job: RunningJob, timeout_s: int | None = None) -> RunningJob:
    """Wait for an ``available_now`` run to finish, however long it takes
    unless the caller sets a limit; re-raise its error."""
    finished = job.query.awaitTermination(timeout_s) if timeout_s else job.query.awaitTermination() or True
    if not finished:
        job.query.stop()
        raise TimeoutError(f"job {job.name} did not finish in {timeout_s}s")
    if job.query.exception():
        raise RuntimeError(str(job.query.exception()))
    return job


def first_open(spark: SparkSession, watermark: str, cfg: EngineConfig) -> datetime:
    """Start (UTC) of the earliest window that ends after the watermark: of those the stream has closed none."""
    w = F.window(F.lit(watermark).cast("timestamp"), cfg.window)
    text = spark.range(1).select(F.date_format(w["start"], "yyyy-MM-dd HH:mm:ss")).first()[0]
    return datetime.fromisoformat(text)


def finalize_bounded(
    spark: SparkSession, emitted: DataFrame, open_events: DataFrame, manufacturers: DataFrame, cfg: EngineConfig
) -> DataFrame:
    """Append output of a bounded replay plus the windows still open at its end.

    ``open_events``: the events from :func:`first_open` on (filter the source
    by time, so that little is read).  Windows that the watermark has closed
    are as the stream emitted them: rows that came late stay dropped.
    """
    from skein.plans.pipeline import results as batch_results

    rest = batch_results(open_events, manufacturers, cfg)
    return emitted.select(*rest.columns).unionByName(rest)
