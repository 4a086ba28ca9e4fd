"""Streams that write window results from cells, in micro-batches.

The stream's own state is one row per (window, group, humidity reading,
temperature bin), see :func:`skein.operators.windows.cells`: a hot group is
many rows, spread over all state partitions, and Spark drops late rows and
closed windows from it.  ``foreachBatch`` then works with plain batches, so
results may take several shuffles there, in update mode too:

* append: a closed window's cells come in one batch, once.  Its results are
  computed from that batch alone (with ``median="rank"`` by rank selection).
* update: the batch holds the cells that changed, with their totals so far.
  They are kept by window in a cell store; the results of the groups that
  changed come from the stored cells of these windows.

Every write is a folder of its batch id, overwritten when a batch is retried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from skein.config import EngineConfig
from skein.functions.jsonfmt import result_json
from skein.operators.enrich import DIM_COLUMNS
from skein.operators.quality import clean
from skein.operators.windows import cells, format_results, from_cells
from skein.streaming.sinks import _trigger, changelog_rows

KEYS = ["window", "manufacturer_id"]
CELL = T.StructType(
    [
        T.StructField("window", T.StructType([T.StructField("start", T.TimestampType()), T.StructField("end", T.TimestampType())])),
        T.StructField("manufacturer_id", T.ShortType()),
        T.StructField("h", T.DoubleType()),
        T.StructField("bin", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("s", T.DecimalType(38, 0)),
        T.StructField("odd", T.DoubleType()),
    ]
)
#: Windows of how many seconds share a folder of the cell store.
FOLDER_SECONDS = 86_400
MOST_PARTS = 10_000


def stream_cells(events: DataFrame, manufacturers: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The pipeline up to the cells: filter, known manufacturers, watermark, count."""
    if cfg.delay and cfg.watermark_at == "source":
        events = clean(events.withWatermark("event_ts", cfg.delay), cfg, guard=True)
    else:
        events = clean(events, cfg)
    ids = manufacturers.select(F.col("id").alias("_dim_id"))
    known = events.join(ids, events["manufacturer_id"] == ids["_dim_id"], "left_semi")
    if cfg.delay and cfg.watermark_at == "enriched":
        known = known.withWatermark("event_ts", cfg.delay)
    return cells(known, cfg, ["manufacturer_id"])


def named_results(counted: DataFrame, manufacturers: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The 8 result columns from a batch of cells."""
    agg = from_cells(counted, cfg, ["manufacturer_id"])
    dim = manufacturers.select(*DIM_COLUMNS)
    return format_results(agg.join(dim, agg["manufacturer_id"] == dim["id"], "left"))


def _folder(c: str) -> Column:
    return F.floor(F.unix_timestamp(c) / FOLDER_SECONDS).alias("part")


def _changed(batch: DataFrame, store: str, batch_id: int) -> DataFrame:
    """Keep the batch's cells; the cells, as they now are, of every group that has one in the batch."""
    spark = batch.sparkSession
    names = [f.name for f in CELL.fields]
    mine = f"{store}/version={batch_id}"
    # A few files a folder: AQE joins small parts and splits a hot one.
    dealt = batch.select(*names, _folder("window.start")).hint("rebalance", F.col("part"))
    dealt.write.mode("overwrite").partitionBy("part").parquet(mine)
    kept = spark.read.schema(T.StructType([*CELL.fields, T.StructField("part", T.LongType())])).parquet(mine)
    groups = kept.select(*KEYS, "part").distinct()
    whole = T.StructType([*CELL.fields, T.StructField("part", T.LongType()), T.StructField("version", T.LongType())])
    stored = spark.read.schema(whole).parquet(store).where(F.col("version") <= batch_id)
    # Folders of other days are skipped: their numbers, if they are not too many for a filter.
    parts = [r.part for r in kept.select("part").distinct().limit(MOST_PARTS + 1).collect()]
    if len(parts) <= MOST_PARTS:
        stored = stored.where(F.col("part").isin(parts))
    stored = stored.join(groups, [*KEYS, "part"], "left_semi")
    # A cell's totals only grow: its latest version is the one with the greatest number of rows.
    latest = stored.groupBy(*KEYS, "h", "bin").agg(F.max(F.struct("n", "s", "odd")).alias("c"))
    return latest.select(*KEYS, "h", "bin", "c.n", "c.s", "c.odd")


def start_cells(
    counted: DataFrame, manufacturers: DataFrame, cfg: EngineConfig, *, path: str, checkpoint: str, trigger: str | None = "available_now",
    publish: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Write results of ``counted`` (:func:`stream_cells`): in append mode a folder ``batch=<id>`` of closed windows,
    in update mode a changelog folder ``version=<id>`` (the layout of :func:`skein.streaming.sinks.start_upsert`).

    ``publish(rows, batch_id)`` replaces the write, for other sinks.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if cfg.output == "update":
            rows = changelog_rows(named_results(_changed(batch, f"{path}_cells", batch_id), manufacturers, cfg), batch_id).drop("version")
            target = f"{path}/version={batch_id}"
        else:
            rows, target = named_results(batch, manufacturers, cfg), f"{path}/batch={batch_id}"
            rows = rows.select(result_json().alias("value")) if cfg.emit == "json" else rows
        if publish is not None:
            publish(rows, batch_id)
        else:
            rows.write.mode("overwrite").parquet(target)

    writer = counted.writeStream.outputMode(cfg.output).foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()
