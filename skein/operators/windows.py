"""Tumbling event-time window results per manufacturer.

Readings are first counted into *cells*, one per (window, group, humidity
reading, temperature bin); results come from the cells alone.  A cell is a
plain count and an exact sum, so cells are the partial state of every route:
batch, append streams (two chained aggregations), and the cell sinks of
:mod:`skein.streaming.cells`.  On a stream, the caller puts ``withWatermark``
on the input first (see :mod:`skein.plans.pipeline`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.config import EngineConfig
from skein.functions.rounding import (
    SINGLE_MEAN_SQL,
    SINGLE_MEDIAN_SQL,
    SINGLE_SQL,
    USUAL,
    binary_half_even,
    bin_sql,
    mean_sql,
    median_sql,
    middle_sql,
    plain_mean_sql,
    units_sql,
)
from skein.functions.timefmt import window_text
from skein.schemas import RESULT_COLUMNS

GROUP_COLUMNS = ["manufacturer_id", "manufacturer_name", "country"]

#: A group from its cells.  Nearly all temperatures are in one bin: only the others' sums are listed.
GROUP_SQL = {
    "n": "sum(n)",
    "usual": f"CAST(coalesce(sum(IF(bin = {USUAL}, s, NULL)), 0) AS DECIMAL(38,0))",
    "unusual": f"collect_list(IF(bin <> {USUAL}, named_struct('bin', bin, 's', s), NULL))",
    "odd": "sum(odd)",
}
HIST_SQL = {"hist": "collect_list(IF(h IS NOT NULL, named_struct('h', h, 'n', n), NULL))"}


def window_aggregate(enriched: DataFrame, cfg: EngineConfig, group_cols: list[str] | None = None) -> DataFrame:
    """Grouped aggregate with the window struct still typed (``window``):
    ``window, <group_cols>, events_count, avg_temperature, median_humidity``.

    Batch input and append-mode streams go through cells.  An update-mode
    stream is one ``percentile`` aggregate (Structured Streaming chains
    stateful aggregations in append mode only); a hot group is one row of its
    state, so jobs write update output through :mod:`skein.streaming.cells`.
    """
    group_cols = group_cols or GROUP_COLUMNS
    if enriched.isStreaming and cfg.output == "update":
        return _single_aggregate(enriched, cfg, group_cols)
    return from_cells(cells(enriched, cfg, group_cols), cfg, group_cols)


def cells(enriched: DataFrame, cfg: EngineConfig, group_cols: list[str]) -> DataFrame:
    """Rows counted per (window, group, humidity reading, temperature bin).

    Partial aggregation before the shuffle; the shuffle key has the reading
    in it, so even a group that holds a third of all rows spreads over many
    reducers (and, on a stream, over many rows of the state).
    """
    part = f"named_struct('bin', {bin_sql('temperature')}, 'u', {units_sql('temperature')})"
    rows = enriched.select(
        F.window("event_ts", cfg.window).alias("window"), *group_cols, "temperature",
        (F.col("humidity") + F.lit(0.0)).alias("h"), F.expr(part).alias("p"),
    )
    rows = rows.select("window", *group_cols, "h", "p.bin", "p.u", F.when(F.col("p.bin").isNull(), F.col("temperature")).alias("odd"))
    return rows.groupBy("window", *group_cols, "h", "bin").agg(F.count(F.lit(1)).alias("n"), F.sum("u").alias("s"), F.sum("odd").alias("odd"))


def from_cells(counted: DataFrame, cfg: EngineConfig, group_cols: list[str]) -> DataFrame:
    """Results from cells.

    ``median="histogram"``: a group's cells meet in one task, one entry per
    different reading of the group however many rows there were (10^4 for
    0..100 with two decimals).  ``median="rank"`` (batch): by distributed rank
    selection, whatever the number of different readings.
    """
    keys = ["window", *group_cols]
    if cfg.median == "rank":
        from skein.operators.rank import middle_values, pinned

        if counted.isStreaming:
            raise ValueError("median='rank' is for batches; streams write it through skein.streaming.cells")
        counted = pinned(counted, "cells")
        bins = counted.groupBy(*keys, "bin").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"), F.sum("odd").alias("odd"))
        sums = _grouped(bins, keys, GROUP_SQL)
        middle = middle_values(counted.where("h IS NOT NULL").select(*keys, "h", "n"), keys, "h", "n")
        # A group without any humidity has no middle.
        grouped = sums.join(middle.select(*keys, F.struct("low", "high").alias("mid")), keys, "left")
    else:
        grouped = _grouped(counted, keys, GROUP_SQL | HIST_SQL).withColumn("mid", F.expr(middle_sql("hist")))
    if cfg.rounding == "half_up":
        avg, med = F.expr(mean_sql("usual", "unusual", "n", "odd")), F.expr(median_sql("mid.low", "mid.high"))
    else:
        avg = binary_half_even(F.expr(plain_mean_sql("usual", "unusual", "n", "odd")))
        med = binary_half_even(F.expr("0.5D * mid.low + 0.5D * mid.high"))
    return grouped.select(*keys, F.col("n").alias("events_count"), avg.alias("avg_temperature"), med.alias("median_humidity"))


def _grouped(df: DataFrame, keys: list, aggregates: dict[str, str]) -> DataFrame:
    """``df`` grouped, with aggregates given as SQL by name."""
    return df.groupBy(*keys).agg(*[F.expr(sql).alias(name) for name, sql in aggregates.items()])


def _single_aggregate(enriched: DataFrame, cfg: EngineConfig, group_cols: list[str]) -> DataFrame:
    w = F.window("event_ts", cfg.window).alias("window")
    out = _grouped(enriched, [w, *group_cols], SINGLE_SQL)
    if cfg.rounding == "half_up":
        avg, med = F.expr(SINGLE_MEAN_SQL), F.expr(SINGLE_MEDIAN_SQL)
    else:
        avg = binary_half_even(F.expr("IF(wild > 0, total, CAST(units AS DOUBLE)) / n"))
        med = binary_half_even("med")
    return out.select("window", *group_cols, F.col("n").alias("events_count"), avg.alias("avg_temperature"), med.alias("median_humidity"))


def format_results(agg: DataFrame) -> DataFrame:
    """Typed window -> the 8-column result with text window bounds."""
    return agg.select(
        window_text("window.start").alias("window_start"),
        window_text("window.end").alias("window_end"),
        *[c for c in RESULT_COLUMNS[2:]],
    )
