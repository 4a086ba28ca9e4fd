"""The SQL-view route: sources as temp views, the enriched view and the
window aggregate written in Spark SQL.

Catalyst produces the same physical plan as the DataFrame route; the views
also work on streaming DataFrames, so a stream can be queried with SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skein.config import EngineConfig
from skein.functions.rounding import SINGLE_MEAN_SQL, SINGLE_MEDIAN_SQL, SINGLE_SQL, bin_sql, mean_sql, median_sql, middle_sql, units_sql
from skein.operators.enrich import DIM_COLUMNS
from skein.operators.quality import quality_sql
from skein.operators.windows import GROUP_SQL, HIST_SQL
from skein.schemas import RESULT_COLUMNS


def register_sources(spark: SparkSession, events: DataFrame, manufacturers: DataFrame, cfg: EngineConfig) -> None:
    """Register ``iot_events`` and ``manufacturers``.

    With ``watermark_at="source"`` the watermark is put on ``iot_events``
    itself.
    """
    if events.isStreaming and cfg.delay and cfg.watermark_at == "source":
        events = events.withWatermark("event_ts", cfg.delay)
    events.createOrReplaceTempView("iot_events")
    manufacturers.select(*DIM_COLUMNS).createOrReplaceTempView("manufacturers")


def _quality_sql(cfg: EngineConfig, guard: bool) -> str:
    """The filter of :mod:`skein.operators.quality` as SQL text: the rules are stated once."""
    if not cfg.quality_filter:
        return "event_ts IS NOT NULL"
    pred = quality_sql(cfg)
    # One expression that mentions the event-time column stays above the
    # watermark node (see skein.operators.quality.guarded).
    return f"CASE WHEN event_ts IS NOT NULL THEN ({pred}) ELSE false END" if guard else pred


def create_enriched_view(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    """``enriched_iot_events``: quality filter + inner join, as a view."""
    guard = cfg.watermark_at == "source"
    sql = f"""
        SELECT e.sensor_id, e.manufacturer_id, m.manufacturer_name, m.country,
               e.event_time, e.event_ts, e.temperature, e.humidity
        FROM iot_events AS e
        JOIN manufacturers AS m ON e.manufacturer_id = m.id
        WHERE {_quality_sql(cfg, guard)}
    """
    view = spark.sql(sql)
    if view.isStreaming and cfg.delay and cfg.watermark_at == "enriched":
        view = view.withWatermark("event_ts", cfg.delay)
    view.createOrReplaceTempView("enriched_iot_events")
    return view


def _named(aggregates: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in aggregates.items())


def cells_sql(cfg: EngineConfig, source: str = "enriched_iot_events", group: str = "manufacturer_id, manufacturer_name, country") -> str:
    """The cells of :mod:`skein.operators.windows` in SQL."""
    return f"""
        SELECT window, {group}, h, bin, count(*) AS n, sum(u) AS s, sum(IF(bin IS NULL, temperature, NULL)) AS odd
        FROM (SELECT window(event_ts, '{cfg.window}') AS window, {group}, humidity + 0D AS h, temperature,
                     {bin_sql("temperature")} AS bin, {units_sql("temperature")} AS u
              FROM {source})
        GROUP BY window, {group}, h, bin"""


def window_results_sql(cfg: EngineConfig, source: str = "enriched_iot_events", chained: bool = True) -> str:
    """Tumbling-window aggregate in SQL over the readings as sent, rounded
    once (HALF_UP, see :mod:`skein.functions.rounding`).

    ``chained`` (batch, append-mode streams): through the cells of
    :mod:`skein.operators.windows`, bounded work per group under skew.
    Otherwise (update-mode streams): one ``percentile`` aggregate.
    """
    group = "manufacturer_id, manufacturer_name, country"
    if chained:
        grouped = f"SELECT window AS w, {group}, {_named(GROUP_SQL | HIST_SQL)} FROM ({cells_sql(cfg, source, group)}) GROUP BY window, {group}"
        grouped = f"SELECT *, {middle_sql('hist')} AS mid FROM ({grouped})"
        mean, median = mean_sql("usual", "unusual", "n", "odd"), median_sql("mid.low", "mid.high")
    else:
        grouped = f"SELECT window(event_ts, '{cfg.window}') AS w, {group}, {_named(SINGLE_SQL)} FROM {source} GROUP BY 1, 2, 3, 4"
        mean, median = SINGLE_MEAN_SQL, SINGLE_MEDIAN_SQL
    return f"""
        SELECT date_format(w.start, 'yyyy-MM-dd HH:mm:ss.SSS') AS window_start,
               date_format(w.end, 'yyyy-MM-dd HH:mm:ss.SSS') AS window_end,
               {group}, n AS events_count, {mean} AS avg_temperature, {median} AS median_humidity
        FROM ({grouped})
    """


def create_window_results_view(spark: SparkSession, cfg: EngineConfig, chained: bool = True) -> DataFrame:
    res = spark.sql(window_results_sql(cfg, chained=chained))
    res.createOrReplaceTempView("window_results")
    return res


def select_results(spark: SparkSession, view: str = "window_results") -> DataFrame:
    """``INSERT INTO sink SELECT <8 columns> FROM window_results`` as a read."""
    return spark.sql(f"SELECT {', '.join(RESULT_COLUMNS)} FROM {view}")


def sql_results(spark: SparkSession, events: DataFrame, manufacturers: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Whole SQL route: register sources, enriched view, window view, select."""
    if cfg.rounding != "half_up":
        raise ValueError("the SQL route implements half_up rounding only")
    register_sources(spark, events, manufacturers, cfg)
    create_enriched_view(spark, cfg)
    create_window_results_view(spark, cfg, chained=not (events.isStreaming and cfg.output == "update"))
    return select_results(spark)
