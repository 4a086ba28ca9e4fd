"""``decode -> clean -> known manufacturers -> watermark -> window -> names``,
batch or stream.

Watermark placement follows ``cfg.watermark_at``:

* ``"source"``: watermark straight after decoding, then the quality filter as
  one guarded predicate (so it stays above the watermark node), then the
  dimension join.  Rows that are later rejected still advance the watermark.
* ``"enriched"``: filter and dimension join first, watermark on the
  remaining rows.  Rejected and unknown-manufacturer rows do not move event
  time.

On a batch DataFrame the watermark is a no-op and the plan is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.config import EngineConfig
from skein.operators.enrich import DIM_COLUMNS
from skein.operators.quality import clean
from skein.operators.versions import VERSION_COLUMNS, with_version
from skein.operators.windows import format_results, window_aggregate


def results(events: DataFrame, manufacturers: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Window results (typed 8 columns) for batch or streaming events.

    Grouped by (window, manufacturer id) as the keyed stream jobs do; the
    events are first restricted to known manufacturers (semi join, which
    drops unknown ids exactly like the inner join), and name and country are
    attached to the aggregated rows afterwards.  That second join is a left
    one: a window once counted stays, with null names, if a refreshed
    dimension has lost its manufacturer meanwhile.  Ids must be unique
    (:func:`skein.sources.dimensions.load_dimension` checks it).  The shuffles and the
    streaming state then carry no text columns.

    With ``dimension="versions"`` the manufacturers have a row per version
    (:mod:`skein.operators.versions`), an event counts for the version of its
    time, and a window has one row per manufacturer and version.
    """
    by_version = cfg.dimension == "versions"
    dim = manufacturers.select(*(VERSION_COLUMNS if by_version else DIM_COLUMNS))
    streaming = events.isStreaming
    if streaming and cfg.delay and cfg.watermark_at == "source":
        events = clean(events.withWatermark("event_ts", cfg.delay), cfg, guard=True)
    else:
        events = clean(events, cfg)
    if by_version:
        known = with_version(events, dim)
    else:
        ids = dim.select(F.col("id").alias("_dim_id"))
        known = events.join(ids, events["manufacturer_id"] == ids["_dim_id"], "left_semi")
    if streaming and cfg.delay and cfg.watermark_at == "enriched":
        known = known.withWatermark("event_ts", cfg.delay)
    if by_version:
        agg = window_aggregate(known, cfg, ["manufacturer_id", "valid_from"])
        # Renamed, as the times that came with the events are the dimension's own column.
        names = dim.select("id", "manufacturer_name", "country", F.col("valid_from").alias("_since"))
        named = agg.join(names, (F.col("manufacturer_id") == F.col("id")) & F.col("valid_from").eqNullSafe(F.col("_since")), "left")
    else:
        agg = window_aggregate(known, cfg, ["manufacturer_id"])
        named = agg.join(dim, agg["manufacturer_id"] == dim["id"], "left")
    return format_results(named)
