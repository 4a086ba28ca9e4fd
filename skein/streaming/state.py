"""Windows that a stopped stream has left open, from its own saved state.

A stream's checkpoint holds the cells (:func:`skein.operators.windows.cells`)
of every window that its watermark has not closed.  Spark's state reader gives
them as a table, so a bounded replay is finished without a look at its source:
the work follows the open windows, and rows that came late stay dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.config import EngineConfig
from skein.operators.windows import format_results, from_cells

CELL_KEY = ["window", "manufacturer_id", "h", "bin"]


def open_cells(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The cells in the state as of the last committed batch (or ``batch_id``): window, manufacturer_id, h, bin, n,
    s, odd.  The stream must not be running."""
    operators = spark.read.format("state-metadata").load(checkpoint).select("operatorId").distinct().collect()
    for op in sorted(r.operatorId for r in operators):
        reader = spark.read.format("statestore").option("operatorId", op)
        state = (reader if batch_id is None else reader.option("batchId", batch_id)).load(checkpoint)
        if state.schema["key"].dataType.names == CELL_KEY:
            # The buffers of count, sum (with whether it has none) and sum, by place: their names are Spark's own.
            value = F.col("value").cast("struct<n: bigint, s: decimal(38,0), none: boolean, odd: double>")
            rows = state.select("key.*", value.alias("v"))
            return rows.select(*CELL_KEY, "v.n", F.when(~F.col("v.none"), F.col("v.s")).alias("s"), "v.odd")
    raise ValueError(f"no state of window cells in {checkpoint}")


def finalize_from_state(spark: SparkSession, emitted: DataFrame, checkpoint: str, manufacturers: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Append output of a stopped stream, and the windows that it has left open."""
    agg = from_cells(open_cells(spark, checkpoint), cfg, ["manufacturer_id"])
    dim = manufacturers.select("id", "manufacturer_name", "country")
    rest = format_results(agg.join(dim, agg["manufacturer_id"] == dim["id"], "left"))
    return emitted.select(*rest.columns).unionByName(rest)
