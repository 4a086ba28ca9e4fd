"""Quality rules on decoded events, and the rows they reject."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.config import EngineConfig

REQUIRED = ["sensor_id", "manufacturer_id", "event_time", "temperature", "humidity"]


def rules_sql(cfg: EngineConfig, time_col: str = "event_ts") -> dict[str, str]:
    """Reason -> SQL of the predicate that must hold, in reporting order."""
    (t_lo, t_hi), (h_lo, h_hi) = cfg.temperature_range, cfg.humidity_range
    rules = {f"null_{c}": f"{c} IS NOT NULL" for c in [*REQUIRED, time_col]}
    rules["temperature_out_of_range"] = f"temperature BETWEEN {t_lo!r}D AND {t_hi!r}D"
    rules["humidity_out_of_range"] = f"humidity BETWEEN {h_lo!r}D AND {h_hi!r}D"
    return rules


def _rules(cfg: EngineConfig, time_col: str = "event_ts") -> list[tuple[str, Column]]:
    return [(reason, F.expr(sql)) for reason, sql in rules_sql(cfg, time_col).items()]


# Evaluation order of the filter: cheap and selective tests first (the
# conjunction short-circuits), text-column null tests last.
_EVAL_ORDER = [
    "null_temperature",
    "null_humidity",
    "temperature_out_of_range",
    "humidity_out_of_range",
    "null_manufacturer_id",
    "null_event_ts",
    "null_sensor_id",
    "null_event_time",
]


def quality_sql(cfg: EngineConfig, time_col: str = "event_ts") -> str:
    rules = rules_sql(cfg, time_col)
    return " AND ".join(f"({rules[r.replace('null_event_ts', f'null_{time_col}')]})" for r in _EVAL_ORDER)


def quality_predicate(cfg: EngineConfig, time_col: str = "event_ts") -> Column:
    return F.expr(quality_sql(cfg, time_col))


def guarded(pred: Column, time_col: str = "event_ts") -> Column:
    """Wrap a predicate so it mentions the event-time column.

    Catalyst pushes a filter below ``withWatermark`` when the filter does not
    reference the event-time column; then rejected rows would still advance
    the watermark.  This single CASE expression stays above the watermark.
    """
    return F.when(F.col(time_col).isNotNull(), pred).otherwise(F.lit(False))


def clean(events: DataFrame, cfg: EngineConfig, *, guard: bool = False, time_col: str = "event_ts") -> DataFrame:
    """Keep rows passing the quality rules.

    With ``quality_filter=False`` only rows without an event time are
    dropped: such rows cannot be placed in any window.
    """
    if not cfg.quality_filter:
        return events.filter(F.col(time_col).isNotNull())
    pred = quality_predicate(cfg, time_col)
    return events.filter(guarded(pred, time_col) if guard else pred)


def judged(events: DataFrame, cfg: EngineConfig, time_col: str = "event_ts") -> DataFrame:
    """All rows, with the first failing rule as ``reason``; null for a row that passes.

    Same predicates as :func:`clean`, negated null-safely (a null comparison
    counts as failing).
    """
    reason = F.lit(None).cast("string")
    for name, rule in reversed(_rules(cfg, time_col)):
        reason = F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)).otherwise(reason)
    return events.withColumn("reason", reason)


def rejects(events: DataFrame, cfg: EngineConfig, time_col: str = "event_ts") -> DataFrame:
    """Rows the quality rules drop, with their ``reason``; ``clean`` and ``rejects`` partition the input."""
    return judged(events, cfg, time_col).filter(F.col("reason").isNotNull())
