"""JSON message formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.timefmt import event_time_wire
from skein.schemas import EVENT_COLUMNS, RESULT_COLUMNS, UPSERT_KEY

# Compact JSON, field order kept, non-ASCII kept, null fields written.
JSON_OPTIONS = {"ignoreNullFields": "false"}


def result_json(cols: list[str] | None = None) -> Column:
    """Window result -> compact JSON object with the 8 fields in order."""
    return F.to_json(F.struct(*(cols or RESULT_COLUMNS)), JSON_OPTIONS)


def upsert_key_json() -> Column:
    return F.to_json(F.struct(*UPSERT_KEY), JSON_OPTIONS)


def event_value_json(ts_col: str = "event_ts") -> Column:
    """Sensor event -> wire JSON, event time as ISO text with offset."""
    fields = [
        F.col(c) if c != "event_time" else event_time_wire(ts_col).alias("event_time")
        for c in EVENT_COLUMNS
    ]
    return F.to_json(F.struct(*fields), JSON_OPTIONS)


def event_key(col: str = "sensor_id") -> Column:
    """Message key: UTF-8 bytes of the sensor id."""
    return F.encode(F.col(col), "UTF-8")
