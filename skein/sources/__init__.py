"""Inputs: sensor events (batch, stream, table adapter) and dimensions."""

from skein.sources.events import (
    decode_events,
    read_event_batch,
    read_event_stream,
    sensor_events_from_table,
    table_event_stream,
)
from skein.sources.dimensions import (
    load_dimension,
    manufacturers_seed,
    read_jdbc,
    require_non_empty,
    sensors_seed,
    pin_snapshot,
)

__all__ = [
    "decode_events",
    "read_event_batch",
    "read_event_stream",
    "sensor_events_from_table",
    "table_event_stream",
    "load_dimension",
    "manufacturers_seed",
    "read_jdbc",
    "require_non_empty",
    "sensors_seed",
    "pin_snapshot",
]
