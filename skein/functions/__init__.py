"""Column expressions (all JVM-side built-ins except the optional rounding UDF)."""

from skein.functions.timefmt import event_ts, event_time_wire, window_text
from skein.functions.rounding import binary_half_even
from skein.functions.jsonfmt import result_json, event_value_json, event_key

__all__ = [
    "event_ts",
    "event_time_wire",
    "window_text",
    "binary_half_even",
    "result_json",
    "event_value_json",
    "event_key",
]
