"""Event-time parsing and formatting.

All expressions assume the session time zone is UTC (see
:mod:`skein.session`).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.config import WINDOW_TEXT_FORMAT

# Wire format of event times written by the engine: ISO-8601, always six
# fractional digits, numeric offset.
WIRE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_ts(event_time="event_time", mode: str = "iso", strict: bool = False) -> Column:
    """Parse the wire ``event_time`` text into a TIMESTAMP.

    iso       offset honoured and converted to UTC, naive text read as UTC,
              any number of fractional digits (also none).
    prefix23  the first 23 characters with 'T' replaced by a space; the offset
              is cut off, not applied, digits past milliseconds are dropped,
              and text without a fraction keeps part of the offset and yields
              null.

    Lenient (default) gives null for text that does not parse; ``strict``
    raises instead.
    """
    text = _col(event_time)
    if mode == "iso":
        if strict:
            return text.cast("timestamp")
        return text.try_cast("timestamp")
    if mode == "prefix23":
        cut = F.replace(F.substring(text, 1, 23), F.lit("T"), F.lit(" "))
        if strict:
            return F.to_timestamp(cut)
        return F.try_to_timestamp(cut)
    raise ValueError(f"unknown time mode {mode!r}")


def event_time_wire(ts="event_ts") -> Column:
    """TIMESTAMP -> wire text, e.g. ``2026-06-05T18:13:42.123456+00:00``."""
    return F.date_format(_col(ts), WIRE_TIME_FORMAT)


def window_text(bound) -> Column:
    """Window bound -> ``yyyy-MM-dd HH:mm:ss.SSS`` (a plain cast drops ``.000``)."""
    return F.date_format(_col(bound), WINDOW_TEXT_FORMAT)
