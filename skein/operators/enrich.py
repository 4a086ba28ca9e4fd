"""Joining events to the manufacturer dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skein.schemas import ENRICHED_COLUMNS

DIM_COLUMNS = ["id", "manufacturer_name", "country"]


def enrich(events: DataFrame, manufacturers: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Inner equi-join ``manufacturer_id = id``; unknown manufacturers drop out.

    The planner broadcasts a dimension whose bytes are known to be few
    (literal rows, a pinned copy), so the large event side isn't shuffled;
    otherwise AQE decides by what it measures.  No extra job looks at the
    size.  On a stream this is a stateless stream-static join.
    """
    dim = manufacturers.select(*DIM_COLUMNS)
    joined = events.join(dim, events["manufacturer_id"] == dim["id"], "inner")
    cols = [c for c in ENRICHED_COLUMNS if c in joined.columns]
    return joined.select(*(keep or []), *cols)


def unknown_manufacturer(events: DataFrame, manufacturers: DataFrame) -> DataFrame:
    """Events whose manufacturer id has no dimension row (dropped by ``enrich``)."""
    dim = manufacturers.select("id")
    return events.join(dim, events["manufacturer_id"] == dim["id"], "left_anti")
