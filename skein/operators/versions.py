"""A dimension that changes over time: versions with a span of validity, and the join as of an event's time.

A version holds from ``valid_from`` (null: since ever) up to, not including,
``valid_to`` (null: until further notice).  An event takes the version that is
valid at its own event time, so its names don't depend on when it is processed:
a replay gives what the live run gave.  An event at whose time its id has no
version drops out, as unknown ids do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.enrich import DIM_COLUMNS

VERSION_COLUMNS = [*DIM_COLUMNS, "valid_from", "valid_to"]


def dimension_versions(updates: DataFrame, key: str = "id", at: str = "valid_from") -> DataFrame:
    """Updates (rows of the dimension, each with the time it takes effect) as versions that follow one another.

    ``(key, at)`` must be unique; :func:`skein.sources.dimensions.load_dimension` checks it.
    """
    w = Window.partitionBy(key).orderBy(F.col(at).asc_nulls_first())
    return updates.withColumn("valid_to", F.lead(at).over(w))


def valid_at(time: Column, since: Column, until: Column) -> Column:
    return (since.isNull() | (since <= time)) & (until.isNull() | (time < until))


def with_version(events: DataFrame, versions: DataFrame) -> DataFrame:
    """``events`` of known manufacturers with ``valid_from`` of the version of their time.

    An equi-join on the id with the span as a further condition.  Spans of an
    id don't overlap, so no event is doubled; of the version only the time goes
    along, the names are joined to the aggregated rows.
    """
    spans = versions.select(F.col("id").alias("_dim_id"), "valid_from", "valid_to")
    at = valid_at(events["event_ts"], spans["valid_from"], spans["valid_to"])
    kept = [c for c in events.columns if c != "valid_from"]
    return events.join(spans, (events["manufacturer_id"] == spans["_dim_id"]) & at).select(*[events[c] for c in kept], spans["valid_from"])
