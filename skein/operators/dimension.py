"""Dimension maintenance and integrity rules.

Database constraints of the original schema (primary keys, NOT NULL,
UNIQUE, foreign key, length limits) become data-quality jobs that return
the violating rows; ``INSERT ... ON CONFLICT DO UPDATE`` becomes an upsert
that writes a new version instead of editing files in place.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.session import fresh_path

# Column length limits of the original schema.
LENGTH_LIMITS = {
    "manufacturers": {"manufacturer_name": 128, "country": 64},
    "sensors": {"sensor_id": 64},
}


def upsert_dimension(base: DataFrame, updates: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``updates`` replace rows of ``base`` with the same key; new
    keys are inserted; other base rows are kept.  Re-running with the same
    updates gives the same table.  One full join: the updates, which may
    come from a scan of all events, are computed once."""
    new = updates.select(*[F.col(c).alias(f"_new_{c}") for c in base.columns], F.lit(True).alias("_new"))
    same = [base[c] == new[f"_new_{c}"] for c in key]
    both = base.join(new, same, "full_outer")
    return both.select(*[F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(base[c]).alias(c) for c in base.columns])


def write_version(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write a dimension as a new version under the shared folder and read
    it back.  Files under a running query are never replaced (that breaks
    it); readers switch to the new version by path."""
    path = fresh_path(spark, "dimensions", name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def latest_per_key(events: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """Last reported SMALLINT ``value`` per ``key`` by the TIMESTAMP ``order``
    (ties broken by the larger value, so the choice is deterministic).

    ``(order, value)`` is packed into one exact DECIMAL(38,0),
    ``micros * 100000 + (value + 32768)``, whose ``max`` is a fixed-width
    buffer: a hash aggregate with partial aggregation per task, instead of
    the sort-based aggregate a struct-ordered ``max_by`` would need.  Rows
    without an order value cannot be placed and are skipped.
    """
    offset = 32768  # SMALLINT -> 0..65535, below the 10^5 slot
    slot = F.lit(100000).cast("decimal(38,0)")
    packed = F.unix_micros(F.col(order)).cast("decimal(38,0)") * slot + (F.col(value).cast("int") + offset)
    best = events.filter(F.col(order).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(
        F.max(packed.cast("decimal(38,0)")).alias("_p")
    )
    decoded = (F.pmod(F.col("_p"), slot).cast("int") - offset).cast("smallint")
    return best.select(key, decoded.alias(value))


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def fk_violations(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose (non-null) foreign key has no parent row."""
    parent_keys = parent.select(F.col(pk).alias(fk)).distinct()
    return child.filter(F.col(fk).isNotNull()).join(parent_keys, fk, "left_anti")


def rule_report(
    manufacturers: DataFrame,
    sensors: DataFrame,
) -> DataFrame:
    """All violations as ``table, rule, column, key, n``."""

    def rows(df, table, rule, column, key_expr, n_expr=F.lit(1).cast("long")):
        return df.select(
            F.lit(table).alias("table"),
            F.lit(rule).alias("rule"),
            F.lit(column).alias("column"),
            key_expr.cast("string").alias("key"),
            n_expr.cast("long").alias("n"),
        )

    parts = [
        rows(duplicate_keys(manufacturers, ["id"]), "manufacturers", "primary_key", "id", F.col("id"), F.col("n")),
        rows(duplicate_keys(sensors, ["sensor_id"]), "sensors", "primary_key", "sensor_id", F.col("sensor_id"), F.col("n")),
        rows(
            duplicate_keys(manufacturers.filter(F.col("manufacturer_name").isNotNull()), ["manufacturer_name"]),
            "manufacturers", "unique", "manufacturer_name", F.col("manufacturer_name"), F.col("n"),
        ),
        rows(manufacturers.filter(F.col("id").isNull()), "manufacturers", "not_null", "id", F.col("manufacturer_name")),
        rows(manufacturers.filter(F.col("manufacturer_name").isNull()), "manufacturers", "not_null", "manufacturer_name", F.col("id")),
        rows(manufacturers.filter(F.col("country").isNull()), "manufacturers", "not_null", "country", F.col("id")),
        rows(sensors.filter(F.col("sensor_id").isNull()), "sensors", "not_null", "sensor_id", F.col("manufacturer_id")),
        rows(sensors.filter(F.col("manufacturer_id").isNull()), "sensors", "not_null", "manufacturer_id", F.col("sensor_id")),
        rows(
            fk_violations(sensors, "manufacturer_id", manufacturers, "id"),
            "sensors", "foreign_key", "manufacturer_id", F.col("sensor_id"),
        ),
    ]
    for table, df, key in (("manufacturers", manufacturers, "id"), ("sensors", sensors, "sensor_id")):
        for column, limit in LENGTH_LIMITS[table].items():
            parts.append(
                rows(df.filter(F.length(column) > limit), table, f"max_length_{limit}", column, F.col(key))
            )
    return reduce(DataFrame.unionByName, parts)
