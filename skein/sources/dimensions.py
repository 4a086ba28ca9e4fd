"""Dimension tables (manufacturers, sensors).

Dimensions are small and bounded by nature; each is checked to be non-empty
before use (an empty dimension would silently turn an inner join into no
output) and, in snapshot mode, pinned by writing it once to the shared folder
so every micro-batch sees the same rows and a lost executor can re-read them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.schemas import MANUFACTURERS, SENSORS
from skein.session import fresh_path

# The seeded reference data (id, name, country; no query reads
# the descriptions, which stay null) and the sensors (sensor id, manufacturer id).
MANUFACTURER_ROWS = [
    (1, "Bosch Sensortec", "Germany", None),
    (2, "Sensirion", "Switzerland", None),
    (3, "Honeywell", "United States", None),
    (4, "Texas Instruments", "United States", None),
]
SENSOR_ROWS = [
    ("sensor-001", 1),
    ("sensor-002", 1),
    ("sensor-003", 2),
    ("sensor-004", 2),
    ("sensor-005", 3),
    ("sensor-006", 3),
    ("sensor-007", 4),
    ("sensor-008", 4),
]


def _sql_literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def literal_table(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """Small literal table as an SQL ``VALUES`` list: a local relation that
    lives in the plan itself (no job to read it, and Catalyst knows its
    size), cast to the declared schema."""
    names = [f.name for f in schema.fields]
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


def manufacturers_seed(spark: SparkSession) -> DataFrame:
    return literal_table(spark, MANUFACTURER_ROWS, MANUFACTURERS)


def sensors_seed(spark: SparkSession) -> DataFrame:
    return literal_table(spark, SENSOR_ROWS, SENSORS)


def read_jdbc(
    spark: SparkSession,
    url: str,
    *,
    table: str | None = None,
    query: str | None = None,
    properties: dict | None = None,
    schema=MANUFACTURERS,
) -> DataFrame:
    """Dimension over JDBC, cast to the declared schema.

    Filters and column pruning of later operators are pushed into the
    database query by Spark's JDBC source.  Some databases return SMALLINT
    as INT; the cast restores the declared type.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if table:
        reader = reader.option("dbtable", table)
    elif query:
        reader = reader.option("query", query)
    else:
        raise ValueError("give table or query")
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    df = reader.load()
    names = {c.lower(): c for c in df.columns}
    cols = [
        F.col(names[f.name.lower()]).cast(f.dataType).alias(f.name)
        for f in schema.fields
        if f.name.lower() in names
    ]
    return df.select(*cols)


def require_non_empty(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(f"dimension {what} is empty")
    return df


def pin_snapshot(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Write the rows once to the shared folder and read them back.

    Later micro-batches see exactly these rows even if the source changes,
    and the copy survives the loss of any executor (unlike a local
    checkpoint).
    """
    path = fresh_path(spark, "snapshots", name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def require_unique(df: DataFrame, key: str | list[str], what: str) -> DataFrame:
    """A repeated key would split a window's rows or count events twice."""
    keys = [key] if isinstance(key, str) else key
    twice = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if twice:
        raise RuntimeError(f"dimension {what}: {', '.join(keys)} {', '.join(map(str, twice[:-1]))} occurs {twice[-1]} times")
    return df


def load_dimension(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    mode: str = "snapshot",
    columns: list[str] | None = None,
    key: str | list[str] | None = "id",
) -> DataFrame:
    """Project and pin (snapshot) or keep live (refresh, versions); checks that
    there are rows and that ``key`` is unique (of a live one: at the start)."""
    if columns:
        df = df.select(*columns)
    if mode == "snapshot":
        df = pin_snapshot(df, spark, name)
    require_non_empty(df, name)
    return require_unique(df, key, name) if key else df
