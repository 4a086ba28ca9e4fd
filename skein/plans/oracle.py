"""DuckDB SQL equivalents of the registered queries.

Tables are the pre-registered views over the parquet files.  The common
table expressions restate the table -> sensor-event mapping and the
manufacturer rows in SQL; aggregates work on the raw readings.
"""

from __future__ import annotations

from skein.sources.dimensions import MANUFACTURER_ROWS, SENSOR_ROWS


def _values(rows, types) -> str:
    def lit(v, t):
        if t == "str":
            return "'" + str(v).replace("'", "''") + "'"
        return f"CAST({v} AS {t})"

    return ", ".join("(" + ", ".join(lit(v, t) for v, t in zip(r, types)) + ")" for r in rows)


MANUFACTURERS_CTE = (
    "m(id, manufacturer_name, country) AS (VALUES "
    + _values([r[:3] for r in MANUFACTURER_ROWS], ["SMALLINT", "str", "str"])
    + ")"
)
SENSORS_CTE = (
    "s(sensor_id, manufacturer_id) AS (VALUES "
    + _values(SENSOR_ROWS, ["str", "SMALLINT"])
    + ")"
)

EVENTS_CTE = """ev AS (
  SELECT event_id,
         'sensor-' || lpad(CAST(user_id % 10 + 1 AS VARCHAR), 3, '0') AS sensor_id,
         CAST((user_id % 10) // 2 + 1 AS SMALLINT) AS manufacturer_id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time,
         value AS temperature,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) * 1.25 AS humidity,
         ts AS event_ts
  FROM events)"""

CLEAN_PRED = """sensor_id IS NOT NULL AND manufacturer_id IS NOT NULL
  AND event_time IS NOT NULL AND event_ts IS NOT NULL
  AND temperature IS NOT NULL AND humidity IS NOT NULL
  AND temperature BETWEEN -50.0 AND 80.0 AND humidity BETWEEN 0.0 AND 100.0"""

CLEAN_CTE = f"clean AS (SELECT * FROM ev WHERE {CLEAN_PRED})"

ENRICHED_CTE = """enriched AS (
  SELECT c.event_id, c.sensor_id, c.manufacturer_id, m.manufacturer_name, m.country,
         c.event_time, c.event_ts, c.temperature, c.humidity
  FROM clean c JOIN m ON c.manufacturer_id = m.id)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = with_ctes(MANUFACTURERS_CTE, EVENTS_CTE, CLEAN_CTE, ENRICHED_CTE)

FINE_CTE = """fine AS (
  SELECT * REPLACE (temperature + (event_id % 97) / 10000.0 AS temperature, humidity + (event_id % 89) / 10000.0 AS humidity) FROM ev)"""
FINE_BASE = with_ctes(
    MANUFACTURERS_CTE, EVENTS_CTE, FINE_CTE, CLEAN_CTE.replace("FROM ev", "FROM fine"), ENRICHED_CTE
)


PRECISE_CTE = """precise AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 5 = 0 THEN floor(temperature) + 0.01499999999::DOUBLE ELSE temperature + CAST(event_id % 9973 AS DOUBLE) / 997300.0::DOUBLE END AS temperature,
    CASE WHEN event_id % 5 = 0 THEN floor(humidity) + 0.00499999999::DOUBLE ELSE humidity + CAST(event_id % 9901 AS DOUBLE) / 990100.0::DOUBLE END AS humidity) FROM ev)"""
UNFILTERED_CTE = """unfiltered AS (
  SELECT c.*, m.manufacturer_name, m.country FROM precise c JOIN m ON c.manufacturer_id = m.id WHERE c.event_ts IS NOT NULL)"""
PRECISE_BASE = with_ctes(
    MANUFACTURERS_CTE, EVENTS_CTE, PRECISE_CTE, CLEAN_CTE.replace("FROM ev", "FROM precise"), ENRICHED_CTE, UNFILTERED_CTE
)
HOT_CTE = """hot AS (
  SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN CAST(1 AS SMALLINT) ELSE manufacturer_id END AS manufacturer_id) FROM precise)"""
HOT_BASE = with_ctes(MANUFACTURERS_CTE, EVENTS_CTE, PRECISE_CTE, HOT_CTE, CLEAN_CTE.replace("FROM ev", "FROM hot"), ENRICHED_CTE)

# Versions of the manufacturers; ``later`` stands for the rows that begin at the middle hour.
VERSIONED_BASE = with_ctes(
    MANUFACTURERS_CTE, EVENTS_CTE, CLEAN_CTE,
    "middle AS (SELECT date_trunc('hour', make_timestamp((epoch_us(min(event_ts)) + epoch_us(max(event_ts))) // 2)) AS t FROM ev)",
    "later(id, manufacturer_name, country) AS (VALUES {later})",
    """named AS (
  SELECT c.*, coalesce(l.manufacturer_name, m.manufacturer_name) AS manufacturer_name, coalesce(l.country, m.country) AS country
  FROM clean c CROSS JOIN middle LEFT JOIN m ON c.manufacturer_id = m.id LEFT JOIN later l ON c.manufacturer_id = l.id AND c.event_ts >= middle.t
  WHERE m.id IS NOT NULL OR l.id IS NOT NULL)""",
)


# The dirty records, written and parsed again with DuckDB's own functions.
DIRTY_CTES = r"""wire AS (
  SELECT event_id, event_id % 12 AS k,
    strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') AS t, CAST(manufacturer_id AS VARCHAR) AS mid,
    CASE WHEN temperature IS NULL THEN NULL ELSE CAST(to_json(temperature) AS VARCHAR) END AS heat,
    CASE WHEN humidity IS NULL THEN NULL ELSE CAST(to_json(humidity) AS VARCHAR) END AS wet, sensor_id FROM ev),
record AS (
  SELECT event_id, CASE WHEN k = 7 THEN substr(w, 1, 40) WHEN k = 11 THEN 'not a record' ELSE w END AS v FROM (
    SELECT event_id, k, '{"sensor_id":' || CASE WHEN k = 10 THEN 'null' ELSE '"' || sensor_id || '"' END
      || ',"manufacturer_id":' || CASE k WHEN 1 THEN '"' || mid || '"' WHEN 3 THEN '70000' WHEN 8 THEN mid || '.9' ELSE mid END
      || ',"event_time":"' || CASE k WHEN 4 THEN t || '+03:00' WHEN 5 THEN t WHEN 6 THEN substr(t, 1, 19) || '+00:00' ELSE t || '+00:00' END || '"'
      || CASE k WHEN 2 THEN '' WHEN 1 THEN ',"temperature":"' || heat || '"' WHEN 9 THEN ',"temperature":"warm"' ELSE ',"temperature":' || heat END
      || ',"humidity":' || wet || '}' AS w FROM wire)),
field AS (
  SELECT event_id, v, CASE WHEN json_valid(v) THEN v END AS j FROM record),
dirty AS (
  SELECT event_id, v, json_extract_string(j, '$.sensor_id') AS sensor_id,
    CASE WHEN regexp_full_match(json_extract_string(j, '$.manufacturer_id'), '-?\d+') THEN TRY_CAST(json_extract_string(j, '$.manufacturer_id') AS SMALLINT) END AS manufacturer_id,
    json_extract_string(j, '$.event_time') AS event_time,
    TRY_CAST(json_extract_string(j, '$.temperature') AS DOUBLE) AS temperature,
    TRY_CAST(json_extract_string(j, '$.humidity') AS DOUBLE) AS humidity,
    strptime(substr(event_time, 1, 19), '%Y-%m-%dT%H:%M:%S')
      + to_microseconds(CAST(coalesce(nullif(regexp_extract(event_time, '\.(\d{6})', 1), ''), '0') AS BIGINT))
      - to_hours(CAST(coalesce(nullif(regexp_extract(event_time, '\+(\d\d):', 1), ''), '0') AS INTEGER)) AS event_ts
  FROM field)"""
DIRTY_BASE = with_ctes(EVENTS_CTE, DIRTY_CTES)


def fmt_ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') || '.000'"


def window_sql(interval: str, source: str = "enriched", closed_by: str | None = None, delay: str = "10 seconds", half_even: bool = False, still_open: bool = False) -> str:
    """Window results over ``source`` bucketed by ``interval`` (DuckDB).

    ``closed_by``: keep only windows a watermark of ``max(event_ts) - delay``
    over that relation has closed (what an append-mode stream emits), or with
    ``still_open`` those that it has not.
    """
    # Raw readings: their decimal texts added up as whole numbers of 10^-18, one rounding at the end.
    if half_even:
        avg = "CAST(printf('%.2f', CAST(sum(CAST(round(temperature * 1e6) AS HUGEINT)) AS DOUBLE) / 1e6 / count(*)) AS DOUBLE)"
        med = "CAST(printf('%.2f', quantile_cont(humidity, 0.5)) AS DOUBLE)"
    else:
        text = lambda c: f"CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,18))"
        whole = lambda d: f"CAST(replace(CAST({d} AS VARCHAR), '.', '') AS HUGEINT)"
        cents = lambda u, n: f"sign({u}) * CAST((2 * abs({u}) + CAST({n} AS HUGEINT) * 10000000000000000) // (CAST({n} AS HUGEINT) * 20000000000000000) AS DOUBLE) / 100"
        avg = cents(whole(f"sum({text('temperature')})"), "count(*)")
        place = lambda k: text(f"list(humidity ORDER BY humidity)[{k}]")
        med = cents(whole(f"{place('(count(*) + 1) // 2')} + {place('count(*) // 2 + 1')}"), "2")
    inner = f"""
  SELECT time_bucket(INTERVAL '{interval}', event_ts) AS wb,
         manufacturer_id, manufacturer_name, country,
         count(*) AS events_count, {avg} AS avg_temperature, {med} AS median_humidity
  FROM {source}
  GROUP BY 1, 2, 3, 4"""
    where = ""
    if closed_by:
        where = f"WHERE wb + INTERVAL '{interval}' {'>' if still_open else '<='} (SELECT max(event_ts) - INTERVAL '{delay}' FROM {closed_by})"
    return f"""
SELECT {fmt_ts("wb")} AS window_start, {fmt_ts(f"wb + INTERVAL '{interval}'")} AS window_end,
       manufacturer_id, manufacturer_name, country, events_count, avg_temperature, median_humidity
FROM ({inner}) {where}"""


def json_object(cols: list[str]) -> str:
    """Compact JSON object text in column order (DuckDB), same shape as
    Spark's ``to_json(struct(...))``."""
    parts = [f"'\"{c}\":' || coalesce(to_json({c}), 'null')" for c in cols]
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


RESULT_JSON = json_object(
    [
        "window_start",
        "window_end",
        "manufacturer_id",
        "manufacturer_name",
        "country",
        "events_count",
        "avg_temperature",
        "median_humidity",
    ]
)
