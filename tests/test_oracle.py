"""Every registered query that has an SQL twin equals DuckDB on sf0.01."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from skein.plans.queries import ORACLE, REGISTRY  # noqa: E402
from check_oracle import compare  # noqa: E402
from conftest import SF01  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, name):
    rep = compare(spark, SF01, [name])[name]
    assert rep["cols_match"], rep
    assert rep["rows"] == rep["oracle_rows"], rep
    assert rep["hash_match"], rep


def test_every_query_runs_on_smoke_data(spark):
    df = E.entry(spark)
    assert df.columns == [
        "window_start", "window_end", "manufacturer_id", "manufacturer_name", "country",
        "events_count", "avg_temperature", "median_humidity",
    ]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(REGISTRY)
    assert set(REGISTRY) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())
