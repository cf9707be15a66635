"""Every catalog query against its SQL statement on the same tables."""

from __future__ import annotations

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from hourgrid.plans import catalog, oracle

FOLDER = os.environ.get("HOURGRID_TEST_DATA", "/root/testdata/sf0.01")
QUERIES = catalog.QUERIES
ORACLE = oracle.SQL

pytestmark = pytest.mark.skipif(
    not Path(FOLDER).is_dir(), reason="generated tables are not available"
)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLE[name])
    columns = [column[0] for column in result.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = _sorted_rows(columns, result.fetchall())
    assert expected, "the comparison must not be empty"
    assert _sorted_rows(ours.columns, ours.collect()) == expected


def test_every_query_has_sql_unless_it_fits_a_model():
    assert set(QUERIES) - set(ORACLE) == {"forecast_gbt", "forecast_trend_seasonal"}


@pytest.mark.parametrize("name", ["forecast_gbt", "forecast_trend_seasonal"])
def test_model_queries_cover_the_horizon(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    assert len(rows) == 5 * 72
    assert len({(r.building_id, r.timestamp_hour) for r in rows}) == len(rows)
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in rows)


def test_entry_returns_rows(spark):
    result = entry_points.entry(spark)
    assert result.columns[:2] == ["building_id", "timestamp_hour"]
    assert result.count() == 552
