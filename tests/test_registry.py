"""A choice of the registered queries beside their SQL, on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as driver
from check import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"
CHOICE = (
    "sales_by_district",
    "sales_by_building",
    "sales_metrics_hot_groups",
    "cleaned_raw_sales",
    "geocode_cascade",
    "points_in_overlapping_blocks",
    "geocoding_coverage",
    "normalized_streets",
    "district_timeline",
    "quartier_map",
)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_sql_belongs_to_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_flagship_query(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", CHOICE)
def test_query_equals_sql(spark, duck, name):
    frame = driver.queries()[name](spark, SF_DIR)
    answer = duck.execute(driver.oracle_sql()[name])
    names = [item[0] for item in answer.description]
    assert sorted(names) == sorted(frame.columns)
    assert rows_of(frame.columns, [tuple(row) for row in frame.collect()]) == rows_of(names, answer.fetchall())
