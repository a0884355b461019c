"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from basketloom.plans.catalog import QUERIES
from basketloom.plans.oracles import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["orders", "lineitem", "part", "events"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


def ordered(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows[sorted(rows.columns)]
    return rows.sort_values(list(rows.columns)).reset_index(drop=True)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.sql(ORACLES[name])
    names = {"string": "varchar", "int": "integer"}
    assert {c: names.get(t, t) for c, t in ours.dtypes} == {
        c: str(t).lower() for c, t in zip(theirs.columns, theirs.types)
    }
    pd.testing.assert_frame_equal(
        ordered(ours.toPandas()), ordered(theirs.df()), check_dtype=False, check_exact=True
    )
