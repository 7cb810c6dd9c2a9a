"""Every named query equals its check SQL on the smallest test tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql
from check_oracle import TABLES, compare

from conftest import SMALL
from stayline.plans.oracle import ORACLE
from stayline.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_each_query_has_check_sql():
    assert set(QUERIES) == set(ORACLE) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).columns == ["user_id", "score", "risk_level", "reasons"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, SMALL, oracle_sql()[name]).startswith("ok")
