"""Every registered query next to its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import check
from marketlens.plans.catalogue import QUERIES, TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    _, n, verdict = check.compare(spark, sql, name, SF)
    assert n > 0 and verdict in ("ok", "rows only"), verdict


def test_only_the_factorisation_has_no_sql():
    assert set(QUERIES) - set(entry.oracle_sql()) == {"als_recommendations", "als_user_top5"}


def test_entry(spark):
    assert entry.entry(spark).columns == ["title", "total_quantity_sold"]
