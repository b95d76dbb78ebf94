"""Every registered query at the smallest scale, against its SQL where there is one."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from rivalry.queries import all_oracles, all_queries
from tools.check_queries import TABLES, normal

SF = "/root/testdata/sf0.001"
NO_SQL: set[str] = set()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_no_query_lacks_sql():
    assert set(all_queries()) - set(all_oracles()) == NO_SQL
    assert set(all_oracles()) <= set(all_queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_matches_sql(spark, db, name):
    """The same rows, from a plan that stays inside the JVM."""
    found = entry.queries()[name](spark, SF)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|ArrowEval|MapIn|Pandas|InArrow", plan)
    got = found.toPandas()
    want = db.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = normal(got), normal(want)
    assert len(a) == len(b) and a.equals(b)

