"""All registered queries against their SQL, and their plans."""

import re

import pytest

import __spark_entry__ as entry
from oracle import connect, difference
from tablewright.catalog.queries import QUERIES

NO_SQL: set[str] = set()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() == 150 and "billing_ratio" in df.columns


def test_every_query_has_sql():
    assert set(QUERIES) - set(entry.oracle_sql()) == NO_SQL
    assert not set(entry.oracle_sql()) - set(entry.queries())


# Read by a data source of our own, which is Python; nothing above the scan may be.
PYTHON_SOURCES = {"raw_file_audit"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in NO_SQL])
def test_query(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    if name in PYTHON_SOURCES:
        plan = re.sub(r"BatchScan file_prefix.*\(Python\)", "BatchScan", plan)
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert difference(df, con, entry.oracle_sql()[name]) is None
