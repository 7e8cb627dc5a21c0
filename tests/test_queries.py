"""Every registered query against the same query in another engine."""

import pytest

import __spark_entry__ as entry
from careflow.workload.oracle import ORACLE
from careflow.workload.queries import QUERIES
from tests.compare import connect, spark_rows, sql_rows
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def other(small):
    return connect(small)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, other, name):
    got = spark_rows(QUERIES[name](spark, SMALL))
    assert got == sql_rows(other, ORACLE[name])
    assert got[1] or name in ("summary_prescription_paid", "fact_prescription_paid")


def test_entry(spark, small):
    assert entry.entry(spark).count() > 0
