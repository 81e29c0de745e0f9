"""Every registered query against the same query in DuckDB."""

import pytest

import __spark_entry__ as spark_entry
from oracle import sql
from oracle.compare import connect, difference

QUERIES = spark_entry.own_queries()
ORACLE = sql.all_queries()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(name, spark, duck, sf_dir):
    frame = QUERIES[name](spark, sf_dir)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan
    assert difference(frame, duck, ORACLE[name]) is None


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).count() > 0
