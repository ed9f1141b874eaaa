"""Every registered query against its DuckDB oracle on the smoke-scale tables."""

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

from conftest import SF_SMALL

# the text queries have their own tests
QUERIES = {name: q for name, q in E.queries().items() if name in E._REGISTRY}
ORACLE = {name: sql for name, sql in E.oracle_sql().items() if name in E._REGISTRY}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    ok, msg = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["table_id", "title", "var1", "val1", "n"]
    assert df.count() > 0


def test_queries_are_lazy(spark):
    """Building every registered query runs no Spark job (the driver collects)."""
    tracker = spark.sparkContext.statusTracker()
    spark.range(1).count()                       # settle any pending job ids
    before = set(tracker.getJobIdsForGroup(None))
    frames = [q(spark, SF_SMALL) for q in QUERIES.values()]
    after = set(tracker.getJobIdsForGroup(None))
    assert len(frames) == len(QUERIES)
    assert after == before, f"jobs started while building queries: {sorted(after - before)}"
