"""Every registered query against its DuckDB twin on the smallest tables.

The driver runs the same comparison at sf0.01; here sf0.001 keeps the suite
quick.  Queries without a twin (models, samples, sketches) must still run.
"""

import os

import pytest

import __spark_entry__ as E
from tests.oracle_check import compare, duck, type_diffs

SF = os.environ.get("VIGIL_TEST_SF", "/root/testdata/sf0.001")
QUERIES = E.queries()
SQLS = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in SQLS))
def test_query_matches_twin(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert type_diffs(df, con, SQLS[name]) == []
    sdf = df.toPandas()
    ddf = con.execute(SQLS[name]).df()
    ok, msg = compare(sdf, ddf)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in SQLS))
def test_query_without_twin_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.count() >= 0
    assert len(df.columns) > 0


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
