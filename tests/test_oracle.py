"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                                "tools"))

SF = "/root/testdata/sf0.001"

import __spark_entry__ as E  # noqa: E402
from check_oracle import duck, rows_of  # noqa: E402

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("driver test tables not present")
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    sql = E.oracle_sql().get(name)
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return
    rel = con.execute(sql)
    onames = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(onames)
    assert rows_of(df.columns, rows) == rows_of(onames, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
