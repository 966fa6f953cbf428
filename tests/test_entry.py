"""Driver contract: entry smoke run, registry consistency, oracle equality at sf0.001."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as E  # noqa: E402
from finspark.plans.catalogue import load_all  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "rsi_14d" in df.columns and df.count() > 0


def test_registry_consistent():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    # every query of the catalogue is checked against an SQL oracle
    assert set(load_all()) - set(sql) == set()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_equal_small(spark, name):
    from oracle_check import duck, rows_of
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = [r.asDict(recursive=True) for r in sdf.collect()]
    cur = duck(SF).execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = [dict(zip(dcols, r)) for r in cur.fetchall()]
    assert sorted(dcols) == cols
    assert rows_of(srows, cols) == rows_of(drows, cols)
