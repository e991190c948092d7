"""The driver contract: entry, query registry, and every query against its DuckDB SQL at sf0.001."""

import os

import pytest

import __spark_entry__ as E
from rowsmith.plans import oracle as O
from rowsmith.plans import queries as Q
from rowsmith.plans.check import _canon, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["word", "cnt"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    # every query of the library itself has its SQL
    assert set(Q.queries()) == set(O.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    sc, sr = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    dc, dr = _canon([c[0] for c in res.description], res.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
