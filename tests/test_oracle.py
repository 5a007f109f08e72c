"""Every driver query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001, SF01
from tools.check_oracle import digest, duck

NAMES = sorted(E._library_queries())


@pytest.fixture(scope="module")
def con():
    return {SF001: duck(SF001), SF01: duck(SF01)}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    for sf in (SF001, SF01):
        df = E.queries()[name](spark, sf)
        rows = [tuple(r) for r in df.collect()]
        rel = con[sf].sql(E.oracle_sql()[name])
        orows = rel.fetchall()
        assert sorted(df.columns) == sorted(rel.columns)
        assert len(rows) == len(orows), sf
        assert digest(df.columns, rows)[0] == digest(rel.columns, orows)[0], sf


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["country", "total_repositories"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())
