"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01); rows-only queries must run."""

import pytest

import __spark_entry__ as E
from oracle_check import compare, duck

from conftest import SF_SMALL

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    info = compare(spark, con, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL)
    assert info["status"] in ("ok", "rows-only"), info


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == E.entry(spark).columns
