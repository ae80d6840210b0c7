"""Every named query against its DuckDB oracle on the smoke tables (the driver runs the same at sf0.01)."""

import pytest

import __spark_entry__ as entry_module
from ebbflow.plans import ORACLES, QUERIES
from tests.conftest import SF_SMOKE
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, SF_SMOKE, name, con)
    assert ok, msg


def test_every_query_runs(spark):
    for name, fn in QUERIES.items():
        assert name in entry_module.queries()
        df = fn(spark, SF_SMOKE)
        assert df.columns, name


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert df.columns == ["station_id", "station_name", "net_change", "final_balance"]
