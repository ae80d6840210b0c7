"""The queries of this part that SQL can express, against DuckDB on the smoke tables."""

import pytest

from ebbflow.llm.oracles import ORACLES
from ebbflow.llm.queries import QUERIES
from tests.oracle_compare import compare, duck

SMOKE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    ok, message = compare(spark, SMOKE, name, duck(SMOKE))
    assert ok, message


def test_one_query_of_each_number():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
