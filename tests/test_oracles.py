"""Every registered query with an oracle equals it, to the last bit."""

import duckdb
import pytest
from conftest import SMALL
from oracle_compare import connect, differences

from creditweave.plans.oracles import FINAL
from creditweave.plans.registry import QUERIES

@pytest.fixture(scope="module")
def db() -> duckdb.DuckDBPyConnection:
    return connect(SMALL)


def test_every_query_is_covered():
    assert set(QUERIES) == set(FINAL)


@pytest.mark.parametrize("name", sorted(FINAL))
def test_query_equals_oracle(spark, db, name):
    assert differences(spark, db, SMALL, name) == []
