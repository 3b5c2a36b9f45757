"""Registered queries against their SQL, and plans of the native operators."""

import duckdb
import pytest
from conftest import SMALL
from oracle_compare import differences

from creditweave.llm.oracles import ORACLES
from creditweave.llm.queries import QUERIES


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, db, name):
    assert differences(spark, db, SMALL, name) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_covers_every_document(spark, name):
    ids = {r.doc_id for r in QUERIES[name](spark, SMALL).collect()}
    assert ids == {r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id").collect()}
