"""The queries of the subpackage that have SQL against it in DuckDB, value by value."""

import os

import duckdb
import pytest

from marquee.llm.queries import LLM_QUERIES, LLM_SQL

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    want = con.execute(LLM_SQL[name])
    names = sorted(d[0] for d in want.description)
    place = [[d[0] for d in want.description].index(c) for c in names]
    got = LLM_QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == names
    own = sorted(tuple(r[c] for c in names) for r in got.collect())
    other = sorted(tuple(r[i] for i in place) for r in want.fetchall())
    assert [[(type(v), v) for v in r] for r in own] == [[(type(v), v) for v in r] for r in other]
