"""Every registered query against its SQL in DuckDB, value by value."""

import math
import os

import duckdb
import pytest

from marquee.suite.oracle import ORACLE_SQL
from marquee.suite.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return None if math.isnan(v) else repr(v)
        return v

    out = [tuple(cell(r[i]) for i in order) for r in records]
    return sorted(columns), sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_each_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = rows(df.columns, df.collect())
    rel = duck.execute(ORACLE_SQL[name])
    want = rows([d[0] for d in rel.description], rel.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "the query gives rows on the test tables"
    # Integers, text and truth values must agree in kind as well.
    kinds = {c: {type(r[i]) for r in got[1]} - {type(None)} for i, c in enumerate(got[0])}
    wanted = {c: {type(r[i]) for r in want[1]} - {type(None)} for i, c in enumerate(want[0])}
    assert kinds == wanted
