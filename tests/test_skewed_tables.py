"""The registered queries on tables in which single keys hold a third of all rows."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries
from marquee.operators import skew
from tests.test_oracle import TABLES, rows

SOURCE = "/root/testdata/sf0.001"

# A third of the rows of each table are copies of one row, or fall to one key.
SKEW = {
    "orders": """
SELECT * FROM src UNION ALL
SELECT c.* FROM (SELECT * FROM src WHERE o_orderkey = 12) c, range((SELECT count(*) // 2 FROM src))""",
    "lineitem": """
SELECT * FROM src UNION ALL SELECT * REPLACE (CAST(12 AS BIGINT) AS l_orderkey) FROM src
UNION ALL SELECT * REPLACE (CAST(5 AS BIGINT) AS l_partkey) FROM src""",
    "customer": """
SELECT * FROM src UNION ALL
SELECT c.* FROM (SELECT * FROM src WHERE c_custkey = 7) c, range((SELECT count(*) // 2 FROM src))""",
    "part": """
SELECT * FROM src UNION ALL
SELECT c.* FROM (SELECT * FROM src WHERE p_partkey = 5) c, range((SELECT count(*) // 2 FROM src))""",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE OR REPLACE VIEW src AS SELECT * FROM '{SOURCE}/{t}.parquet'")
        con.execute(f"COPY ({SKEW.get(t, 'SELECT * FROM src')}) TO '{folder}/{t}.parquet'")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return str(folder), con


@pytest.fixture(autouse=True)
def small_tasks(monkeypatch):
    monkeypatch.setattr(skew, "ROWS_PER_TASK", 60)


def test_hot_keys_are_found(spark, skewed):
    for name, key, value in (("orders", "o_orderkey", 12), ("customer", "c_custkey", 7)):
        df = spark.read.parquet(f"{skewed[0]}/{name}.parquet")
        assert [r["key"] for r in skew.heavy_parts({name: df}, key).collect()] == [value]


@pytest.mark.parametrize(
    "name",
    """raw_title_basics raw_title_ratings raw_name_basics join_title_ratings explode_genre genre_stats
    popularity_score decade_bucket join_known_ratings person_rating_summary decade_stats
    top_k_movies top_talent_by_profession report_talent report_top_movies sort_desc""".split(),
)
def test_query_matches_sql(spark, skewed, name):
    folder, con = skewed
    df = queries()[name](spark, folder)
    rel = con.execute(oracle_sql()[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in rel.description], rel.fetchall())
