"""Orders, top-k, positions and tokens."""

from pyspark.sql import functions as F

from marquee.operators import ranking
from marquee.operators.aggregates import global_count, global_max, word_count
from marquee.operators.generators import by_genre, tokens


def frame(spark):
    rows = [("a", 1.0), ("b", 2.0), ("c", None), ("d", 2.0), ("e", None), ("f", 0.5)]
    return spark.createDataFrame(rows, "k string, v double").repartition(3)


def keys(df):
    return "".join(r["k"] for r in df.collect())


def test_sorts_and_top_k(spark):
    df = frame(spark)
    assert keys(ranking.sort_desc(df, "v", "k")) == "bdafce"
    assert keys(ranking.top_k(df, "v", 3, "k")) == "bda"
    for k in (1, 3, 9):
        assert keys(ranking.top_k_above(df, "v", k, "k")) == "bdafce"[:k]
    assert keys(ranking.n_largest(df, "v", 3, "k")) == "bda"
    assert keys(ranking.n_largest(df, "v", 5, "k")) == "bdafc"
    assert keys(ranking.n_largest(df, "v", 9, F.desc("k"))) == "dbafec"


def test_top_k_above_a_bound(spark):
    """With ties, NULLs and NaN in the ranked column, and a bound that leaves most rows out."""
    value = F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 1000 == 1, float("nan")).otherwise(F.col("id") % 500)
    df = spark.range(0, 40_000, 1, 8).select(F.col("id").alias("k"), value.cast("double").alias("v"))
    for k in (1, 100, 3_000, 50_000):
        got = [(r["k"], str(r["v"])) for r in ranking.top_k_above(df, "v", k, "k").collect()]
        assert got == [(r["k"], str(r["v"])) for r in ranking.top_k(df, "v", k, "k").collect()]
    least = ranking.least_of_top_k(df, "v", 1_000)
    assert 1_000 <= df.where(F.col("v") >= least).count() <= 4_000
    assert ranking.least_of_top_k(df, "v", 40_000) is None
    whole = df.where((F.col("k") % 7 != 0) & ~F.isnan("v")).select("k", F.col("v").cast("long").alias("v"))
    assert ranking.top_k_above(whole, "v", 500, "k").collect() == ranking.top_k(whole, "v", 500, "k").collect()
    plan = ranking.top_k_above(df, "v", 100, "k")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Window" not in plan


def test_positions(spark):
    got = ranking.with_pos(frame(spark), 4, F.desc_nulls_last("v"), "k")
    assert got.schema["pos"].dataType.simpleString() == "bigint"
    assert {(r["k"], r["pos"]) for r in got.collect()} == {("b", 0), ("d", 1), ("a", 2), ("f", 3)}
    second = ranking.every_nth(frame(spark), 2, 6, "k")
    assert sorted(r["k"] for r in second.collect()) == ["a", "c", "e"]


def test_relative_label_position(spark):
    got = ranking.label_pos_rel(frame(spark), "v", 0.5, 3, F.desc_nulls_last("v"), "k")
    assert {(r["k"], r["label_x"]) for r in got.collect()} == {("b", 3.0), ("d", 3.0), ("a", 2.0)}


def test_top_k_per_category(spark):
    rows = [
        ("n1", "actor,producer", 5.0),
        ("n2", "actor", 7.0),
        ("n3", "actor", 7.0),
        ("n4", "casting_director", 1.0),
        ("n5", None, 9.0),
        ("n6", "Director", 8.0),
    ]
    df = spark.createDataFrame(rows, "k string, job string, v double").repartition(3)

    def top(**how):
        got = ranking.top_k_per_category(df, "job", ["actor", "director", "producer"], 2, "v", "k", **how)
        return sorted((r["category"], r["pos"], r["k"]) for r in got.collect())

    common = [("actor", 0, "n2"), ("actor", 1, "n3"), ("producer", 0, "n1")]
    assert top() == sorted(common + [("director", 0, "n4")])
    assert top(match="element") == common
    assert top(case_insensitive=True) == sorted(common + [("director", 0, "n6"), ("director", 1, "n4")])


def test_tokens(spark):
    df = spark.createDataFrame([(" a  b\tc",), ("",), (None,), ("a\x0bb c.",)], "value string")
    assert sorted(r["word"] for r in tokens(df).collect()) == ["a", "a\x0bb", "b", "c", "c."]
    counts = {r["word"]: r["n"] for r in word_count(df.union(df)).collect()}
    assert counts == {"a": 2, "b": 2, "c": 2, "a\x0bb": 2, "c.": 2}


def test_explode_drops_null_and_empty_arrays(spark):
    df = spark.createDataFrame([(1, ["x", ""]), (2, []), (3, None)], "id int, genres_array array<string>")
    got = by_genre(df)
    assert got.columns == ["id", "genres_array", "genre"]
    assert sorted((r["id"], r["genre"]) for r in got.collect()) == [(1, ""), (1, "x")]


def test_globals(spark):
    assert global_max(frame(spark), "v").first()["max_v"] == 2.0
    assert global_count(frame(spark)).first()["n_rows"] == 6
