"""Split joins against plain joins, and how evenly they spread the work."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.operators.joins import with_ratings
from marquee.operators.skew import SplitPlan, heavy_parts, plan_splits, split_join

KEYS = st.sampled_from(["a", "b", "c", "d", None])
SIDE = st.lists(KEYS, min_size=1, max_size=25)
PARTS = st.dictionaries(KEYS, st.integers(1, 4))


def frame(spark, keys, name, parts=3):
    rows = [(k, i) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, f"k string, {name} int").repartition(parts).cache()


def brute(left, right, how):
    out = Counter()
    for i, k in enumerate(left):
        hits = [j for j, r in enumerate(right) if k is not None and r == k]
        out.update((k, i, j) for j in hits)
        if not hits and how == "left":
            out[(k, i, None)] += 1
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(SIDE, SIDE, PARTS, PARTS, st.sampled_from(["left", "inner"]))
def test_any_plan_gives_the_plain_join(spark, left, right, left_parts, right_parts, how):
    # Plans may name keys that the left side lacks and miss keys that a side has.
    ldf, rdf = frame(spark, left, "x"), frame(spark, right, "y")
    # A key is split on the right only if the right side has it.
    right_parts = {k: n for k, n in right_parts.items() if k in right}
    keys = sorted(left_parts.keys() | right_parts.keys(), key=str)
    rows = [(k, left_parts.get(k, 1), right_parts.get(k, 1)) for k in keys]
    plan = SplitPlan.of(spark.createDataFrame(rows, "key string, left int, right int"))
    got = split_join(ldf, rdf, "k", how, plan)
    assert got.columns == ["k", "x", "y"]
    assert Counter(map(tuple, got.collect())) == brute(left, right, how)
    ldf.unpersist()
    rdf.unpersist()


def test_found_keys_and_parts(spark):
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 30 == 1, None)
    df = spark.range(n).select(key.otherwise(F.col("id").cast("string")).alias("k"))
    cold = spark.range(n).select(F.col("id").cast("string").alias("k"))
    parts = heavy_parts({"skewed": df, "even": cold}, "k", 500)
    assert parts.columns == ["key", "skewed", "even"]
    found = {r["key"]: (r["skewed"], r["even"]) for r in parts.collect()}
    assert set(found) == {"hot", None} and found[None] == (2, 1)
    assert 20 <= found["hot"][0] <= 21 and found["hot"][1] == 1
    assert not plan_splits(cold, cold, "k", 500)
    assert not plan_splits(cold.limit(0), cold, "k", 500)


@pytest.mark.parametrize("hot_side", ["left", "right", "null"])
def test_hot_key_is_spread_and_result_is_whole(spark, hot_side, tmp_path):
    n = 12_000
    hot = F.when(F.col("id") % 3 == 0, F.lit(None if hot_side == "null" else "k1").cast("string"))
    skewed = spark.range(n, numPartitions=4).select(
        hot.otherwise(F.concat(F.lit("k"), F.col("id"))).alias("tconst"), F.col("id").alias("v")
    )
    even = spark.range(n, numPartitions=4).select(
        F.concat(F.lit("k"), F.col("id")).alias("tconst"), F.col("id").alias("w")
    )
    sides = (even, skewed) if hot_side == "right" else (skewed, even)
    for name, df in zip(("l", "r"), sides):
        df.write.parquet(str(tmp_path / name))
    left, right = (spark.read.parquet(str(tmp_path / n)) for n in ("l", "r"))

    old = {c: spark.conf.get(c) for c in SETTINGS}
    try:
        for c, v in SETTINGS.items():
            spark.conf.set(c, v)
        plan = plan_splits(left, right, "tconst", 200)
        assert plan
        got = with_ratings(left, right, plan=plan)
        plain = left.join(right, "tconst", "left")
        assert got.columns == plain.columns
        assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()

        def largest(df):
            return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]

        assert largest(plain) > n / 3
        assert largest(got) < n / 6
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


def test_other_join_kinds_are_refused(spark):
    df = spark.range(1).select(F.lit("a").alias("k"))
    with pytest.raises(ValueError):
        split_join(df, df, "k", "full", SplitPlan())


def test_many_hot_keys_stay_in_their_table(spark, tmp_path):
    """20,000 split keys: none is a literal of the plan, and the result is the plain join."""
    n = 20_000
    path = str(tmp_path / "parts")
    spark.range(n).select(
        F.concat(F.lit("hot"), F.col("id")).alias("key"), F.lit(1).alias("left"), F.lit(2).alias("right")
    ).write.parquet(path)
    plan = SplitPlan.of(spark.read.parquet(path))
    assert plan.right and not plan.left and plan.nulls == 1
    left = spark.range(n + 50).select(F.concat(F.lit("hot"), F.col("id")).alias("k"), F.col("id").alias("x"))
    right = spark.range(3 * n).select(
        F.concat(F.lit("hot"), (F.col("id") % n).cast("string")).alias("k"), F.col("id").alias("y")
    )
    got = split_join(left, right, "k", "left", plan)
    text = got._jdf.queryExecution().toString()
    assert "hot1" not in text and " IN (" not in text and "INSET" not in text and len(text) < 100_000
    plain = left.join(right, "k", "left")
    assert got.count() == 3 * n + 50
    assert got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
