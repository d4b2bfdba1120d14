"""Typing, measures, predicates and labels."""

import pytest
from pyspark.sql import functions as F

from marquee.functions import labels
from marquee.functions.columns import (
    cast_columns,
    decade_bucket,
    popularity_score,
    scale_measure,
    split_to_array,
)
from marquee.functions.predicates import is_empty, mentions, non_empty


def values(df, column):
    return [r[column] for r in df.collect()]


def test_casts_of_malformed_text(spark):
    text = ["12", " 12 ", "+5", "-5", "12.7", "1e3", "1_000", "0x1F", "", "99999999999", "n/a", None]
    df = spark.createDataFrame([(t, t, t) for t in text], "i string, d string, l string").coalesce(1)
    got = cast_columns(df, {"i": "int", "d": "double", "l": "bigint"})
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "double", "bigint"]
    none = None
    assert values(got, "i") == [12, 12, 5, -5, none, none, none, none, none, none, none, none]
    assert values(got, "l") == [12, 12, 5, -5, none, none, none, none, none, 99999999999, none, none]
    assert values(got, "d")[:6] == [12.0, 12.0, 5.0, -5.0, 12.7, 1000.0]
    assert values(got, "d")[6:] == [none, none, none, 99999999999.0, none, none]


def test_other_columns_pass_through(spark):
    df = spark.createDataFrame([("1", "x")], "startYear string, extra string")
    assert cast_columns(df, {"startYear": "int"}).columns == ["startYear", "extra"]


def test_split_is_literal_and_keeps_empty_parts(spark):
    df = spark.createDataFrame([("Drama,,X",), ("",), (None,), ("a.b",)], "g string").coalesce(1)
    assert values(split_to_array(df, "g", "p"), "p") == [["Drama", "", "X"], [""], None, ["a.b"]]
    assert values(split_to_array(df, "g", "p", "."), "p")[3] == ["a", "b"]


def test_decade_is_a_true_floor(spark):
    df = spark.createDataFrame([(1999,), (2000,), (-5,), (None,)], "startYear int").coalesce(1)
    got = decade_bucket(df)
    assert got.schema["decade"].dataType.simpleString() == "bigint"
    assert values(got, "decade") == [1990, 2000, -10, None]


def test_popularity_is_null_if_either_is(spark):
    df = spark.createDataFrame(
        [(10, 7.5), (None, 7.5), (10, None)], "numVotes bigint, averageRating double"
    ).coalesce(1)
    assert values(df.select(popularity_score().alias("p")), "p") == [75.0, None, None]


def test_scale(spark):
    assert values(spark.range(250, 251).select(scale_measure("id", 100).alias("s")), "s") == [2.5]


def test_mentions(spark):
    df = spark.createDataFrame(
        [("casting_director",), ("writer,director",), ("Director",), (None,)], "p string"
    ).coalesce(1)

    def found(**how):
        return values(df.select(mentions("p", "director", **how).alias("f")), "f")

    assert found() == [True, True, False, None]
    assert found(match="element") == [False, True, False, None]
    assert found(case_insensitive=True) == [True, True, True, None]
    assert found(match="element", case_insensitive=True) == [False, True, True, None]
    with pytest.raises(ValueError):
        mentions("p", "director", match="regex")


def test_non_empty_and_is_empty(spark):
    df = spark.createDataFrame([("",), (None,), ("x",)], "g string")
    assert values(df.where(non_empty("g")), "g") == ["x"]
    assert is_empty(df.where("g = 'y'")) and not is_empty(df)


def test_truncate(spark):
    df = spark.createDataFrame([("x" * 50,), ("x" * 51,), (None,), ("é" * 51,)], "t string").coalesce(1)
    got = values(df.select(labels.truncate_label("t", 50).alias("t")), "t")
    assert got == ["x" * 50, "x" * 50 + "...", None, "é" * 50 + "..."]


def test_fixed_decimals_round_like_the_charts(spark):
    numbers = [2.675, 0.125, 0.375, 7.0, 9.999, 0.005, 1234567.891, 3.145, 8.345] + [
        i / 200 for i in range(2000)
    ]
    df = spark.createDataFrame([(n, f"{n:.2f}", f"{n:.1f}") for n in numbers], "n double, two string, one string")
    wrong = df.where(
        (labels.fmt_fixed("n", 2) != F.col("two")) | (labels.fmt_fixed("n", 1) != F.col("one"))
    )
    assert wrong.collect() == []


def test_number_labels(spark):
    df = spark.createDataFrame(
        [(1234567, 95.9, 12345678.0), (None, None, None)], "n bigint, m double, v double"
    ).coalesce(1)
    got = df.select(
        labels.fmt_int("n").alias("n"),
        labels.fmt_minutes("m").alias("m"),
        labels.fmt_millions("v").alias("v"),
        labels.fmt_rating_count("m", "n").alias("r"),
        labels.label_pos("n", 100).alias("x"),
    ).collect()
    assert tuple(got[0]) == ("1,234,567", "95 min", "12.3M", "95.90 (1234567)", 1234667)
    assert tuple(got[1]) == (None, None, None, None, None)


def test_capitalize_and_panel_title(spark):
    df = spark.createDataFrame([("actor",), ("sound mixer",), ("DIRECTOR",), ("",), (None,)], "p string")
    got = values(df.coalesce(1).select(labels.capitalize("p").alias("c")), "c")
    assert got == [p if p is None else p.capitalize() for p in ("actor", "sound mixer", "DIRECTOR", "", None)]
    assert values(df.limit(1).select(labels.panel_title("p").alias("t")), "t") == ["Top Actors por Rating"]
