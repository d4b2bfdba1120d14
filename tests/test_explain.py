"""The plans Spark makes of the operators: pushdown, pruning, bounded top-k, no cross joins."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from marquee.suite.queries import QUERIES
from marquee.functions.predicates import equals
from marquee.operators import aggregates, ranking
from marquee.plans import curation, reports
from marquee.suite.queries import rated
from marquee.suite.views import Stage

SF_DIR = "/root/testdata/sf0.001"


def explain(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def by_decade(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("decades") / "d")
    curation.title_by_decade(rated(spark, SF_DIR)).write.parquet(path)
    return spark.read.parquet(path)


def test_decade_filters_reach_the_scan(by_decade):
    plan = explain(aggregates.decade_stats(by_decade))
    assert "EqualTo(titleType,movie)" in plan
    assert "GreaterThanOrEqual(decade,1900)" in plan and "LessThanOrEqual(decade,2020)" in plan
    read = next(line for line in plan.splitlines() if line.startswith("ReadSchema"))
    for used in ("titleType", "runtimeMinutes", "averageRating", "numVotes", "decade"):
        assert used in read
    assert "primaryTitle" not in read and "genres" not in read


def test_year_range_reaches_the_scan_where_the_decade_is_computed(spark):
    plan = explain(QUERIES["decade_stats"](spark, SF_DIR))
    assert "GreaterThanOrEqual(startYear,1900)" in plan and "LessThanOrEqual(startYear,2029)" in plan


def test_bound_of_a_large_top_k_reaches_the_scan(spark, tmp_path):
    curation.title_popularity(rated(spark, SF_DIR)).write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    plan = explain(reports.movie_scatter(stored, k=20))
    assert "GreaterThanOrEqual(popularity_score," in plan and "TakeOrderedAndProject" in plan
    assert "Exchange" not in plan and "Window" not in plan
    least = ranking.least_of_top_k(stored.where(equals("titleType", "movie")), "popularity_score", 20)
    assert 20 <= stored.where((stored.titleType == "movie") & (stored.popularity_score >= least)).count() <= 100


def test_genre_stats_reads_only_its_columns_and_aggregates_before_the_shuffle(spark):
    plan = explain(curation.genre_stats(rated(spark, SF_DIR)))
    reads = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert len(reads) == 2 and not any("primaryTitle" in r or "endYear" in r for r in reads)
    assert plan.count("HashAggregate") >= 2


def test_movie_filter_passes_the_join(spark):
    df = ranking.top_k(
        curation.title_popularity(rated(spark, SF_DIR)).where(equals("titleType", "movie")),
        "popularity_score",
        20,
        "tconst",
    )
    plan = explain(df)
    assert "TakeOrderedAndProject" in plan
    assert "EqualTo(titleType,movie)" in plan


def test_positions_come_after_the_limit(spark):
    plan = explain(reports.top_movies(curation.title_popularity(rated(spark, SF_DIR))))
    assert "TakeOrderedAndProject" in plan and "Exchange SinglePartition" not in plan
    assert "SinglePartition" not in plan


def test_talent_is_pruned_before_the_shuffle(spark):
    people = spark.range(10).select(
        F.lit("nm").alias("nconst"),
        F.lit("x").alias("primaryName"),
        F.lit("actor").alias("primaryProfession"),
        F.rand(1).alias("avg_rating"),
        (F.col("id") + 3).alias("title_count"),
    )
    plan = explain(reports.talent(people.repartition(3)))
    assert plan.count("WindowGroupLimit") >= 2


def test_all_orders_are_known_titles_and_all_with_line_items_rated(spark):
    from marquee.suite.views import name_basics_txt, table, title_ratings_txt

    known = name_basics_txt(spark, SF_DIR).select(F.explode(F.split("knownForTitles", ",")).alias("t"))
    orders = table(spark, SF_DIR, "orders").join(
        table(spark, SF_DIR, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    assert known.distinct().count() == orders.select("o_orderkey").distinct().count()
    lines = table(spark, SF_DIR, "lineitem").select("l_orderkey").distinct()
    assert title_ratings_txt(spark, SF_DIR).count() == lines.count()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    Stage.of(spark, SF_DIR)
    plan = explain(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert node not in plan
    assert "Scan " in plan


@pytest.mark.parametrize("key", ["filter_range", "report_decades", "decade_stats"])
def test_range_of_decades_reaches_the_scan_as_years(spark, key):
    plan = explain(QUERIES[key](spark, SF_DIR))
    assert "GreaterThanOrEqual(startYear,1900)" in plan and "LessThanOrEqual(startYear,2029)" in plan
