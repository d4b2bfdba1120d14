"""Hot keys on the left of the two joins are split by adaptive execution."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from marquee.plans import curation

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture(autouse=True)
def small_partitions(spark):
    old = {c: spark.conf.get(c, None) for c in SETTINGS}
    for c, v in SETTINGS.items():
        spark.conf.set(c, v)
    yield
    for c, v in old.items():
        spark.conf.unset(c) if v is None else spark.conf.set(c, v)


def final_plan(df):
    df.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def ratings(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("r") / "ratings")
    spark.range(20_000, numPartitions=4).select(
        F.concat(F.lit("tt"), "id").alias("tconst"),
        (F.col("id") % 100 / 10).alias("averageRating"),
        F.col("id").alias("numVotes"),
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("hot", ["tt5", None])
def test_hot_titles(spark, ratings, tmp_path, hot):
    spark.range(30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit(hot).cast("string"))
        .otherwise(F.concat(F.lit("tt"), "id"))
        .alias("tconst"),
        F.sha1(F.col("id").cast("string")).alias("primaryTitle"),
    ).write.parquet(str(tmp_path / "t"))
    titles = spark.read.parquet(str(tmp_path / "t"))
    df = curation.title_with_ratings(titles, ratings, curation.rating_splits(ratings))
    assert "SortMergeJoin(skew=true)" in final_plan(df)
    assert df.count() == 30_000


def test_title_that_very_many_people_are_known_for(spark, ratings, tmp_path):
    name = F.sha1(F.col("id").cast("string"))
    spark.range(20_000, numPartitions=8).select(
        F.concat(F.lit("nm"), "id").alias("nconst"),
        name.alias("primaryName"),
        name.alias("primaryProfession"),
        F.array(F.lit("tt5"), F.concat(F.lit("tt"), "id")).alias("knownForArray"),
    ).write.parquet(str(tmp_path / "n"))
    names = spark.read.parquet(str(tmp_path / "n"))
    df = curation.person_rating_summary(names, ratings, curation.rating_splits(ratings))
    assert "SortMergeJoin(skew=true)" in final_plan(df)
    assert df.where("title_count = 2").count() == 20_000
