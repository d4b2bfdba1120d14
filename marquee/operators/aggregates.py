"""Grouped and global aggregates. All are partial before the shuffle, so the size of a
group does not decide the size of a task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.predicates import equals, in_bucket_range, in_range
from marquee.operators.generators import tokens
from marquee.operators.joins import known_title_ratings
from marquee.operators.skew import SplitPlan


def group_stats(
    df: DataFrame, by: str, count_as: str, averages: Mapping[str, str]
) -> DataFrame:
    """Rows per group and averages (``{source: name}``), NULLs ignored by the averages."""
    return df.groupBy(by).agg(
        F.count("*").alias(count_as), *(F.avg(src).alias(dst) for src, dst in averages.items())
    )


def genre_stats(genres: DataFrame) -> DataFrame:
    """Titles, average rating, runtime and votes per genre."""
    return group_stats(
        genres,
        "genre",
        "title_count",
        {"averageRating": "avg_rating", "runtimeMinutes": "avg_runtime", "numVotes": "avg_votes"},
    )


def person_rating_summary(
    names: DataFrame, ratings: DataFrame, plan: SplitPlan | None = None
) -> DataFrame:
    """Average rating of the known titles and their number, rated or not, per person.
    People are told apart by id, name and profession; a missing profession is a value of its own."""
    people = names.select("nconst", "primaryName", "primaryProfession", "knownForArray")
    rated = ratings.select("tconst", "averageRating")
    return (
        known_title_ratings(people, rated, plan=plan)
        .groupBy("nconst", "primaryName", "primaryProfession")
        .agg(F.avg("averageRating").alias("avg_rating"), F.count("tconst").alias("title_count"))
    )


def decade_stats(
    decades: DataFrame,
    title_type: str = "movie",
    first: int = 1900,
    last: int = 2020,
    year: str = "startYear",
) -> DataFrame:
    """Movies, average rating, votes and runtime per decade from ``first`` to ``last``, in order. The range is also put to
    ``year``, the column that the decades come from, if it is there: where they are computed from it and
    not stored, only that reaches the scan."""
    kept = decades.where(equals("titleType", title_type) & in_range("decade", first, last))
    if year in decades.columns:
        kept = kept.where(in_bucket_range(year, first, last))
    return group_stats(
        kept,
        "decade",
        "movie_count",
        {"averageRating": "avg_rating", "numVotes": "avg_votes", "runtimeMinutes": "avg_runtime"},
    ).orderBy("decade")


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    """Occurrences ``n`` of each ``word``."""
    return tokens(lines.select(column), column).groupBy("word").agg(F.count("*").alias("n"))


def global_max(df: DataFrame, measure: str) -> DataFrame:
    """One row, column ``max_<measure>``."""
    return df.agg(F.max(measure).alias(f"max_{measure}"))


def global_count(df: DataFrame) -> DataFrame:
    """One row, column ``n_rows``."""
    return df.agg(F.count("*").alias("n_rows"))
