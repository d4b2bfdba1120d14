"""Chart-ready frames: every panel of the four reports as a small, ordered DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import labels
from marquee.functions.columns import scale_measure
from marquee.functions.predicates import at_least, equals, non_empty, not_null
from marquee.operators.aggregates import decade_stats
from marquee.operators.ranking import (
    label_pos_rel,
    top_k,
    top_k_above,
    top_k_per_category,
    with_pos,
)
from marquee.plans.checks import require_curated
from marquee.plans.curation import together
from marquee.plans.generations import published
from marquee.sources.datasets import read_dataset
from marquee.zones import CURATED, Zones

# The professions of the talent report and the sizes of the panels.
PROFESSIONS = ("actor", "actress", "director", "writer", "producer")
GENRES_SHOWN = 15
MOVIES_SHOWN = 20
MOVIES_SAMPLED = 1000
TALENT_SHOWN = 15
TALENT_SAMPLED = 100
MIN_TITLES = 3
FIRST_DECADE, LAST_DECADE = 1900, 2020


def _by_volume() -> list[Column]:
    """The order in which genres arrive at the quality and runtime panels."""
    return [F.desc_nulls_last("title_count"), F.asc("genre")]


def genre_volume(stats: DataFrame, k: int = GENRES_SHOWN) -> DataFrame:
    """Bars: the genres with the most titles."""
    frame = with_pos(stats.where(non_empty("genre")), k, *_by_volume())
    return frame.select(
        "pos",
        "genre",
        "title_count",
        labels.fmt_int("title_count").alias("label"),
        labels.label_pos("title_count", 100).alias("label_x"),
    )


def genre_quality(stats: DataFrame, k: int = GENRES_SHOWN) -> DataFrame:
    """Bars: the genres with the best average rating."""
    order = [F.desc_nulls_last("avg_rating"), *_by_volume()]
    frame = with_pos(stats.where(non_empty("genre")), k, *order)
    return frame.select(
        "pos",
        "genre",
        "avg_rating",
        labels.fmt_fixed("avg_rating").alias("label"),
        labels.label_pos("avg_rating", 0.05).alias("label_x"),
    )


def genre_runtime(stats: DataFrame, k: int = GENRES_SHOWN) -> DataFrame:
    """Bars: the genres with the longest average runtime."""
    order = [F.desc_nulls_last("avg_runtime"), *_by_volume()]
    frame = with_pos(stats.where(non_empty("genre")), k, *order)
    return frame.select(
        "pos",
        "genre",
        "avg_runtime",
        labels.fmt_minutes("avg_runtime").alias("label"),
        labels.label_pos("avg_runtime", 2).alias("label_x"),
    )


def genre_bubbles(stats: DataFrame) -> DataFrame:
    """Bubbles: volume against quality, size by votes, colour by runtime; every genre."""
    return stats.where(non_empty("genre")).select(
        "genre",
        F.col("title_count").alias("x"),
        F.col("avg_rating").alias("y"),
        scale_measure("avg_votes", 100).alias("size"),
        F.col("avg_runtime").alias("colour"),
    )


def top_movies(popularity: DataFrame, k: int = MOVIES_SHOWN) -> DataFrame:
    """Bars: the most popular movies."""
    frame = with_pos(
        popularity.where(equals("titleType", "movie")).select(
            "tconst", "primaryTitle", "popularity_score"
        ),
        k,
        F.desc_nulls_last("popularity_score"),
        "tconst",
    )
    return label_pos_rel(frame, "popularity_score", 0.01, k, "pos").select(
        "pos",
        labels.truncate_label("primaryTitle", 50).alias("title"),
        "popularity_score",
        labels.fmt_millions("popularity_score").alias("label"),
        "label_x",
    )


def movie_scatter(popularity: DataFrame, k: int = MOVIES_SAMPLED) -> DataFrame:
    """Points: rating against votes of the most popular movies, colour by popularity."""
    return top_k_above(
        popularity.where(equals("titleType", "movie")).select(
            "tconst", "averageRating", "numVotes", "popularity_score"
        ),
        "popularity_score",
        k,
        "tconst",
    )


def decades_between(first: int, last: int) -> int:
    """How many decades there are from ``first`` to ``last``."""
    return (last - first) // 10 + 1


def decade_lines(
    by_decade: DataFrame, first: int = FIRST_DECADE, last: int = LAST_DECADE
) -> DataFrame:
    """Lines: movies, rating, votes and runtime per decade; ``tick`` marks every second decade."""
    stats = decade_stats(by_decade, first=first, last=last)
    frame = with_pos(stats, decades_between(first, last), "decade")
    return frame.withColumn("tick", F.col("pos") % 2 == 0)


def seasoned(people: DataFrame) -> DataFrame:
    """People with enough known titles, a rating and a profession."""
    return people.where(
        at_least("title_count", MIN_TITLES) & not_null("avg_rating", "primaryProfession")
    )


def talent(
    people: DataFrame,
    professions: Sequence[str] = PROFESSIONS,
    k: int = TALENT_SHOWN,
    match: str = "substring",
) -> DataFrame:
    """Bars: the best rated people of each profession; a profession without any has one row
    that says so."""
    best = top_k_per_category(
        seasoned(people),
        "primaryProfession",
        professions,
        k,
        "avg_rating",
        "nconst",
        category="profession",
        match=match,
    )
    panels = people.sparkSession.range(1, numPartitions=1).select(
        F.explode(F.array(*map(F.lit, professions))).alias("profession")
    )
    frame = panels.join(best, "profession", "left")
    empty = F.col("nconst").isNull()
    capital = labels.capitalize("profession")
    return frame.select(
        "profession",
        "pos",
        labels.truncate_label("primaryName", 30).alias("name"),
        "avg_rating",
        "title_count",
        F.when(empty, labels.fill(labels.EMPTY_PANEL_LABEL, "profession"))
        .otherwise(labels.fmt_rating_count("avg_rating", "title_count"))
        .alias("label"),
        labels.label_pos("avg_rating", 0.1).alias("label_x"),
        F.when(empty, labels.fill(labels.EMPTY_PANEL_TITLE, capital))
        .otherwise(labels.panel_title("profession"))
        .alias("title"),
    )


def talent_scatter(people: DataFrame, k: int = TALENT_SAMPLED) -> DataFrame:
    """Points: known titles against rating of the best rated people."""
    return top_k(
        seasoned(people).select("nconst", "title_count", "avg_rating"), "avg_rating", k, "nconst"
    )


# Panel: the curated dataset it reads and the function that makes it.
PANELS = {
    "genre_volume": ("genre_stats", genre_volume),
    "genre_quality": ("genre_stats", genre_quality),
    "genre_runtime": ("genre_stats", genre_runtime),
    "genre_bubbles": ("genre_stats", genre_bubbles),
    "top_movies": ("title_popularity", top_movies),
    "movie_scatter": ("title_popularity", movie_scatter),
    "decades": ("title_by_decade", decade_lines),
    "talent": ("person_rating_summary", talent),
    "talent_scatter": ("person_rating_summary", talent_scatter),
}


def build_reports(spark: SparkSession, zones: Zones) -> dict[str, DataFrame]:
    """Every panel over the newest curated generation, not yet run."""
    zones = published(spark, zones)
    return {
        panel: make(read_dataset(spark, zones, CURATED, dataset))
        for panel, (dataset, make) in PANELS.items()
    }


def write_reports(spark: SparkSession, zones: Zones, output: str) -> list[str]:
    """Write every panel below ``output`` and give the folders. Without the curated datasets nothing is
    written. The panels are independent jobs: all run, then the first that failed is named."""
    zones = published(spark, zones)  # one generation for the check and all panels
    require_curated(spark, zones)
    folders = {panel: f"{output.rstrip('/')}/{panel}" for panel in PANELS}

    def write(panel: str, frame: DataFrame) -> Callable[[], None]:
        def run() -> None:
            try:
                frame.write.mode("overwrite").parquet(folders[panel])
            except Exception as error:
                raise RuntimeError(f"panel {panel} was not written") from error

        return run

    together(spark, *(write(*item) for item in build_reports(spark, zones).items()))
    return list(folders.values())
