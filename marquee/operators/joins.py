"""The two left joins of the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marquee.operators.generators import known_for
from marquee.operators.skew import SplitPlan, split_join


def with_ratings(
    titles: DataFrame, ratings: DataFrame, key: str = "tconst", plan: SplitPlan | None = None
) -> DataFrame:
    """Every title with its ratings columns, NULL where it has none; one ``key`` column.
    Several ratings of one key give several rows."""
    return split_join(titles, ratings, key, "left", plan)


def known_title_ratings(
    names: DataFrame,
    ratings: DataFrame,
    known: str = "knownForArray",
    key: str = "tconst",
    plan: SplitPlan | None = None,
) -> DataFrame:
    """One row per person and known title with that title's ratings columns, NULL where unrated."""
    return split_join(known_for(names, known, key), ratings, key, "left", plan)
