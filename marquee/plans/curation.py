"""Landing files to raw datasets to curated datasets.

Each stage is written once and read back, so nothing is computed twice, later steps scan
only the columns they need, and a lost executor costs no more than the tasks it ran.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from marquee.functions.columns import (
    cast_columns,
    decade_bucket,
    popularity_score,
    split_to_array,
)
from marquee.operators import aggregates, generators, joins
from marquee.operators.skew import SplitPlan, heavy_parts
from marquee.plans.generations import new_generation, publish
from marquee.session import small_tasks
from marquee.sources.datasets import read_dataset, write_dataset
from marquee.sources.text import read_tsv
from marquee.zones import CURATED, LANDING, LANDING_FILES, RAW, Zones

def together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run independent writes as concurrent Spark jobs, so that the last tasks of one leave no
    executor idle. Waits for all of them, then raises the first error."""
    with ThreadPoolExecutor(len(writes)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(write)) for write in writes]
    for done in running:
        done.result()


def scan_landing(spark: SparkSession, zones: Zones, name: str, quote: str = "") -> DataFrame:
    """A landing file as text columns."""
    spec = LANDING_FILES[name]
    return read_tsv(spark, zones.path(LANDING, spec.file), spec.required, quote)


def typed(df: DataFrame, name: str) -> DataFrame:
    """The raw form of a landing file; columns without a rule pass through."""
    spec = LANDING_FILES[name]
    df = cast_columns(df, spec.casts) if spec.casts else df
    for src, dst in spec.splits.items():
        df = split_to_array(df, src, dst)
    return df


def land_to_raw(spark: SparkSession, zones: Zones, quote: str = "") -> None:
    """Write the three raw datasets, one scan of each landing file."""

    def write(name: str) -> Callable[[], None]:
        df = typed(scan_landing(spark, zones, name, quote), name)
        return lambda: write_dataset(df, zones, RAW, name)

    together(spark, *map(write, LANDING_FILES))


def title_with_ratings(
    titles: DataFrame, ratings: DataFrame, plan: SplitPlan | None = None
) -> DataFrame:
    return joins.with_ratings(titles, ratings, plan=plan)


def title_by_genre(rated: DataFrame) -> DataFrame:
    return generators.by_genre(rated)


def genre_stats(rated: DataFrame) -> DataFrame:
    columns = ("genres_array", "averageRating", "runtimeMinutes", "numVotes")
    return aggregates.genre_stats(generators.by_genre(rated.select(*columns)))


def title_popularity(rated: DataFrame) -> DataFrame:
    columns = ("tconst", "primaryTitle", "titleType", "averageRating", "numVotes")
    return rated.select(*columns, popularity_score().alias("popularity_score"))


def title_by_decade(rated: DataFrame) -> DataFrame:
    return decade_bucket(rated)


def person_rating_summary(
    names: DataFrame, ratings: DataFrame, plan: SplitPlan | None = None
) -> DataFrame:
    return aggregates.person_rating_summary(names, ratings, plan)


def rating_splits(ratings: DataFrame) -> SplitPlan:
    """How the two left joins with the ratings split title ids that have very many ratings.
    Ids with very many titles or people are on the left, where adaptive execution splits them."""
    return SplitPlan.of(heavy_parts({"right": ratings}, "tconst"))


def raw_to_curated(spark: SparkSession, zones: Zones) -> None:
    """Write the six curated datasets: first those that join with the ratings, then those that
    derive from the stored join. Tasks are small, so that the sorts need no disk."""
    spark = small_tasks(spark)
    titles, ratings, names = (read_dataset(spark, zones, RAW, n) for n in LANDING_FILES)
    plan = rating_splits(ratings)

    def write(name: str, df: DataFrame) -> Callable[[], None]:
        return lambda: write_dataset(df, zones, CURATED, name)

    joined = "title_with_ratings_nopartition"
    together(
        spark,
        write(joined, title_with_ratings(titles, ratings, plan)),
        write("person_rating_summary", person_rating_summary(names, ratings, plan)),
    )
    rated = read_dataset(spark, zones, CURATED, joined)
    together(
        spark,
        write("title_by_genre", title_by_genre(rated)),
        # Sorted files let the filters of the reports skip row groups.
        write("title_by_decade", title_by_decade(rated).sortWithinPartitions("titleType", "decade")),
        write("title_popularity", title_popularity(rated).sortWithinPartitions("titleType")),
        write("genre_stats", genre_stats(rated)),
    )


def curate(spark: SparkSession, zones: Zones, quote: str = "") -> Zones:
    """The whole run: landing to raw to curated, into a new generation that is published at the end. If a
    write fails, readers go on with the generation before. Gives the zones of the new one."""
    run = new_generation(zones)
    land_to_raw(spark, run, quote)
    raw_to_curated(spark, run)
    publish(spark, run)
    return run
