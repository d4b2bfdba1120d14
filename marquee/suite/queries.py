"""The registered queries: every operator, source, sink, dataset and report on whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions import labels
from marquee.functions.columns import (
    cast_columns,
    decade_bucket,
    popularity_score,
    scale_measure,
    split_to_array,
)
from marquee.functions.predicates import (
    at_least,
    equals,
    in_bucket_range,
    in_range,
    mentions,
    non_empty,
    not_null,
)
from marquee.operators import aggregates, generators, joins, ranking
from marquee.plans import checks, curation, reports
from marquee.session import lease_database, scratch_folder
from marquee.sources import tables, text
from marquee.sources.datasets import read_dataset, write_dataset
from marquee.suite.views import BREWERY_DDL, Stage, breweries, table
from marquee.zones import CURATED, LANDING_FILES, RAW, Zones

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function's name, less a trailing underscore."""

    @wraps(fn)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        with Stage.one_look():
            return fn(spark, sf)

    QUERIES[fn.__name__.removesuffix("_")] = run
    return run


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Averages depend on the order of summation in their last digits."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def flat(df: DataFrame, *arrays: str) -> DataFrame:
    """Arrays as text, for comparison across engines."""
    return df.withColumns({c: F.array_join(c, "|") for c in arrays})


# Shared steps --------------------------------------------------------------------------


def titles(spark, sf):
    return Stage.of(spark, sf).raw("title_basics")


def ratings(spark, sf):
    return Stage.of(spark, sf).raw("title_ratings")


def names(spark, sf):
    return Stage.of(spark, sf).raw("name_basics")


def rated(spark, sf):
    plan = Stage.of(spark, sf).splits()
    return curation.title_with_ratings(titles(spark, sf), ratings(spark, sf), plan)


def stats(spark, sf):
    """Genre statistics with averages fit for comparison, before any ranking or label."""
    return rounded(curation.genre_stats(rated(spark, sf)), "avg_rating", "avg_runtime", "avg_votes")


def popularity(spark, sf):
    return curation.title_popularity(rated(spark, sf))


def movies(spark, sf):
    return popularity(spark, sf).where(equals("titleType", "movie"))


def people(spark, sf):
    plan = Stage.of(spark, sf).splits()
    summary = curation.person_rating_summary(names(spark, sf), ratings(spark, sf), plan)
    return rounded(summary, "avg_rating")


def by_decade(spark, sf):
    return curation.title_by_decade(rated(spark, sf))


def decades(spark, sf):
    return rounded(
        aggregates.decade_stats(by_decade(spark, sf)),
        "avg_rating",
        "avg_votes",
        "avg_runtime",
    )


def landing_text(spark, sf, name):
    return curation.scan_landing(spark, Stage.of(spark, sf).land(name), name)


# Sources and sinks ---------------------------------------------------------------------


@query
def scan_tsv(spark, sf):
    return landing_text(spark, sf, "title_basics")


@query
def scan_tsv_quoted(spark, sf):
    """A file that quotes its fields, one of which holds a tab."""
    path = scratch_folder(spark, "quoted") + "/tsv"
    supplier = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("id"),
        F.concat("s_name", F.lit("\t"), F.col("s_nationkey").cast("string")).alias("label"),
    )
    supplier.write.option("sep", "\t").option("header", True).option("quoteAll", True).csv(path)
    return text.read_tsv(spark, path, ("id", "label"), quote='"')


def brewery_files(spark, sf):
    path = scratch_folder(spark, "breweries") + "/csv"
    breweries(spark, sf).write.option("emptyValue", "").csv(path)
    return path


@query
def scan_csv_positional(spark, sf):
    return text.read_csv_positional(spark, brewery_files(spark, sf))


@query
def scan_parquet(spark, sf):
    return ratings(spark, sf)


@query
def scan_text(spark, sf):
    path = scratch_folder(spark, "lines") + "/text"
    table(spark, sf, "documents").select("text").write.text(path)
    return text.read_lines(spark, path)


@query
def sink_parquet_roundtrip(spark, sf):
    zones = Zones(scratch_folder(spark, "roundtrip"))
    write_dataset(popularity(spark, sf), zones, CURATED, "title_popularity")
    return read_dataset(spark, zones, CURATED, "title_popularity")


@query
def sink_text_roundtrip(spark, sf):
    path = scratch_folder(spark, "words") + "/text"
    text.write_lines(word_count(spark, sf), path)
    return text.read_lines(spark, path)


def new_database(spark, prefix):
    """A database of its own for this run, which goes when the lease ends; the current one stays."""
    name = f"{prefix}_{uuid.uuid4().hex}"
    current = spark.catalog.currentDatabase()
    tables.ensure_database(spark, name, f"{scratch_folder(spark, 'tables')}/{name}")
    lease_database(spark, name)
    spark.catalog.setCurrentDatabase(current)
    return name


def brewery_table(spark, sf):
    name = f"{new_database(spark, 'brewing')}.breweries"
    return tables.create_external_csv_table(spark, name, BREWERY_DDL, brewery_files(spark, sf))


@query
def external_table(spark, sf):
    return brewery_table(spark, sf)


@query
def limit_rows(spark, sf):
    return aggregates.global_count(brewery_table(spark, sf).select("name").limit(10))


@query
def preview_rows(spark, sf):
    return aggregates.global_count(text.preview(titles(spark, sf)))


@query
def catalog_databases(spark, sf):
    """A new database, found in the list of databases, with a table over each raw dataset."""
    zones = Stage.of(spark, sf).raw_zone()
    database = new_database(spark, "films")
    counts = None
    for name in LANDING_FILES:
        table_name = f"{database}.{name}"
        spark.catalog.createTable(table_name, path=zones.path(RAW, name), source="parquet")
        rows = spark.table(table_name).agg(F.count("*").alias("n_rows"))
        rows = rows.select(F.lit(database).alias("namespace"), F.lit(name).alias("dataset"), "n_rows")
        counts = rows if counts is None else counts.unionByName(rows)
    listed = tables.list_databases(spark).where(equals("namespace", database))
    return counts.join(listed, "namespace").select("dataset", "n_rows")


@query
def check_landing(spark, sf):
    return checks.check_landing(spark, Stage.of(spark, sf).land(), lines=True)


@query
def check_landing_incomplete(spark, sf):
    """A zone that lacks one of the files that are asked for."""
    wanted = {name: spec.file for name, spec in LANDING_FILES.items()} | {"title_crew": "title.crew.tsv"}
    return checks.check_landing(spark, Stage.of(spark, sf).land(), wanted, lines=True)


@query
def curated_run(spark, sf):
    """What a whole run has stored in the curated zone: rows and the sum of one measure per dataset."""
    zones = Stage.of(spark, sf).curated_run()
    measures = {
        "title_with_ratings_nopartition": F.sum("numVotes"),
        "title_by_genre": F.sum("numVotes"),
        "genre_stats": F.sum("title_count"),
        # Ratings have one decimal, so tenths add up exactly.
        "title_popularity": F.sum(F.round(F.col("popularity_score") * 10).cast("bigint")),
        "person_rating_summary": F.sum("title_count"),
        "title_by_decade": F.sum("decade"),
    }
    rows = None
    for name, measure in measures.items():
        one = read_dataset(spark, zones, CURATED, name).agg(
            F.count("*").alias("n_rows"), measure.alias("total")
        )
        one = one.select(F.lit(name).alias("dataset"), "n_rows", "total")
        rows = one if rows is None else rows.unionByName(one)
    return rows


@query
def check_zone_inventory(spark, sf):
    found = checks.zone_inventory(spark, Stage.of(spark, sf).curated_run())
    # The number of files depends on the cluster.
    return found.withColumn("n_files", F.col("n_files") > 0).withColumnRenamed("n_files", "has_files")


# Projections ---------------------------------------------------------------------------


@query
def cast_int(spark, sf):
    df = cast_columns(
        landing_text(spark, sf, "title_basics"),
        {"startYear": "int", "endYear": "int", "runtimeMinutes": "int"},
    )
    return df.select("tconst", "startYear", "endYear", "runtimeMinutes")


@query
def cast_double(spark, sf):
    df = landing_text(spark, sf, "title_ratings")
    return cast_columns(df, {"averageRating": "double"}).select("tconst", "averageRating")


@query
def cast_long(spark, sf):
    df = landing_text(spark, sf, "title_ratings")
    return cast_columns(df, {"numVotes": "bigint"}).select("tconst", "numVotes")


@query
def split_array(spark, sf):
    df = landing_text(spark, sf, "title_basics").select("tconst", "genres")
    df = split_to_array(df, "genres", "genres_array")
    return flat(df.withColumn("n_genres", F.size("genres_array")), "genres_array").drop("genres")


@query
def project_subset(spark, sf):
    return titles(spark, sf).select("tconst", "primaryTitle", "titleType")


@query
def popularity_score_only(spark, sf):
    df = ratings(spark, sf)
    return df.select("tconst", popularity_score().alias("popularity_score"))


@query
def popularity_score_(spark, sf):
    return popularity(spark, sf)


@query
def decade_bucket_only(spark, sf):
    return decade_bucket(titles(spark, sf)).select("tconst", "startYear", "decade")


@query
def label_truncate(spark, sf):
    return titles(spark, sf).select(
        "tconst", labels.truncate_label("primaryTitle", 50).alias("label")
    )


@query
def label_thousands(spark, sf):
    return stats(spark, sf).select("genre", labels.fmt_int("title_count").alias("label"))


@query
def label_fixed2(spark, sf):
    return stats(spark, sf).select("genre", labels.fmt_fixed("avg_rating").alias("label"))


@query
def label_minutes(spark, sf):
    return titles(spark, sf).select("tconst", labels.fmt_minutes("runtimeMinutes").alias("label"))


@query
def label_millions(spark, sf):
    return popularity(spark, sf).select(
        "tconst", labels.fmt_millions("popularity_score").alias("label")
    )


@query
def label_rating_count(spark, sf):
    return people(spark, sf).select(
        "nconst", labels.fmt_rating_count("avg_rating", "title_count").alias("label")
    )


@query
def label_capitalize(spark, sf):
    return names(spark, sf).select(
        "nconst",
        labels.capitalize("primaryProfession").alias("capital"),
        labels.panel_title("primaryProfession").alias("title"),
    )


@query
def scale_measure_(spark, sf):
    return rounded(stats(spark, sf).select("genre", scale_measure("avg_votes", 100).alias("size")), "size")


@query
def label_offset_const(spark, sf):
    df = stats(spark, sf).select(
        "genre",
        labels.label_pos("title_count", 100).alias("count_x"),
        labels.label_pos("avg_rating", 0.05).alias("rating_x"),
        labels.label_pos("avg_runtime", 2).alias("runtime_x"),
    )
    return rounded(df, "rating_x", "runtime_x")


@query
def label_offset_rel(spark, sf):
    order = [F.desc_nulls_last("popularity_score"), "tconst"]
    df = movies(spark, sf).select("tconst", "popularity_score")
    df = ranking.label_pos_rel(df, "popularity_score", 0.01, reports.MOVIES_SHOWN, *order)
    return rounded(df, "popularity_score", "label_x")


@query
def rank_position(spark, sf):
    """Positions of the movies that the scatter panel shows; the bound is the panel's."""
    df = movies(spark, sf).select("tconst", "popularity_score")
    return ranking.with_pos(df, reports.MOVIES_SAMPLED, F.desc_nulls_last("popularity_score"), "tconst")


@query
def every_second(spark, sf):
    bound = reports.decades_between(reports.FIRST_DECADE, reports.LAST_DECADE)
    return ranking.every_nth(decades(spark, sf).select("decade", "movie_count"), 2, bound, "decade")


# Filters -------------------------------------------------------------------------------


@query
def filter_equals(spark, sf):
    return titles(spark, sf).where(equals("titleType", "movie")).select("tconst", "titleType")


@query
def filter_not_null(spark, sf):
    return (
        titles(spark, sf)
        .where(not_null("startYear", "runtimeMinutes"))
        .select("tconst", "startYear", "runtimeMinutes")
    )


@query
def filter_range(spark, sf):
    both = in_range("decade", 1900, 2020) & in_bucket_range("startYear", 1900, 2020)
    return decade_bucket(titles(spark, sf)).where(both).select("tconst", "decade")


@query
def filter_having(spark, sf):
    return people(spark, sf).where(at_least("title_count", 3)).select("nconst", "title_count")


@query
def filter_contains(spark, sf):
    return (
        names(spark, sf)
        .where(mentions("primaryProfession", "director"))
        .select("nconst", "primaryProfession")
    )


@query
def filter_contains_any_case(spark, sf):
    found = mentions("primaryName", "CUSTOMER#00000000", case_insensitive=True)
    return names(spark, sf).where(found).select("nconst", "primaryName")


@query
def filter_contains_element(spark, sf):
    return (
        names(spark, sf)
        .where(mentions("primaryProfession", "director", match="element"))
        .select("nconst", "primaryProfession")
    )


@query
def filter_nonempty(spark, sf):
    return stats(spark, sf).where(non_empty("genre")).select("genre", "title_count")


@query
def category_placeholder(spark, sf):
    panel = reports.talent(people(spark, sf), ("actress", "composer"), 3)
    return rounded(panel, "label_x")


# Joins and generators ------------------------------------------------------------------


@query
def join_title_ratings(spark, sf):
    return flat(rated(spark, sf), "genres_array")


@query
def join_known_ratings(spark, sf):
    plan = Stage.of(spark, sf).splits()
    df = joins.known_title_ratings(names(spark, sf), ratings(spark, sf), plan=plan)
    return df.select("nconst", "tconst", "averageRating", "numVotes")


@query
def explode_genre(spark, sf):
    return flat(curation.title_by_genre(rated(spark, sf)), "genres_array")


@query
def explode_known_for(spark, sf):
    return generators.known_for(names(spark, sf)).select("nconst", "tconst")


@query
def tokenize_words(spark, sf):
    return generators.tokens(table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


# Aggregations --------------------------------------------------------------------------


@query
def agg_count_star(spark, sf):
    return titles(spark, sf).groupBy("titleType").agg(F.count("*").alias("title_count"))


@query
def agg_count_col(spark, sf):
    return (
        titles(spark, sf)
        .groupBy("titleType")
        .agg(F.count("startYear").alias("n_years"), F.count("endYear").alias("n_ends"))
    )


@query
def agg_avg(spark, sf):
    df = rated(spark, sf).groupBy("titleType").agg(
        F.avg("averageRating").alias("avg_rating"),
        F.avg("numVotes").alias("avg_votes"),
        F.avg("runtimeMinutes").alias("avg_runtime"),
    )
    return rounded(df, "avg_rating", "avg_votes", "avg_runtime")


@query
def agg_global_max(spark, sf):
    return aggregates.global_max(movies(spark, sf), "popularity_score")


@query
def agg_global_count(spark, sf):
    return aggregates.global_count(people(spark, sf).where(not_null("avg_rating")))


@query
def word_count(spark, sf):
    return aggregates.word_count(table(spark, sf, "documents"), "text")


@query
def genre_stats(spark, sf):
    return stats(spark, sf)


@query
def person_rating_summary(spark, sf):
    return people(spark, sf)


@query
def decade_stats(spark, sf):
    return decades(spark, sf)


# Orders and rankings -------------------------------------------------------------------


@query
def sort_desc(spark, sf):
    return ranking.sort_desc(popularity(spark, sf), "popularity_score", "tconst")


@query
def sort_asc(spark, sf):
    return by_decade(spark, sf).select("decade", "tconst").orderBy("decade", "tconst")


@query
def top_k_movies(spark, sf):
    return ranking.top_k(movies(spark, sf), "popularity_score", 20, "tconst")


@query
def top_genres_by_volume(spark, sf):
    kept = stats(spark, sf).where(non_empty("genre"))
    return ranking.top_k(kept, "title_count", 15, "genre")


def largest(spark, sf, by):
    kept = stats(spark, sf).where(non_empty("genre"))
    return ranking.n_largest(kept, by, 15, F.desc("title_count"), "genre")


@query
def top_genres_by_rating(spark, sf):
    return largest(spark, sf, "avg_rating")


@query
def top_genres_by_runtime(spark, sf):
    return largest(spark, sf, "avg_runtime")


@query
def top_talent_by_profession(spark, sf):
    return ranking.top_k_per_category(
        reports.seasoned(people(spark, sf)),
        "primaryProfession",
        reports.PROFESSIONS,
        15,
        "avg_rating",
        "nconst",
        category="profession",
    )


# Raw and curated datasets, reports -----------------------------------------------------


@query
def raw_title_basics(spark, sf):
    return flat(curation.typed(landing_text(spark, sf, "title_basics"), "title_basics"), "genres_array")


@query
def raw_title_ratings(spark, sf):
    return curation.typed(landing_text(spark, sf, "title_ratings"), "title_ratings")


@query
def raw_name_basics(spark, sf):
    return flat(curation.typed(landing_text(spark, sf, "name_basics"), "name_basics"), "knownForArray")


@query
def decade_bucket_(spark, sf):
    return flat(by_decade(spark, sf), "genres_array")


@query
def report_genre_volume(spark, sf):
    return reports.genre_volume(stats(spark, sf))


@query
def report_genre_quality(spark, sf):
    return rounded(reports.genre_quality(stats(spark, sf)), "label_x")


@query
def report_genre_runtime(spark, sf):
    return rounded(reports.genre_runtime(stats(spark, sf)), "label_x")


@query
def report_genre_bubbles(spark, sf):
    return rounded(reports.genre_bubbles(stats(spark, sf)), "size")


@query
def report_top_movies(spark, sf):
    return rounded(reports.top_movies(popularity(spark, sf)), "popularity_score", "label_x")


@query
def report_movie_scatter(spark, sf):
    return reports.movie_scatter(popularity(spark, sf))


@query
def report_decades(spark, sf):
    return rounded(reports.decade_lines(by_decade(spark, sf)), "avg_rating", "avg_votes", "avg_runtime")


@query
def report_talent(spark, sf):
    return rounded(reports.talent(people(spark, sf)), "label_x")


@query
def report_talent_scatter(spark, sf):
    return reports.talent_scatter(people(spark, sf))
