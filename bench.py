"""Times the catalogue run and its reports and prints one JSON line.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_ALL=1    also time every registered query, run to a sink that discards the rows
BENCH_NAIVE=0  leave out the comparison run, in which every output starts from the landing files
"""

from __future__ import annotations

import json
import os
import time
from contextlib import contextmanager

from marquee.operators.aggregates import word_count
from marquee.operators.generators import by_genre
from marquee.plans import curation
from marquee.plans.reports import build_reports
from marquee.session import build_session, scratch_folder
from marquee.sources.datasets import collect_report, read_dataset, write_dataset
from marquee.sources.text import write_tsv
from marquee.suite.queries import QUERIES
from marquee.suite.views import LANDING_VIEWS, Stage, table
from marquee.zones import CURATED, LANDING, LANDING_FILES, RAW, Zones

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Registered queries that are timed in every run, on raw datasets that are in place.
HEADLINE = (
    "join_title_ratings",
    "explode_genre",
    "genre_stats",
    "person_rating_summary",
    "decade_stats",
    "top_k_movies",
    "top_talent_by_profession",
    "sort_desc",
)

seconds: dict[str, float] = {}


@contextmanager
def timed(name: str, into: dict[str, float] = seconds):
    start = time.perf_counter()
    yield
    into[name] = round(time.perf_counter() - start, 3)


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def naive_run(spark, zones: Zones) -> None:
    """Nine writes, each of which recomputes its whole input from the landing files."""

    def raw(name):
        return curation.typed(curation.scan_landing(spark, zones, name), name)

    def rated():
        return curation.title_with_ratings(raw("title_basics"), raw("title_ratings"))

    out = Zones(scratch_folder(spark, "naive"))
    for name in LANDING_FILES:
        write_dataset(raw(name), out, RAW, name)
    write_dataset(rated(), out, CURATED, "title_with_ratings_nopartition")
    write_dataset(by_genre(rated()), out, CURATED, "title_by_genre")
    write_dataset(curation.genre_stats(rated()), out, CURATED, "genre_stats")
    write_dataset(curation.title_popularity(rated()), out, CURATED, "title_popularity")
    write_dataset(curation.title_by_decade(rated()), out, CURATED, "title_by_decade")
    write_dataset(
        curation.person_rating_summary(raw("name_basics"), raw("title_ratings")),
        out,
        CURATED,
        "person_rating_summary",
    )


def main() -> None:
    spark = build_session(
        "marquee bench",
        master=f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__ui__enabled=False,
        spark__ui__showConsoleProgress=False,
    )
    spark.sparkContext.setLogLevel("ERROR")

    # The landing files are the input of the run, so making them is not timed.
    zones = Zones(scratch_folder(spark, "bench"))
    for name, view in LANDING_VIEWS.items():
        write_tsv(view(spark, SF_DIR), zones.path(LANDING, LANDING_FILES[name].file))

    naive: dict[str, float] = {}
    if os.environ.get("BENCH_NAIVE", "1") != "0":
        # It runs between two runs of ours, so neither has the warmer JVM to itself.
        curation.curate(spark, Zones(zones.root))
        with timed("naive_curate", naive):
            naive_run(spark, zones)

    with timed("land_to_raw"):
        curation.land_to_raw(spark, zones)
    with timed("raw_to_curated"):
        curation.raw_to_curated(spark, zones)
    curated = round(sum(seconds.values()), 3)
    for panel, frame in build_reports(spark, zones).items():
        with timed(f"report_{panel}"):
            collect_report(frame, 100_000)
    with timed("word_count"):
        discard(word_count(table(spark, SF_DIR, "documents"), "text"))
    stage = Stage.of(spark, SF_DIR)
    stage.raw_zone()
    stage.splits()
    for name in HEADLINE:
        with timed(name):
            discard(QUERIES[name](spark, SF_DIR))
    total = round(sum(seconds.values()), 3)

    every: dict[str, float] = {}
    if os.environ.get("BENCH_ALL") == "1":
        for name, query in QUERIES.items():
            with timed(name, every):
                discard(query(spark, SF_DIR))

    rows = read_dataset(spark, zones, CURATED, "title_with_ratings_nopartition").count()
    result = {
        "metric": "landing to curated, reports, word count and headline queries",
        "value": total,
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "titles": rows,
        "curate": curated,
        **naive,
    }
    if every:
        result["all_queries"] = every
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
