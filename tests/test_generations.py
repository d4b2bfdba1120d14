"""Runs become visible at once, and a run that fails changes nothing for readers."""

import pytest
from pyspark.sql import functions as F

from marquee.plans import checks, curation, reports
from marquee.plans.generations import generations, published
from marquee.sources.datasets import read_dataset
from marquee.zones import CURATED, CURATED_DATASETS, LANDING, LANDING_FILES, RAW, Zones


def land(folder, year):
    folder.mkdir(parents=True, exist_ok=True)
    body = {
        "title_basics": [f"tt{i}\tmovie\tT{i}\t{year}\t\\N\t90\tDrama" for i in range(5)],
        "title_ratings": [f"tt{i}\t5.0\t10" for i in range(4)],
        "name_basics": [f"nm{i}\tP{i}\tactor\ttt{i},tt4" for i in range(3)],
    }
    for name, spec in LANDING_FILES.items():
        (folder / spec.file).write_text("\n".join(["\t".join(spec.required), *body[name]]) + "\n")


def contents(spark, zones):
    at = published(spark, zones)
    names = [(RAW, n) for n in LANDING_FILES] + [(CURATED, n) for n in CURATED_DATASETS]
    return {n: sorted(map(str, read_dataset(spark, at, *n).collect())) for n in names}


def test_fifth_write_fails_and_readers_keep_the_old_run(spark, tmp_path, monkeypatch):
    zones = Zones(str(tmp_path))
    assert published(spark, zones) == zones and generations(spark, zones) is None
    land(tmp_path / LANDING / "films", 1950)
    first = curation.curate(spark, zones)
    before = contents(spark, zones)
    assert published(spark, zones) == first and published(spark, first) is first

    land(tmp_path / LANDING / "films", 1999)
    real, calls = curation.write_dataset, []

    def failing(df, *args, **kwargs):
        calls.append(args)
        if len(calls) == 5:
            raise RuntimeError("no space")
        real(df, *args, **kwargs)

    monkeypatch.setattr(curation, "write_dataset", failing)
    with pytest.raises(RuntimeError, match="no space"):
        curation.curate(spark, zones)
    assert len(calls) >= 5
    assert published(spark, zones) == first and contents(spark, zones) == before
    assert [r["ok"] for r in checks.zone_inventory(spark, zones).collect()] == [True] * 9

    monkeypatch.undo()
    second = curation.curate(spark, zones)
    assert second != first and published(spark, zones) == second
    assert generations(spark, zones).count() == 2
    after = contents(spark, zones)
    assert all(after[k] != before[k] for k in ((RAW, "title_basics"), (CURATED, "title_by_decade")))
    # The old generation is still whole for readers that are under way.
    assert read_dataset(spark, first, CURATED, "title_by_decade").where("startYear = 1950").count() == 5
    decades = reports.build_reports(spark, zones)["decades"].collect()
    assert [(r["decade"], r["movie_count"]) for r in decades] == [(1990, 5)]


def test_foreign_folders_and_short_zones_are_not_complete(spark, tmp_path):
    zones = Zones(str(tmp_path))
    for name in ("genre_stats", *(f"unlisted{i}" for i in range(9))):
        spark.range(3).write.parquet(zones.path(CURATED, name))
    spark.range(0).write.parquet(zones.path(RAW, "title_basics"))
    found = {r["dataset"]: r for r in checks.zone_inventory(spark, zones).collect()}
    assert len(found) == 9 and not any(r["ok"] for r in found.values())
    assert found["genre_stats"]["n_rows"] == 3 and found["title_basics"]["n_rows"] == 0
    plan = checks.zone_inventory(spark, zones)._jdf.queryExecution().toString()
    assert "binaryFile" not in plan and "unlisted" not in plan


def test_published_bucket_range_reads_whole_buckets(spark):
    from marquee.functions.predicates import in_bucket_range, in_range

    years = spark.range(-30, 60).select(F.col("id").cast("int").alias("y"))
    years = years.unionByName(spark.range(1).select(F.lit(None).cast("int").alias("y")))
    for low, high, width in ((-10, 20, 10), (-7, 13, 4), (3, 3, 5), (0, -10, 10)):
        bucket = years.withColumn("b", F.floor(F.col("y") / width) * width)
        want = {r["y"] for r in bucket.where(in_range("b", low, high)).collect()}
        assert {r["y"] for r in years.where(in_bucket_range("y", low, high, width)).collect()} == want
