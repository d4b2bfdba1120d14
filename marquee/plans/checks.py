"""Whether the zones are complete."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.plans.generations import published
from marquee.sources.local import local_rows
from marquee.zones import CURATED, CURATED_DATASETS, LANDING, LANDING_FILES, RAW, Zones

# The fewest files and datasets a complete zone holds.
MIN_LANDING_FILES = 3
MIN_DATASETS = {RAW: 3, CURATED: 6}


def _absent(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in (error.getCondition() or "")


def _entries(spark: SparkSession, zones: Zones, zone: str) -> DataFrame:
    """Files and folders directly below a zone: ``entry``, ``n_files``. Lists names, reads no data."""
    folder = zones.path(zone)
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        ).select("path")
    except AnalysisException as error:
        if not _absent(error):
            raise
        files = spark.range(0).select(F.lit("").alias("path"))
    below = F.substring_index("path", f"/{zone}/{zones.catalogue}/", -1)
    return (
        files.select(F.substring_index(below, "/", 1).alias("entry"))
        .groupBy("entry")
        .agg(F.count("*").alias("n_files"))
    )


def _dataset_counts(spark: SparkSession, path: str) -> DataFrame | None:
    """``n_files`` and ``n_rows`` of a dataset, counted in the executors from the file footers; None if it is absent."""
    try:
        files = spark.read.parquet(path)
    except AnalysisException as error:
        if not _absent(error):
            raise
        return None
    per_file = files.groupBy("_metadata.file_path").agg(F.count("*").alias("n"))
    return per_file.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def check_landing(
    spark: SparkSession,
    zones: Zones,
    expected: Mapping[str, str] | None = None,
    lines: bool = False,
) -> DataFrame:
    """One row per expected landing file: ``dataset``, ``present``, ``n_tsv`` and ``ok``, which holds when
    all expected files are there and the zone has at least three TSV files. With ``lines`` the files are
    read, and ``n_lines`` counts their lines without the headers (NULL if absent)."""
    expected = expected or {name: spec.file for name, spec in LANDING_FILES.items()}
    wanted = local_rows(spark, dataset=list(expected), entry=list(expected.values()))
    tsv = _entries(spark, zones, LANDING).where(F.col("entry").endswith(".tsv"))
    # One row per name below the zone folder, so the summary row needs a single small task.
    summary = tsv.join(F.broadcast(wanted), "entry", "left").agg(
        F.count("*").alias("n_tsv"),
        F.collect_set("dataset").alias("found"),
    )
    checked = summary.select(
        F.explode(F.array(*(F.lit(d) for d in expected))).alias("dataset"), "n_tsv", "found"
    ).select(
        "dataset",
        F.array_contains("found", F.col("dataset")).alias("present"),
        "n_tsv",
        ((F.size("found") == len(expected)) & (F.col("n_tsv") >= MIN_LANDING_FILES)).alias("ok"),
    )
    if not lines:
        return checked
    counts = spark.range(0).select(F.lit("").alias("dataset"), F.col("id").alias("n_lines"))
    for name, file in expected.items():
        try:
            text = spark.read.text(zones.path(LANDING, file))
        except AnalysisException as error:
            if not _absent(error):
                raise
            continue
        per_file = text.groupBy("_metadata.file_path").agg((F.count("*") - 1).alias("n"))
        total = per_file.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines"))
        counts = counts.unionByName(total.select(F.lit(name).alias("dataset"), "n_lines"))
    return checked.join(counts, "dataset", "left")


def require_landing(spark: SparkSession, zones: Zones) -> None:
    """Raise unless the landing zone is complete."""
    rows = check_landing(spark, zones).collect()
    if not all(r["ok"] for r in rows):
        missing = [r["dataset"] for r in rows if not r["present"]]
        raise FileNotFoundError(
            f"{zones.path(LANDING)} is incomplete: {rows[0]['n_tsv']} TSV files, missing {missing}"
        )


def zone_inventory(
    spark: SparkSession,
    zones: Zones,
    expected: Mapping[str, Sequence[str]] | None = None,
    minimum: Mapping[str, int] = MIN_DATASETS,
) -> DataFrame:
    """One row per expected dataset: ``zone``, ``dataset``, ``n_files`` (with rows), ``n_rows`` (NULL if absent) and
    ``ok``, which holds when it is there and its zone has at least ``minimum`` of the expected datasets; other folders
    do not count. A dataset that is there but cannot be read is an error. Looks at the newest generation."""
    zones = published(spark, zones)
    expected = expected or {RAW: tuple(LANDING_FILES), CURATED: CURATED_DATASETS}
    inventory = None
    for zone, names in expected.items():
        counts = [_dataset_counts(spark, zones.path(zone, name)) for name in names]
        complete = sum(c is not None for c in counts) >= minimum.get(zone, 0)
        for name, found in zip(names, counts):
            here = found is not None
            rows = found if here else spark.range(1, numPartitions=1).select(
                F.lit(0).cast("bigint").alias("n_files"), F.lit(None).cast("bigint").alias("n_rows")
            )
            line = rows.select(
                F.lit(zone).alias("zone"),
                F.lit(name).alias("dataset"),
                "n_files",
                "n_rows",
                F.lit(here and complete).alias("ok"),
            )
            inventory = line if inventory is None else inventory.unionByName(line)
    return inventory


def require_curated(spark: SparkSession, zones: Zones) -> None:
    """Raise unless every curated dataset is there, naming those that are not."""
    rows = zone_inventory(spark, zones, {CURATED: CURATED_DATASETS}).collect()
    missing = [r["dataset"] for r in rows if r["n_rows"] is None]
    if missing:
        raise FileNotFoundError(f"{zones.path(CURATED)} lacks {missing}")
