"""Whole runs that become visible at once.

A run writes its datasets into folders of its own, a generation. When all are written it adds one line to the manifest;
that is one small file which the writer renames into place, so a reader sees the generation before or the new
one, never a mixture. A run that fails leaves folders that no line names.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.local import local_rows
from marquee.zones import Zones

LINE = "number bigint, generation string"


def generations(spark: SparkSession, zones: Zones) -> DataFrame | None:
    """The lines of the manifest: ``number`` and ``generation`` of each published run, None before the first."""
    try:
        return spark.read.schema(LINE).json(zones.manifest)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return None


def published(spark: SparkSession, zones: Zones) -> Zones:
    """The zones of the newest published generation. Zones that name a generation, and those without a manifest,
    whose datasets lie directly below the catalogue, are given back as they are."""
    lines = None if zones.generation else generations(spark, zones)
    newest = lines and lines.orderBy(F.desc("number"), F.desc("generation")).first()
    return replace(zones, generation=newest["generation"]) if newest else zones


def new_generation(zones: Zones) -> Zones:
    """Zones for a run to write to."""
    return replace(zones, generation=f"run-{uuid.uuid4().hex}")


def publish(spark: SparkSession, run: Zones) -> None:
    """Make a written generation the newest one."""
    lines = generations(spark, run)
    last = lines.agg(F.max("number")).first()[0] if lines else None
    line = local_rows(spark, number=[(last or 0) + 1], generation=[run.generation])
    line.coalesce(1).write.mode("append").json(run.manifest)
