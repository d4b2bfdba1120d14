"""Parquet datasets of the raw and curated zones, and the bounded hand-over to pandas."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession

from marquee.zones import Zones

if TYPE_CHECKING:
    import pandas as pd

# Reads can be split between row groups only; one of this size, before compression, holds under a million titles.
ROW_GROUP_BYTES = 32 << 20


def read_dataset(spark: SparkSession, zones: Zones, zone: str, name: str) -> DataFrame:
    """A dataset below the given zones; ``plans.generations.published`` gives those of the newest run."""
    return spark.read.parquet(zones.path(zone, name))


def write_dataset(
    df: DataFrame, zones: Zones, zone: str, name: str, mode: str = "overwrite"
) -> None:
    """Full replacement by default, unpartitioned. Adaptive execution sizes the files after a
    shuffle; a map-only job writes one file per input split. Zstandard takes about half the bytes of the default."""
    writer = df.write.mode(mode).option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES)
    writer.parquet(zones.path(zone, name))


def collect_report(df: DataFrame, max_rows: int) -> pd.DataFrame:
    """A finished report as a pandas frame; refuses a frame larger than ``max_rows``."""
    frame = df.limit(max_rows + 1).toPandas()
    if len(frame) > max_rows:
        raise ValueError(f"report has more than {max_rows} rows")
    return frame
