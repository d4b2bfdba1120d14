"""Small frames made on the driver."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_rows(spark: SparkSession, **columns: list) -> DataFrame:
    """A few rows from column lists, handed over as Arrow so that no Python worker is needed."""
    return spark.createDataFrame(pa.table(columns))
