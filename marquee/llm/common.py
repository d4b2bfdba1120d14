"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_folder

# Fixed value: a word is a longest run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Work:
    """A new folder below the shared scratch space for tables that a job writes and reads back.

    Written tables cut the lineage: what was written survives the loss of an executor, and the
    plan of the next step starts from a scan whose size Spark knows."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = scratch_folder(spark, label)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back. The schema is given, so an empty table reads as well."""
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is NULL."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def portions(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch, as many at a time as have ``most`` bytes of text between them, one at least."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(first, last - first)
        first = last


def digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes as 64 hex digits."""
    return F.sha2(text.cast("binary"), 256)
