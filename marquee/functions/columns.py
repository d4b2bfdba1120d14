"""Typing text columns and deriving measures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Type text columns in one projection; text that does not fit becomes NULL."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def split_to_array(df: DataFrame, src: str, dst: str, sep: str = ",") -> DataFrame:
    """Split at every ``sep`` (taken literally), keeping empty parts."""
    return df.withColumn(dst, F.split(src, f"\\Q{sep}\\E"))


def popularity_score(votes: str = "numVotes", rating: str = "averageRating") -> Column:
    """Votes times rating; NULL if either is."""
    return F.col(votes) * F.col(rating)


def decade_bucket(
    df: DataFrame, src: str = "startYear", dst: str = "decade", width: int = 10
) -> DataFrame:
    """Lower bound of the bucket that holds ``src``, as bigint; -5 falls into -10."""
    return df.withColumn(dst, F.floor(F.col(src) / width) * width)


def scale_measure(measure: str, divisor: float) -> Column:
    return F.col(measure) / divisor
