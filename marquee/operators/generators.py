"""One row to many."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The characters that separate words (blank, tab, line feed, carriage return, form feed).
WORD = "[^ \\t\\n\\r\\f]+"


def by_genre(df: DataFrame, src: str = "genres_array", dst: str = "genre") -> DataFrame:
    """One row per title and genre; titles without genres give none."""
    return df.withColumn(dst, F.explode(src))


def known_for(df: DataFrame, src: str = "knownForArray", dst: str = "tconst") -> DataFrame:
    """One row per person and known title; people without known titles give none."""
    return df.withColumn(dst, F.explode(src))


def tokens(df: DataFrame, column: str = "value", dst: str = "word") -> DataFrame:
    """One row per word, keeping case and punctuation; other columns are repeated."""
    return df.withColumn(dst, F.explode(F.regexp_extract_all(column, F.lit(WORD), F.lit(0))))
