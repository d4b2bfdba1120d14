"""Delimited and plain text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_tsv(
    spark: SparkSession, path: str, required: Iterable[str] = (), quote: str = ""
) -> DataFrame:
    r"""Tab-separated text with a header line; ``\N`` and empty fields are NULL, all columns strings.

    Columns are bound by header name. With several files under ``path`` each header must be
    the same, else the read fails rather than shifting columns. The format has no quoting,
    so a ``"`` is data; pass ``quote='"'`` for files that do quote.
    """
    df = (
        spark.read.option("sep", "\t")
        .option("header", True)
        .option("nullValue", "\\N")
        .option("quote", quote)
        .option("enforceSchema", False)
        .csv(path)
    )
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}; it has {df.columns}")
    return df


def write_tsv(
    df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none"
) -> None:
    r"""The inverse of :func:`read_tsv`: header line, ``\N`` for NULL, no quoting. Empty texts read back as
    NULL. A value that the format cannot hold (with a tab or line end, or a literal ``\N``) is an error.
    A compressed file is later read by one task, so compress only what is written in many small parts."""
    held = [
        F.when(
            F.col(f"`{f.name}`").cast("string").rlike(r"[\t\r\n]|^\\N$"),
            F.raise_error(F.lit(f"{f.name} holds a tab, a line end or the NULL mark")).cast(f.dataType),
        ).otherwise(F.col(f"`{f.name}`")).alias(f.name)
        for f in df.schema
    ]
    (
        df.select(*held).write.mode(mode)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .option("sep", "\t")
        .option("header", True)
        .option("nullValue", "\\N")
        .option("quote", "")
        .option("compression", compression)
        .csv(path)
    )


def read_csv_positional(spark: SparkSession, path: str) -> DataFrame:
    """Comma-separated text without a header: ``_c0``, ``_c1``, ... as strings."""
    return spark.read.csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One line per row, fields joined by tabs."""
    df.select(
        F.concat_ws("\t", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns))
    ).write.mode(mode).text(path)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Any first ``n`` rows, in no particular order."""
    return df.limit(n)
