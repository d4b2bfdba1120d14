"""Databases and external tables over delimited text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _name(identifier: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in identifier.split("."))


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create the database if it is missing and make it current."""
    place = f" LOCATION {_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(name)}{place}")
    spark.catalog.setCurrentDatabase(name)


def list_databases(spark: SparkSession) -> DataFrame:
    """Column ``namespace``."""
    return spark.sql("SHOW DATABASES")


def create_external_csv_table(
    spark: SparkSession, name: str, ddl: str, location: str, sep: str = ",", quote: str = ""
) -> DataFrame:
    """A table over delimited text that stays where it is. Fields that do not fit the declared
    type are NULL, ``CHAR(n)`` pads on read, quotes are data unless ``quote`` names them, and a
    header line counts as data."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_name(name)} ({ddl}) USING csv "
        f"OPTIONS (sep {_literal(sep)}, quote {_literal(quote)}) LOCATION {_literal(location)}"
    )
    return spark.table(_name(name))
