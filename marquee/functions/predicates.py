"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equals(column: str, value: object) -> Column:
    return F.col(column) == F.lit(value)


def not_null(*columns: str) -> Column:
    condition = F.col(columns[0]).isNotNull()
    for c in columns[1:]:
        condition = condition & F.col(c).isNotNull()
    return condition


def in_range(column: str, low: object, high: object) -> Column:
    """Both bounds inclusive."""
    return F.col(column).between(low, high)


def in_bucket_range(source: str, low: int, high: int, width: int = 10) -> Column:
    """Whether the bucket of ``source``, a column of whole numbers, (its floor to a multiple of ``width``) is from ``low`` to
    ``high``, as a range of ``source`` itself, which a scan can use where the bucket is computed."""
    first = -(-low // width) * width
    last = (high // width + 1) * width - 1
    return in_range(source, first, last)


def at_least(column: str, threshold: object) -> Column:
    return F.col(column) >= F.lit(threshold)


def non_empty(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def mentions(
    text: str,
    word: str,
    match: str = "substring",
    case_insensitive: bool = False,
) -> Column:
    """Whether a comma-separated list mentions ``word``.

    ``match='substring'`` also finds ``director`` inside ``casting_director``;
    ``match='element'`` compares whole list elements.
    """
    listed = F.col(text)
    if case_insensitive:
        listed, word = F.lower(listed), word.lower()
    if match == "substring":
        return listed.contains(word)
    if match == "element":
        return F.array_contains(F.split(listed, ","), word)
    raise ValueError(f"match must be 'substring' or 'element', not {match!r}")


def is_empty(df: DataFrame) -> bool:
    """Whether a result has no row; stops at the first one found."""
    return df.isEmpty()
