"""Chart labels and label positions.

Numbers are formatted with ``format_number`` and a digit pattern: it rounds the exact
binary value half to even, as the charts' original labels do (2.675 gives 2.67).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fmt_fixed(c: str | Column, digits: int = 2) -> Column:
    """Fixed number of decimals, no grouping."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", _column(c), F.lit(pattern))


def truncate_label(c: str | Column, n: int) -> Column:
    """First ``n`` characters and ``...`` if the text is longer; NULL stays NULL."""
    c = _column(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def fmt_int(c: str | Column) -> Column:
    """Integer part with thousands separators."""
    return F.format_number(_column(c).try_cast("bigint"), 0)


def fmt_minutes(c: str | Column) -> Column:
    """Whole minutes, cut off; NULL stays NULL."""
    return F.concat(_column(c).try_cast("bigint").cast("string"), F.lit(" min"))


def fmt_millions(c: str | Column) -> Column:
    return F.concat(fmt_fixed(_column(c) / F.lit(1e6), 1), F.lit("M"))


def fmt_rating_count(rating: str | Column, count: str | Column) -> Column:
    """``7.25 (12)``"""
    return F.concat(
        fmt_fixed(rating, 2),
        F.lit(" ("),
        _column(count).try_cast("bigint").cast("string"),
        F.lit(")"),
    )


def capitalize(c: str | Column) -> Column:
    """First character upper case, the rest lower case."""
    c = _column(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2**31 - 1)))


# The texts of the talent panels.
PANEL_TITLE = "Top {}s por Rating"
EMPTY_PANEL_TITLE = "{}s"
EMPTY_PANEL_LABEL = "No hay datos\npara {}"


def fill(template: str, c: str | Column) -> Column:
    """``template`` with the column's value in place of ``{}``."""
    before, after = template.split("{}")
    return F.concat(F.lit(before), _column(c), F.lit(after))


def panel_title(category: str | Column) -> Column:
    return fill(PANEL_TITLE, capitalize(category))


def label_pos(value: str | Column, offset: float) -> Column:
    """Where a bar's label goes: a constant distance from its end."""
    return _column(value) + F.lit(offset)
