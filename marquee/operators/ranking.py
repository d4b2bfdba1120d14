"""Orders, top-k and positions. Every ranking takes tie-break columns, so results are repeatable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.predicates import mentions

# Of the quantiles that bound a large top-k.
ACCURACY = 10_000


def sort_desc(df: DataFrame, by: str, *tiebreak: str | Column) -> DataFrame:
    """Highest first, NULLs last."""
    return df.orderBy(F.desc_nulls_last(by), *tiebreak)


def top_k(df: DataFrame, by: str, k: int, *tiebreak: str | Column) -> DataFrame:
    """The ``k`` rows with the highest ``by``, in order. Each task keeps ``k`` rows."""
    return sort_desc(df, by, *tiebreak).limit(k)


def least_of_top_k(df: DataFrame, by: str, k: int) -> object | None:
    """A value that at least ``k`` rows reach in the numeric column ``by``, and not many more; None if there may be fewer.

    One pass over the column: each task sums it up in a digest of fixed size, and a row of quantiles comes back.
    A quantile can be off by a share of 1 / ``ACCURACY`` of the rows, which is allowed for."""
    shares = [2.0**-j for j in range(1, 31)]
    got = df.where(F.col(by).isNotNull()).agg(
        F.count("*").alias("n"), F.percentile_approx(by, [1 - s for s in shares], ACCURACY).alias("least")
    ).first()
    reached = [v for s, v in zip(shares, got["least"] or []) if got["n"] * (s - 1 / ACCURACY) > k + 1]
    return reached[-1] if reached else None


def top_k_above(df: DataFrame, by: str, k: int, *tiebreak: str | Column) -> DataFrame:
    """:func:`top_k` for a large ``k`` of many rows, for a ``df`` of scans and narrow steps: a lower bound of the
    ``k``-th value goes to the scan first, so what the tasks send to the one that merges is near ``k`` rows in all
    and not ``k`` from each."""
    least = least_of_top_k(df, by, k)
    return top_k(df if least is None else df.where(F.col(by) >= F.lit(least)), by, k, *tiebreak)


def n_largest(df: DataFrame, by: str, k: int, *prior_order: str | Column) -> DataFrame:
    """The ``k`` highest values of an already ordered frame: ties keep ``prior_order``, NULLs
    only fill up the tail."""
    return top_k(df, by, k, *prior_order)


def with_pos(df: DataFrame, k: int, *order: str | Column, pos: str = "pos") -> DataFrame:
    """The first ``k`` rows in ``order`` with their position from 0. Positions need one task, so
    the bound is part of the call."""
    first = df.orderBy(*order).limit(k)
    return first.withColumn(
        pos, (F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint")
    )


def every_nth(df: DataFrame, n: int, k: int, *order: str | Column) -> DataFrame:
    """Rows 0, n, 2n, ... of the first ``k`` in ``order``."""
    return with_pos(df, k, *order).where(F.col("pos") % n == 0)


def label_pos_rel(
    df: DataFrame, value: str, share: float, k: int, *order: str | Column, dst: str = "label_x"
) -> DataFrame:
    """Label position of the first ``k`` rows in ``order``: the value and ``share`` of their maximum."""
    first = df.orderBy(*order).limit(k)
    return first.withColumn(dst, F.col(value) + F.max(value).over(Window.partitionBy()) * share)


def top_k_per_category(
    df: DataFrame,
    text: str,
    categories: Sequence[str],
    k: int,
    by: str,
    *tiebreak: str | Column,
    category: str = "category",
    match: str = "substring",
    case_insensitive: bool = False,
) -> DataFrame:
    """The ``k`` rows with the highest ``by`` for each category that ``text`` mentions, with ``pos``
    from 0, in one pass. A row can count for several categories; each task keeps ``k`` rows per
    category before the shuffle."""
    mentioned = F.array(
        *(F.when(mentions(text, word, match, case_insensitive), word) for word in categories)
    )
    order = Window.partitionBy(category).orderBy(F.desc_nulls_last(by), *tiebreak)
    return (
        df.withColumn(category, F.explode(mentioned))
        .where(F.col(category).isNotNull())
        .withColumn("pos", F.row_number().over(order))
        .where(F.col("pos") <= k)
        .withColumn("pos", (F.col("pos") - 1).cast("bigint"))
    )
