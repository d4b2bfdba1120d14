"""Equi-joins that stay balanced when one key holds a large part of the rows.

Adaptive execution splits skewed partitions of a join of two scans, but of a left join only on
the left side, and not next to an aggregate. For the other cases the keys that need splitting
are counted first and only those are salted; all other rows join as usual. The counts
decide how the work is spread, never which rows come out.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import scratch_folder
from marquee.sources.local import local_rows

# A key is split once it has more rows than one task should join.
ROWS_PER_TASK = 4_000_000
# Keys are first counted together in this many buckets.
BUCKETS = 32_768


def heavy_parts(
    sides: Mapping[str, DataFrame], key: str, rows_per_task: int | None = None
) -> DataFrame | None:
    """The values of ``key`` with more than ``rows_per_task`` rows on a side, as a stored table: ``key`` and a column
    per side with the parts to split its rows into (1 where the side has fewer). None if there is no such key.

    The first job scans the key columns and counts rows per hash bucket, which shuffles a
    small table of fixed size per task instead of the keys. Without a bucket that stands out there
    is no heavy key; else a second job counts the keys of those buckets and writes them. Only buckets,
    whose number is fixed, reach the driver; the keys stay in a table however many they are.
    """
    rows_per_task = rows_per_task or ROWS_PER_TASK
    names = list(sides)
    spark = sides[names[0]].sparkSession
    keys = reduce(
        DataFrame.unionByName,
        (df.select(F.lit(i).alias("side"), F.col(key).alias("key")) for i, df in enumerate(sides.values())),
    ).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))
    full = (
        keys.groupBy("side", "bucket")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > rows_per_task)
        .collect()  # a row per side and bucket at most
    )
    suspects = []
    for side in range(len(names)):
        loads = {r["bucket"]: r["n"] for r in full if r["side"] == side}
        usual = median([*loads.values(), *[0] * (BUCKETS - len(loads))])
        suspects += [(side, b) for b, n in loads.items() if n > usual + rows_per_task]
    if not suspects:
        return None
    marked = local_rows(spark, side=[s for s, _ in suspects], bucket=[b for _, b in suspects])
    heavy = (
        keys.join(F.broadcast(marked), ["side", "bucket"])
        .groupBy("side", "key")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > rows_per_task)
    )
    parts = F.ceil(F.col("n") / rows_per_task).cast("int")
    table = heavy.groupBy("key").agg(
        *(F.coalesce(F.max(F.when(F.col("side") == i, parts)), F.lit(1)).alias(name) for i, name in enumerate(names))
    )
    path = f"{scratch_folder(spark, 'hot-keys', lasting=True)}/parts"
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


@dataclass(frozen=True)
class SplitPlan:
    """Which keys of a join are split, and into how many parts on each side: a table ``key``, ``left``, ``right``.
    A key that is split on the right must be there, or its left rows would miss the cell that keeps them."""

    keys: DataFrame | None = None
    left: bool = False
    right: bool = False
    # Parts of the rows without a key, which are on the left.
    nulls: int = 1

    def __bool__(self) -> bool:
        return self.left or self.right or self.nulls > 1

    @classmethod
    def of(cls, parts: DataFrame | None) -> SplitPlan:
        """The plan of a table as :func:`heavy_parts` gives it for ``left``, ``right`` or both. One row of
        maxima is read from it."""
        if parts is None:
            return cls()
        both = parts.select(
            "key", *(F.col(s) if s in parts.columns else F.lit(1).alias(s) for s in ("left", "right"))
        )
        known = F.col("key").isNotNull()
        most = both.agg(
            F.max(F.when(known, F.col("left"))).alias("left"),
            F.max(F.when(known, F.col("right"))).alias("right"),
            F.max(F.when(~known, F.col("left"))).alias("nulls"),
        ).first()
        return cls(
            both.where(known), (most["left"] or 1) > 1, (most["right"] or 1) > 1, most["nulls"] or 1
        )


def plan_splits(
    left: DataFrame, right: DataFrame, key: str, rows_per_task: int | None = None
) -> SplitPlan:
    """Find the keys to split in a join of ``left`` and ``right``."""
    return SplitPlan.of(heavy_parts({"left": left, "right": right}, key, rows_per_task))


def _dealt(parts: Column) -> Column:
    """Rows dealt to their parts in turn, in the order of reading."""
    return F.pmod(F.col("__read"), parts)


def _copied(parts: Column) -> Column:
    """A copy of the row for each part of the other side."""
    zero = F.lit(0).cast("bigint")
    return F.explode(F.when(parts > 1, F.sequence(zero, parts - 1)).otherwise(F.array(zero)))


def split_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "left", plan: SplitPlan | None = None
) -> DataFrame:
    """``left.join(right, key, how)`` for ``how`` left or inner, with the keys of ``plan`` split.

    A key with ``a`` parts on the left and ``b`` on the right becomes ``a x b`` cells. Each left row
    belongs to one of the ``a`` parts and is copied to the ``b`` cells of it, each right row the other
    way round, so every pair meets in exactly one cell. Rows are dealt in their order of
    reading, which also spreads copies of one row. Apply it to scans or narrow steps on
    scans: a task that runs again then deals its rows alike. The table of split keys is joined to both sides; Spark
    broadcasts it while it is small and shuffles by it, with adaptive splits, when it is not.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    if not plan:
        return left.join(right, key, how)

    rest = [c for c in left.columns if c != key] + [c for c in right.columns if c != key]
    # Numbered before anything is shuffled, so that a task that runs again deals its rows alike.
    left = left.withColumn("__read", F.monotonically_increasing_id())
    right = right.withColumn("__read", F.monotonically_increasing_id())
    a, b = F.lit(1), F.coalesce("__b", F.lit(1))
    if plan.left or plan.right:
        counts = plan.keys.select(
            F.col("key").alias(key), F.col("left").alias("__a"), F.when(F.col("right") > 1, F.col("right")).alias("__b")
        )
        left, right = left.join(counts, key, "left"), right.join(counts, key, "left")
        a = F.coalesce("__a", F.lit(1))

    on = [key]
    if plan.left or plan.nulls > 1:
        on.append("__i")
        # NULL meets nothing, so it needs parts on the left only and no copies on the right.
        left = left.withColumn("__i", _dealt(F.when(F.col(key).isNull(), plan.nulls).otherwise(a)))
        # Without copies it is 0 on the right, but not as a literal, which the optimizer would
        # take out of the join keys.
        right = right.withColumn("__i", _copied(a) if plan.left else _dealt(F.lit(1)))
    if plan.right:
        on.append("__j")
        left = left.withColumn("__j", _copied(b)).withColumn("__split", b > 1)
        right = right.withColumn("__j", _dealt(b)).withColumn("__hit", F.lit(True))
    left, right = left.drop("__read"), right.drop("__read")
    joined = left.drop("__a", "__b").join(right.drop("__a", "__b"), on, how)
    if plan.right and how == "left":
        # Cells of a split key that hold no partner for this row; another cell does.
        joined = joined.where(~F.col("__split") | F.col("__hit"))
    return joined.select(key, *rest)
