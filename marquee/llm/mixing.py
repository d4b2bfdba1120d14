"""Mixing sources to target weights by weighted fair queueing.

Within its source a document has a place in a fixed shuffle (the order of the MD5 of its identifier). Its virtual
finish time is the number of words of the source up to and including it, divided by the source's target; a second
round through the source follows the first. All entries are ordered by finish time, and what lies within the
total budget is taken. Sums run in two steps, over ranges of the order and within a range, with
about as many ranges as rows in a range, so that no task gets a source as a whole.

Defined results: NULL and empty texts have size 0 and take nothing. NULL is a source, the last one. Rows with one
identifier and size in one source are interchangeable. Only identifier, source and text are read, so
other columns cannot clash. An empty table gives an empty mix.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.llm.common import WORD, Work, table

WEIGHTS = (5, 2, 1)
BUDGET_PERCENT = 150
ROUNDS = 2


def _size() -> Column:
    """The number of words of a text."""
    return F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def sizes(docs: DataFrame) -> DataFrame:
    """Identifier, source, number of words and place in the shuffle. ``spot`` is the leading part of
    the order as a number from 0 to 2^32."""
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        _size().alias("size"),
        order.alias("order"),
        F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint").alias("spot"),
    )


def targets(counts: DataFrame) -> DataFrame:
    """Adds to sources with ``size`` their rank, weight and ``target``; one row per source.

    With the level L each source gets min(weight * L, cap), where L gives the budget in sum. A source is at its cap
    if the sum at L = cap / weight does not exceed the budget, so sums over the sources ordered by that ratio
    decide, and the rest share what the capped ones leave."""
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = (
        counts.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
        .withColumn("weight", weight.cast("bigint"))
        .withColumn("cap", ROUNDS * F.col("size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("budget", F.sum("size").over(everything) * F.lit(BUDGET_PERCENT / 100))
        .withColumn("all_weight", F.sum("weight").over(everything))
    )
    summed = (
        ranked.withColumn("caps", F.sum("cap").over(upto))
        .withColumn("rest", F.col("all_weight") - F.sum("weight").over(upto))
        .withColumn("full", F.col("caps") + F.col("ratio") * F.col("rest") <= F.col("budget"))
    )
    full = F.col("full")
    shared = (
        summed.withColumn("left", F.col("budget") - F.sum(F.when(full, F.col("cap")).otherwise(0)).over(everything))
        .withColumn("open", F.sum(F.when(full, 0).otherwise(F.col("weight"))).over(everything))
    )
    target = F.when(full, F.col("cap").cast("double")).otherwise(
        F.col("left") * F.col("weight") / F.when(F.col("open") > 0, F.col("open"))
    )
    return shared.select("source", "n", "size", "rank", target.alias("target"))


def _ranges(rows: Column) -> Column:
    """As many ranges as rows in each."""
    return F.ceil(F.sqrt(rows)).cast("bigint")


# The global order of the entries.
ORDER = ("finish", "rank", "round", "order", "doc_id", "size")


def queue(docs: DataFrame, work: Work) -> DataFrame:
    """Each row of ``docs`` with ``doc_id``, ``size``, ``source_size``, ``target``, ``first_finish`` (of the
    first round; each further one adds ``source_size / target``) and ``taken`` in words."""
    rows = work.stored(sizes(docs), "sizes")
    counts = rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    # One row per source; Spark broadcasts it if it is as small as it is in most cases.
    sources = work.stored(targets(counts), "sources").withColumnRenamed("size", "source_size")
    s, r = sources.withColumnRenamed("source", "__source"), rows
    placed = work.stored(
        r.join(s, r["source"].eqNullSafe(F.col("__source"))).select(
            "doc_id", "rank", "size", "order", "source_size", "target",
            F.floor(F.col("spot") * _ranges(F.col("n")) / F.lit(2.0**32)).cast("bigint").alias("range"),
        ),
        "placed",
    )
    before = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = work.stored(
        placed.groupBy("rank", "range").agg(F.sum("size").alias("sum"))
        .select("rank", "range", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset")),
        "offsets",
    )
    within = (
        Window.partitionBy("rank", "range").orderBy("order", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = work.stored(
        placed.join(offsets, ["rank", "range"]).withColumn("upto", F.col("offset") + F.sum("size").over(within))
        .drop("range", "offset"),
        "summed",
    )
    entries = (
        summed.where(F.col("size") > 0)
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(ROUNDS - 1))))
        .withColumn("finish", (F.col("upto") + F.col("round") * F.col("source_size")) / F.col("target"))
    )
    # One row: the number of documents and the budget, which is below 150 % where all sources are capped.
    whole = sources.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.least(
            F.coalesce(F.sum("source_size"), F.lit(0)) * BUDGET_PERCENT / 100,
            F.coalesce(F.sum("source_size"), F.lit(0)) * float(ROUNDS),
        ).alias("budget"),
    ).first()
    # Below 1 words are spread evenly over finish times, beyond it they thin out.
    width = math.isqrt(whole["n"]) + 1

    def part(finish: Column) -> Column:
        beyond = width + F.floor(F.log2(finish) * width)
        return F.when(finish <= 1, F.floor(finish * width)).otherwise(beyond).cast("bigint")

    entries = entries.withColumn("bin", part(F.col("finish")))
    sums = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The first range of finish times that does not fit into the budget as a whole.
    crossing = (
        entries.groupBy("bin").agg(F.sum("size").alias("sum"))
        .withColumn("before", F.sum("sum").over(sums) - F.col("sum"))
        .where(F.col("before") + F.col("sum") > whole["budget"])
        .orderBy("bin").limit(1).first()
    )
    if crossing is None:
        rounds = F.lit(ROUNDS)
    else:
        running = Window.orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        last = (
            entries.where(F.col("bin") == crossing["bin"])
            .withColumn("sum", F.lit(crossing["before"]) + F.sum("size").over(running))
            .where(F.col("sum") <= whole["budget"])
            .agg(F.max(F.struct(*ORDER)).alias("key")).first()["key"]
        )
        rounds = _rounds_before(summed, part, crossing["bin"], last)
    return summed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("upto") / F.col("target")).alias("first_finish"),
        F.when(F.col("size") > 0, rounds * F.col("size")).otherwise(0).cast("bigint").alias("taken"),
        "rank",
    )


def _rounds_before(summed: DataFrame, part: Callable[[Column], Column], last_bin: int, last: object) -> Column:
    """How many entries of a document lie at or before the last one that is taken."""
    kinds = {f.name: f.dataType for f in summed.schema} | {"finish": "double", "round": "int"}
    rounds = F.lit(0)
    for n in range(ROUNDS):
        finish = (F.col("upto") + n * F.col("source_size")) / F.col("target")
        own = {"finish": finish, "round": F.lit(n)}
        key = F.struct(*(own.get(c, F.col(c)).alias(c) for c in ORDER))
        taken = part(finish) < last_bin
        if last is not None:
            cut = F.struct(*(F.lit(last[c]).cast(kinds[c]).alias(c) for c in ORDER))
            taken = taken | ((part(finish) == last_bin) & (key <= cut))
        rounds = rounds + F.when(taken, 1).otherwise(0)
    return rounds


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the words that the mix takes of it."""
    mix = queue(table(spark, sf_dir, "documents"), Work(spark, "mixing"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = """
WITH d AS (
  SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS ord,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
c AS (
  SELECT source, sum(size) AS source_size, 2 * sum(size) AS cap,
    row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM d GROUP BY source),
w AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM c),
r AS (
  SELECT *, CAST(cap AS DOUBLE) / weight AS ratio, 1.5e0 * sum(source_size) OVER () AS budget,
    sum(weight) OVER () AS all_weight FROM w),
f AS (
  SELECT *, sum(cap) OVER o + ratio * (all_weight - sum(weight) OVER o) <= budget AS is_full
  FROM r WINDOW o AS (ORDER BY ratio, rank ROWS UNBOUNDED PRECEDING)),
t AS (
  SELECT source, source_size, rank, budget, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE
    (budget - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ()) * weight
      / sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () END AS target
  FROM f),
p AS (
  SELECT doc_id, size, ord, rank, source_size, target, budget,
    sum(size) OVER (PARTITION BY rank ORDER BY ord, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT p.*, n, (upto + n * source_size) / target AS finish
  FROM p, (VALUES (0), (1)) AS rounds(n) WHERE size > 0),
s AS (
  SELECT doc_id, ord, rank, n, size, sum(size) OVER (
    ORDER BY finish, rank, n, ord, doc_id, size ROWS UNBOUNDED PRECEDING) <= budget AS is_taken
  FROM e),
k AS (SELECT doc_id, rank, CAST(sum(size) AS BIGINT) AS taken FROM s WHERE is_taken GROUP BY doc_id, rank)
SELECT p.doc_id, p.size, CAST(source_size AS BIGINT) AS source_size, target, coalesce(taken, 0) AS taken
FROM p LEFT JOIN k ON p.doc_id = k.doc_id AND p.rank = k.rank
"""


def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, in the order of the queue. Rows that
    repeat an identifier are matched with their places in the queue one by one, by source and size; for
    that only their texts are dealt out once more."""
    work = Work(spark, "mixing-stage")
    mix = work.stored(queue(docs, work), "mix")
    repeated = work.stored(
        mix.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
        .select(F.col("doc_id").alias("__doc")),
        "repeated",
    )

    def entries(rows: DataFrame, *keep: Column) -> DataFrame:
        """One row per time that the mix takes a row."""
        rounds = F.sequence(F.lit(0).cast("bigint"), (F.col("taken") / F.col("size")).cast("bigint") - 1)
        step = F.col("source_size") / F.col("target")
        return (
            rows.where(F.col("taken") > 0)
            .select(F.col("doc_id").alias("__doc"), *keep, F.explode(rounds).alias("n"), "first_finish", step.alias("step"))
            .select("__doc", *keep, (F.col("first_finish") + F.col("n") * F.col("step")).alias("__finish"))
        )

    columns = [docs[c] for c in docs.columns]
    again = mix["doc_id"].eqNullSafe(repeated["__doc"])
    single = entries(mix.join(repeated, again, "left_anti"))
    out = docs.join(single, docs["doc_id"] == F.col("__doc")).select(*columns, "__finish")
    if not repeated.isEmpty():
        same = Window.partitionBy("doc_id")
        places = mix.join(repeated, again, "left_semi").withColumn(
            "__copy", F.row_number().over(same.orderBy("rank", "size", "first_finish"))
        )
        found = entries(places, F.col("__copy"))
        order = (F.asc_nulls_last(F.col("source").cast("string")), _size(), F.xxhash64("text"))
        given = docs.join(repeated, docs["doc_id"].eqNullSafe(repeated["__doc"]), "left_semi").withColumn(
            "__own", F.row_number().over(same.orderBy(*order))
        )
        met = given["doc_id"].eqNullSafe(found["__doc"]) & (F.col("__own") == F.col("__copy"))
        out = out.unionByName(given.join(found, met).select(*(given[c] for c in docs.columns), "__finish"))
    return out.repartitionByRange("__finish", "doc_id").sortWithinPartitions("__finish", "doc_id").drop("__finish")
