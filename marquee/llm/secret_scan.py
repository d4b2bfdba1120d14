"""Secret scanning with a ledger of blobs.

Every text is a version of a path (its document) and is addressed by its content. The ledger is a Parquet table of
the blobs that were scanned, the rules (with their versions) that were applied and the spans these found. A
run scans only blobs and rule versions that the ledger does not pair yet, appends what it finds, and
joins the findings back to all paths of a blob.

Positions are code points from 0, ends are exclusive. Matches of a rule are leftmost and do not overlap;
those whose value is too short are dropped afterwards.

Defined results: a NULL text is the empty blob, which has no secrets. Rows that repeat a text share its blob
and each get its findings. Only identifier and text are read, so other columns cannot clash. An empty table
gives an empty result and leaves the ledger as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import Work, digest, table, whole_text


@dataclass(frozen=True)
class Rule:
    """``value`` is the group whose length counts, 0 for the match."""

    kind: str
    version: int
    pattern: str
    value: int
    least: int

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


# Kinds in the order in which they are listed, patterns, least lengths of the value.
BASE_RULES = (
    Rule(
        "assign",
        1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]+", 0, 24),
)
# Beyond the base: the header of a private key.
RULES = (*BASE_RULES, Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1))

SPAN = "struct<start: int, place: int, end: int, kind: string>"
# In the ledger a span names the rule with its version.
FOUND = "struct<rule: string, start: int, end: int>"
LEDGER = f"blob string, rules array<string>, spans array<{FOUND}>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once. A lambda computes an outer expression once per element."""
    return F.transform(F.array(value), use)[0]


def spans_of(rule: Rule, text: Column) -> Column:
    """The spans of a rule in a text.

    Splitting at the matches gives the text between them, so the start of match i is the length of
    everything before it. Every second sum over ``between 0, match 0, between 1, ...`` is a start. Appending to an array
    copies it, so the sums are taken in blocks: with n matches blocks of the cube root of n cost least, n^(4/3) in all."""
    pattern = F.lit(rule.pattern)
    if rule.value == 0 and rule.pattern.endswith("]+") and rule.pattern.startswith("["):
        # Runs of one class match as a whole or not at all, so the short ones need no listing.
        pattern = F.lit(f"{rule.pattern[:-1]}{{{rule.least},}}")
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(rule.value)) if rule.value else matches
    between = F.split(text, pattern, -1)
    lengths = F.transform(
        F.arrays_zip(between.alias("between"), matches.alias("match"), values.alias("value")),
        # The last element has no match.
        lambda x: F.struct(
            F.length(x["between"]).alias("before"),
            F.coalesce(F.length(x["match"]), F.lit(0)).alias("size"),
            F.coalesce(F.length(x["value"]) >= rule.least, F.lit(False)).alias("long"),
        ),
    )
    none = F.array().cast(f"array<{FOUND}>")

    def step(acc: Column, x: Column) -> Column:
        first = acc["at"] + x["before"]
        last = first + x["size"]
        span = F.struct(F.lit(rule.id).alias("rule"), first.alias("start"), last.alias("end"))
        return F.struct(
            last.alias("at"),
            F.when(x["long"], F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"),
        )

    def spans(block: Column, start: Column) -> Column:
        begin = F.struct(start.alias("at"), none.alias("found")).cast(f"struct<at: int, found: array<{FOUND}>>")
        return F.aggregate(block, begin, step)["found"]

    def total(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), lambda acc, x: acc + x["before"] + x["size"])

    def blocks(all_lengths: Column) -> Column:
        n = F.size(all_lengths)
        width = F.greatest(F.lit(16), F.ceil(F.cbrt(n)).cast("int"))
        last = F.floor((n - 1) / width).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_lengths, i * width + 1, width))

    def placed(cut: Column) -> Column:
        starts = F.aggregate(
            cut, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + total(x)))
        )
        return _let(starts, lambda at: F.flatten(F.transform(cut, lambda x, i: spans(x, F.get(at, i)))))

    found = _let(lengths, lambda x: _let(blocks(x), placed))
    return F.when(F.regexp_like(text, pattern), found).otherwise(none)


def ledger_table(spark: SparkSession, path: str) -> DataFrame:
    """The ledger, empty where there is none yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan(
    docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text"
) -> DataFrame:
    """Scan what the ledger at the path ``ledger`` lacks, and give its entries of ``rules``: ``blob`` and ``spans`` of
    these versions, each with the place of its rule among ``rules``."""
    spark = docs.sparkSession
    known = (
        ledger_table(spark, ledger).select("blob", F.explode("rules").alias("rule"))
        .groupBy("blob").agg(F.collect_set("rule").alias("known"))
    )
    whole = whole_text(text)
    # One text per blob. Copies meet in the tasks that read them, before anything is sent.
    blobs = docs.groupBy(digest(whole).alias("blob")).agg(F.first(whole).alias("text"))
    asked = F.array(*(F.lit(r.id) for r in rules))
    unseen = (
        blobs.join(known, "blob", "left")
        .withColumn("rules", F.array_except(asked, F.coalesce("known", F.array().cast("array<string>"))))
        .where(F.size("rules") > 0)
    )
    none = F.array().cast(f"array<{FOUND}>")
    parts = [F.when(F.array_contains("rules", r.id), spans_of(r, F.col("text"))).otherwise(none) for r in rules]
    unseen.select("blob", "rules", F.concat(*parts).alias("spans")).write.mode("append").parquet(ledger)
    kinds = F.array(*(F.lit(r.kind) for r in rules))

    def named(s: Column) -> Column:
        place = F.array_position(asked, s["rule"]).cast("int")
        return F.struct(
            s["start"].alias("start"), (place - 1).alias("place"), s["end"].alias("end"), F.element_at(kinds, place).alias("kind")
        )

    # A blob has an entry for each run that found new rules for it.
    wanted = F.filter("spans", lambda s: F.array_contains(asked, s["rule"]))
    return (
        ledger_table(spark, ledger).where(F.size(F.array_intersect("rules", asked)) > 0)
        .select("blob", F.transform(wanted, named).alias("spans"))
    )


def findings(docs: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id`` and ``spans`` of every document. Blobs without findings stay out of the join. Runs at the same time
    may both have entered a blob; its spans count once."""
    entries = scan(docs, ledger, rules).where(F.size("spans") > 0)
    spans = F.array_distinct(F.flatten(F.collect_list("spans")))
    once = entries.groupBy("blob").agg(F.array_sort(spans).alias("spans"))
    work = Work(docs.sparkSession, "findings")
    # Reading them back lets the join split blobs with many paths.
    once = work.stored(once, "spans")
    paths = docs.select("doc_id", digest(whole_text("text")).alias("blob"))
    none = F.array().cast(f"array<{SPAN}>")
    return paths.join(once, "blob", "left").select(
        "doc_id", F.coalesce("spans", none).alias("spans")
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of each document, scanned with a new ledger."""
    found = findings(table(spark, sf_dir, "documents"), Work(spark, "secrets").path("ledger"))
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE_RULES]))
    return found.select(
        "doc_id",
        *(_count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def _found_sql(rule: Rule, place: int) -> str:
    """Lengths of the text between the matches, of the matches and of their values."""
    pattern = rule.pattern.replace("'", "''")
    return (
        f"SELECT id, {place} AS place, '{rule.kind}' AS kind, {rule.least} AS least, "
        f"list_transform(regexp_split_to_array(text, '{pattern}'), lambda x: length(x)) AS before, "
        f"list_transform(regexp_extract_all(text, '{pattern}', 0), lambda x: length(x)) AS size, "
        f"list_transform(regexp_extract_all(text, '{pattern}', {rule.value}), lambda x: length(x)) AS worth FROM texts"
    )


_FOUND = " UNION ALL ".join(_found_sql(rule, place) for place, rule in enumerate(RULES))
_BASE = ", ".join(f"'{rule.kind}'" for rule in BASE_RULES)
_COUNTS = ", ".join(f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in BASE_RULES)

OP4_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text FROM documents),
found AS ({_FOUND}),
single AS (SELECT id, place, kind, least, unnest(range(1, len(size) + 1)) AS i, unnest(before[:len(size)]) AS before,
  unnest(size) AS size, unnest(worth) AS worth FROM found),
placed AS (SELECT *, sum(before + size) OVER (PARTITION BY id, place ORDER BY i) AS stop FROM single),
spans AS (SELECT id, place, kind, stop - size AS start, concat_ws(':', kind, stop - size, stop) AS span
  FROM placed WHERE worth >= least),
listed AS (SELECT id, {_COUNTS},
  string_agg(span, ',' ORDER BY start, place) FILTER (kind IN ({_BASE})) AS base,
  string_agg(span, ',' ORDER BY start, place) AS spans FROM spans GROUP BY id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE_RULES)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN listed USING (id)
"""
