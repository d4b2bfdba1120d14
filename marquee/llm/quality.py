"""A quality classifier that is a sparse ensemble of rules over statistics of the text.

Trees are grown on the statistics of a bounded labelled sample. Every path from a root to a node is a rule, a
conjunction of comparisons. A logistic model with an L1 penalty gives most rules the weight 0; the rest become one Spark
column expression, which scores all documents without Python.

Defined results: NULL and empty texts have the statistics of an empty text (all 0) and are scored
by them. If the sample lacks one of the labels, every score is the share of 1 in it, and 0 without any sample.
Repeated rows each give a row. Only identifier and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import WORD, Work, table, whole_text
from marquee.llm.labelled import held_out, sample

TRAIN_ROWS = 20_000
TREES = 12
DEPTH = 3
PENALTY = 0.001
SEED = 7


def statistics(text: Column) -> dict[str, Column]:
    """Statistics of a text by name. ``words`` and ``lines`` are each split once."""
    words, lines = F.col("__words"), F.col("__lines")
    chars, n_words = F.length("__text"), F.size("__words")

    def share(pattern: str) -> Column:
        """Share of the characters that match."""
        rest = F.length(F.regexp_replace("__text", pattern, ""))
        return F.when(chars > 0, (chars - rest) / chars).otherwise(0.0)

    def per(part: Column, whole: Column) -> Column:
        return F.when(whole > 0, part / whole).otherwise(0.0)

    return {
        "log_words": F.log1p(n_words.cast("double")),
        "word_length": per(chars.cast("double"), n_words),
        "upper": share(r"\p{Lu}+"),
        "letters": share(r"[\p{L}\x20\n]+"),
        "digits": share(r"[0-9]+"),
        "symbols": share(r"[#$%&*|<>{}=_~^@\\/+]+"),
        "exclaimed": share(r"[!?]+"),
        "distinct": per(F.size(F.array_distinct(words)).cast("double"), n_words),
        "line_words": per(n_words.cast("double"), F.size(lines)),
        "distinct_lines": per(F.size(F.array_distinct(lines)).cast("double"), F.size(lines)),
    }


STATISTICS = tuple(
    "log_words word_length upper letters digits symbols exclaimed distinct line_words distinct_lines".split()
)


def measured(rows: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the statistics of ``text``."""
    split = rows.select(
        *keep,
        F.col("text").alias("__text"),
        F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("__words"),
        F.split("text", "\n").alias("__lines"),
    )
    return split.select(*keep, *(c.cast("double").alias(n) for n, c in statistics(F.col("__text")).items()))


Condition = tuple[str, str, float]


@dataclass(frozen=True)
class Rules:
    """Score = logistic(base + sum of the weights of the rules that hold)."""

    base: float
    weighted: tuple[tuple[float, tuple[Condition, ...]], ...] = ()

    def column(self) -> Column:
        total = reduce(
            lambda s, wr: s + F.when(holds(wr[1]), F.lit(wr[0])).otherwise(0.0),
            self.weighted,
            F.lit(self.base),
        )
        return 1 / (1 + F.exp(-total))


def holds(rule: tuple[Condition, ...]) -> Column:
    tests = (F.col(n) <= v if op == "<=" else F.col(n) > v for n, op, v in rule)
    return reduce(lambda a, b: a & b, tests)


def paths(tree_text: str, names: tuple[str, ...]) -> set[tuple[Condition, ...]]:
    """All paths from a root to a node in the text form of trees, as rules in canonical form: of
    several bounds on one side of a statistic only the tightest counts."""
    line = re.compile(r"^(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")
    rules, path = set(), []
    for text in tree_text.splitlines():
        if not (m := line.match(text)):
            if "Tree " in text:
                path = []
            continue
        depth = len(m[1])
        path = [(d, c) for d, c in path if d < depth]
        path.append((depth, (names[int(m[3])], m[4], float(m[5]))))
        bounds: dict[tuple[str, str], float] = {}
        for _, (name, op, value) in path:
            tighter = min if op == "<=" else max
            bounds[name, op] = tighter(value, bounds.get((name, op), value))
        rules.add(tuple(sorted((n, op, v) for (n, op), v in bounds.items())))
    return rules


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Rules:
    """Rules and weights from the labelled rows outside of the held-out fifth."""
    spark = docs.sparkSession
    work = Work(spark, "quality")
    picked = sample(docs, labels, label, ~held_out("doc_id", 5, 0), rows)
    train = work.stored(
        measured(picked, "label", "fold").orderBy("fold", "label").coalesce(1), "sample"
    )
    n, ones = train.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < ones < n:
        share = ones / n if n else 0.0
        return Rules({0.0: -1e3, 1.0: 1e3}[share])
    # Both labels count alike, so that rules are also found for the rarer one.
    weight = F.when(F.col("label") == 1, n / (2.0 * ones)).otherwise(n / (2.0 * (n - ones)))
    rows_ = train.select(
        F.col("label").cast("double"),
        weight.alias("weight"),
        *STATISTICS,
        array_to_vector(F.array(*STATISTICS)).alias("features"),
    )
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight", featureSubsetStrategy="0.6",
        minInstancesPerNode=5,
    ).fit(rows_)
    rules = sorted(paths(forest.toDebugString, STATISTICS))
    applied = rows_.select(
        "label", array_to_vector(F.array(*(holds(r).cast("double") for r in rules))).alias("features")
    )
    logistic = LogisticRegression(
        elasticNetParam=1.0, regParam=PENALTY, maxIter=60, standardization=False
    ).fit(applied)
    weights = logistic.coefficients.toArray().tolist()
    return Rules(logistic.intercept, tuple((w, r) for w, r in zip(weights, rules) if abs(w) > 1e-6))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's quality score."""
    docs = table(spark, sf_dir, "documents")
    rules = fit(docs, table(spark, sf_dir, "labels"))
    stats = measured(docs.select("doc_id", whole_text().alias("text")), "doc_id")
    score = F.col("score")
    return stats.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), rules.column().alias("score")).select(
        "doc_id", "held_out", "score", F.when(score >= 0.3, 1).otherwise(0).alias("predicted")
    )
