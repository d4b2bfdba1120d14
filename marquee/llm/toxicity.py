"""Toxic passages as maximum-scoring segments.

Token scores are log-odds of toxic against other labelled documents with a Dirichlet prior in proportion to
the token's frequency in both. A token is a word, or where that is not known well enough the word's first five
or four characters, so that inflected forms share their stem. One linear scan over the scores of
a text (that of Ruzzo and Tompa) gives all its maximal segments. The greatest sum over n tokens of harmless text
follows an extreme-value law, fitted on harmless documents that did not make the scores; it turns the sums into
expected numbers of chance passages, E. The document's evidence is the sum of -ln E over passages with
E < 1, and a logistic curve, fitted on the same rows, turns evidence into a score.

Training takes at most ``TRAIN_ROWS`` labelled rows and keeps at most ``MODEL_TOKENS`` tokens, so the model
that goes to the tasks has a fixed bound; all texts are scored whole.

Defined results: NULL and empty texts have no passages and get the score of no evidence. Without labelled
rows of both kinds nothing is known and each score is 0. Repeated rows each give a row. Only identifier and text
are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import portions, table, whole_text
from marquee.llm.labelled import held_out, sample

TRAIN_ROWS = 60_000
MODEL_TOKENS = 50_000
# Share of the sample that makes the token scores; the rest fits the calibration.
SCORE_SHARE = 2 / 3
# Weight of the prior in documents, and what it adds to every token.
PRIOR_DOCUMENTS = 20.0
PRIOR_EACH = 0.5
# Tokens of the model: least number of standard errors from 0 and least log-odds, which is taken off
# so that a harmless text loses on average. Score of all other tokens.
LEAST_ERRORS = 3.2
LEAST_ODDS = 2.0
OTHER_TOKEN = -0.5
LARGEST_SCORE = 8.0
STEMS = (5, 4)
# Bytes of text that are scored together, a single longer text aside.
BATCH_BYTES = 4 << 20
# Words whose scores a task remembers; beyond that it starts anew. Only speed depends on it.
KNOWN_WORDS = 100_000

WORDS = re.compile(r"[^\W_]+")


def forms(word: str) -> list[str]:
    """The word and its stems, longest first. A mark sets stems apart from words."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


@dataclass
class Model:
    scores: dict[str, float]
    rate: float  # of the extreme-value law
    scale: float
    base: float  # of the logistic curve
    slope: float

    def known(self, text: str) -> tuple[int, np.ndarray, np.ndarray, list[tuple[int, int]]]:
        """Number of tokens; places, scores and spans of the tokens that the model knows."""
        n, places, values, spans = 0, [], [], []
        get = self.memo
        for n, m in enumerate(WORDS.finditer(text), 1):
            if (value := get[m[0]]) is not None:
                places.append(n - 1)
                values.append(value)
                spans.append(m.span())
        return n, np.array(places, np.int64), np.array(values), spans

    def lookup(self, word: str) -> float | None:
        word = word.lower()
        return next((s for f in forms(word) if (s := self.scores.get(f)) is not None), None)

    @property
    def memo(self) -> Memo:
        if "_memo" not in self.__dict__:
            self.__dict__["_memo"] = Memo(self)
        return self.__dict__["_memo"]

    def forget(self) -> None:
        """Give the memory of words back. Workers outlive their tasks and run those of later steps."""
        self.__dict__.pop("_memo", None)

    def passages(self, text: str) -> tuple[int, list[tuple[float, int, int]]]:
        """Number of tokens, and sum, start and end (in code points) of each maximal segment."""
        n, places, values, spans = self.known(text)
        found = segments(places, values)
        return n, [(total, spans[a][0], spans[b][1]) for total, a, b in found]

    def evidence(self, n: int, sums: list[float]) -> float:
        """Sum of -ln E over the passages that chance would bring less than once."""
        each = (self.rate * s - math.log(self.scale * max(n, 1)) for s in sums)
        return sum(e for e in each if e > 0)

    def score(self, evidence: float) -> float:
        total = self.base + self.slope * evidence
        return 0.0 if total < -500 else 1 / (1 + math.exp(-total))


class Memo(dict):
    """Scores of words as they are met; starts anew at ``KNOWN_WORDS``."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float | None:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = self.model.lookup(word)
        return value


def segments(places: np.ndarray, values: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments of a text as (sum, first, last) with indices into ``places``, where
    every token that is not listed has the score OTHER_TOKEN.

    Candidates are kept with the sums of scores before and up to them, and a link to the last earlier candidate that
    starts at a lower sum. A new one is joined to the last candidate that starts at a lower sum, unless that one reaches
    as high. It is found along the links, which pass over candidates that no later one can need."""
    kept: list[tuple[float, float, int, int, int]] = []  # sum before, sum up to, first, last, link
    total, at = 0.0, 0
    for i, (place, value) in enumerate(zip(places.tolist(), values.tolist())):
        total += OTHER_TOKEN * (place - at)
        at = place + 1
        before, total = total, total + value
        if value <= 0:
            continue
        low, high, first, last = before, total, i, i
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][0] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][1] >= high:
                kept.append((low, high, first, last, j))
                break
            low, _, first, _, link = kept[j]
            del kept[j:]
            j = link
    return [(high - low, first, last) for low, high, first, last, _ in kept]


def count_tokens(rows: DataFrame) -> DataFrame:
    """``token``, and the documents of each label that hold it. The empty token counts the documents."""

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            counts = (Counter(), Counter())
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = set(WORDS.findall(text.as_py().lower()))
                counts[label].update({f for w in words for f in forms(w)})
                counts[label][""] += 1
            tokens = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens, pa.string())]
                + [pa.array([c[t] for t in tokens], pa.int64()) for c in counts],
                names=["token", "others", "toxic"],
            )

    partial = rows.select("label", "text").mapInArrow(batches, "token string, others long, toxic long")
    return partial.groupBy("token").agg(F.sum("others").alias("others"), F.sum("toxic").alias("toxic"))


def token_scores(counts: DataFrame) -> dict[str, float]:
    """The scores of the tokens whose log-odds are furthest above 0 by their own error."""
    whole = counts.where(F.col("token") == "").first()
    if whole is None or not whole["others"] or not whole["toxic"]:
        return {}
    n0, n1 = whole["others"], whole["toxic"]
    share = (F.col("others") + F.col("toxic")) / F.lit(float(n0 + n1))
    prior = PRIOR_DOCUMENTS * share + PRIOR_EACH

    def odds(count: str, n: int):
        return F.log((F.col(count) + prior) / (n + PRIOR_DOCUMENTS + 1 - F.col(count) - prior))

    scored = counts.where(F.col("token") != "").select(
        "token",
        (odds("toxic", n1) - odds("others", n0)).alias("score"),
        F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("others") + prior)).alias("error"),
    )
    far = F.col("score") / F.col("error")
    best = (
        scored.where((far >= LEAST_ERRORS) & (F.col("score") > LEAST_ODDS))
        .orderBy(F.desc(far), "token").limit(MODEL_TOKENS)
    )
    return {r["token"]: min(LARGEST_SCORE, r["score"]) - LEAST_ODDS for r in best.collect()}


def scan(rows: DataFrame, model: Model, *keep: str) -> DataFrame:
    """``keep`` columns, ``n`` tokens, ``sums`` and ``spans`` of the passages, ``evidence``, ``score``."""
    spec = rows.sparkSession.sparkContext.broadcast(model)
    given = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in keep)
    at = len(keep)

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = spec.value
        for batch in (part for whole in arrow for part in portions(whole, at, BATCH_BYTES)):
            n, sums, spans, evidence = [], [], [], []
            for text in batch.column(at):
                tokens, found = own.passages(text.as_py())
                n.append(tokens)
                sums.append([s for s, _, _ in found])
                spans.append([[a, b] for _, a, b in found])
                evidence.append(own.evidence(tokens, sums[-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:at],
                    pa.array(n, pa.int64()),
                    pa.array(sums, pa.list_(pa.float64())),
                    pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                    pa.array(evidence, pa.float64()),
                    pa.array([own.score(e) for e in evidence], pa.float64()),
                ],
                names=[*keep, "n", "sums", "spans", "evidence", "score"],
            )
        own.forget()

    return rows.select(*keep, "text").mapInArrow(
        batches,
        f"{given}n long, sums array<double>, spans array<array<int>>, evidence double, score double",
    )


def fit_extremes(n: np.ndarray, top: np.ndarray) -> tuple[float, float]:
    """Rate and scale of P(top >= x) = 1 - exp(-scale * n * exp(-rate * x)) by its moments: without
    n's part the law is Gumbel's, with the standard deviation pi / (rate * sqrt(6))."""
    if len(top) < 10 or top.std() < 0.05:
        return 1.0, 1.0 / max(float(n.mean()) if len(n) else 1.0, 1.0)
    rate = float(np.clip(math.pi / (top.std() * math.sqrt(6)), 0.1, 2.0))
    # Given the rate, the likelihood is largest at this scale.
    return rate, float(len(top) / (n * np.exp(-rate * top)).sum())


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Base and slope by Newton's method with a ridge, which keeps separable rows finite."""
    w = np.zeros(2)
    design = np.stack([np.ones_like(x), x], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.diag([1e-3, 1])
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge * np.array([0, w[1]]))
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """The model from the labelled rows outside of the held-out third."""
    train = sample(docs, labels, label, ~held_out("doc_id", 3, 1), rows)
    scores = token_scores(count_tokens(train.where(F.col("fold") < SCORE_SHARE)))
    model = Model(scores, 1.0, 1.0, -1e3, 0.0)
    if not scores:
        return model
    rest = scan(train.where(F.col("fold") >= SCORE_SHARE), model, "label").select(
        "label", "n", "sums"
    ).toPandas()  # at most ``rows`` short rows
    tops = np.array([max(s, default=0.0) for s in rest["sums"]])
    plain = (rest["label"] == 0).to_numpy()
    n = np.maximum(rest["n"].to_numpy(), 1).astype(float)
    model.rate, model.scale = fit_extremes(n[plain], tops[plain])
    evidence = np.array([model.evidence(a, b) for a, b in zip(n, rest["sums"])])
    if plain.any() and not plain.all():
        model.base, model.slope = fit_logistic(evidence, 1.0 - plain)
    return model


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's toxicity score, with the number of its passages."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", whole_text().alias("text"))
    return scan(rows, model, "doc_id").select(
        "doc_id",
        held_out("doc_id", 3, 1).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
        F.size("sums").cast("bigint").alias("n_passages"),
    )


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are not predicted to be toxic, with all their columns."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    given = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*(docs[c].alias(n) for c, n in given.items()), whole_text().alias("text"))
    scored = scan(renamed, model, *given.values())
    return scored.where(F.col("score") < 0.7).select(*(F.col(n).alias(c) for c, n in given.items()))
