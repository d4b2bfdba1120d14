"""Near-duplicate embeddings by an inverted file with product quantisation.

A bounded sample gives coarse centroids and, for what is left after taking the nearest centroid off, codebooks
of the subspaces. Every vector is indexed: it lies in the list of its nearest centroid and carries its codes. It
also asks the lists of its nearest ``PROBES`` centroids. Within a list a query's distances to the codes come from
tables of its distances to the codebook entries. A code carries how far it lies from its vector, which bounds
the cosine from above; what may reach the threshold is compared by exact cosine in double precision, so that
the codes lose no link.
Lists hold vectors of one label only. Long lists are compared in blocks of bounded size.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite components, and those without a label,
link with nothing and give a row of their own. Equal vectors of one label are one class: they link with each other
without being compared. Vectors of different lengths do not occur within a list: the length is part of the label's
key. Only identifier, vector and label are read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import Work, table
from marquee.llm.components import components
from marquee.llm.words import stream

SAMPLE_ROWS = 10_000
MOST_LISTS = 1024
PROBES = 16
SUBSPACES = 16
CODES = 128
BLOCK = 128
# Pairs whose exact cosines are taken at once.
PAIRS = 4096
# Above what rounding takes off the bound of a cosine.
ROUNDING = 1e-9


def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    k = min(k, len(x))
    centres = x[np.argsort(stream(3, len(x)))[:k]].copy()
    for _ in range(rounds):
        own = nearest(x, centres, 1)[:, 0]
        order = np.argsort(own, kind="stable")
        used, first = np.unique(own[order], return_index=True)
        centres[used] = np.add.reduceat(x[order], first) / np.diff([*first, len(x)])[:, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """Indices of the ``n`` nearest centres, nearest first."""
    out = []
    for at in range(0, len(x), 4096):
        far = (centres**2).sum(1) - 2 * x[at : at + 4096] @ centres.T
        n_ = min(n, len(centres))
        few = np.argpartition(far, n_ - 1, axis=1)[:, :n_]
        out.append(np.take_along_axis(few, np.argsort(np.take_along_axis(far, few, 1), axis=1), 1))
    return np.concatenate(out) if out else np.zeros((0, n), np.int64)


@dataclass
class Index:
    centres: np.ndarray
    books: list[np.ndarray]

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return np.array_split(x, len(self.books), axis=1)

    def codes(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and the distances of the vectors from what the codes stand for."""
        codes, off = [], np.zeros(len(x))
        for part, book in zip(self.parts(x - self.centres[lists]), self.books):
            codes.append(nearest(part, book, 1)[:, 0])
            off += ((part - book[codes[-1]]) ** 2).sum(1)
        return np.stack(codes, 1).astype(np.uint8), np.sqrt(off)

    def coded_cosines(self, queries: np.ndarray, codes: np.ndarray, which: int) -> np.ndarray:
        """Cosines of unit queries with the coded vectors of a list, by table lookup."""
        out = np.repeat((queries @ self.centres[which])[:, None], len(codes), 1)
        for part, book, code in zip(self.parts(queries), self.books, codes.T):
            out += (part @ book.T)[:, code]
        return out


def units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x**2).sum(1))[:, None]


def fit(classes: DataFrame, rows: int) -> dict[int, Index]:
    """An index for each length of vectors, from the first ``SAMPLE_ROWS`` in the order of the MD5
    of the identifier. The number of lists grows with the root of the number of vectors."""
    order = F.md5(F.col("rep").cast("string").cast("binary"))
    drawn = classes.orderBy(order, "rep").limit(SAMPLE_ROWS).select("vector").toPandas()["vector"]
    by_length: dict[int, list[np.ndarray]] = {}
    for v in drawn:
        by_length.setdefault(len(v), []).append(np.asarray(v, np.float64))
    out = {}
    for length, some in by_length.items():
        x = units(np.stack(some))
        centres = k_means(x, min(MOST_LISTS, math.isqrt(max(rows, 1)) + 1))
        rest = x - centres[nearest(x, centres, 1)[:, 0]]
        out[length] = Index(
            centres, [k_means(p, CODES) for p in np.array_split(rest, min(SUBSPACES, length), axis=1)]
        )
    return out


def index_rows(classes: DataFrame, index: dict[int, Index]) -> DataFrame:
    """A row in its own list (``asks`` false, with ``code`` and all that it ``probes``) and one per probed
    list for each class (with only its own list as ``probes``)."""
    spec = classes.sparkSession.sparkContext.broadcast(index)

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for length, some in frame.groupby(frame["vector"].map(len)):
                own = spec.value.get(int(length))
                if own is None:
                    # A length that the sample lacks: one list, coded as its own centre.
                    own = Index(np.zeros((1, length)), [np.zeros((1, p)) for p in [length]])
                x = units(np.stack(some["vector"]).astype(np.float64))
                probes = nearest(x, own.centres, PROBES)
                codes, off = own.codes(x, probes[:, 0])
                base = some.assign(length=length)
                yield base.assign(
                    list=probes[:, 0], asks=False, code=[c.tobytes() for c in codes], off=off, probes=list(probes)
                )
                home = list(probes[:, :1])
                for n in range(probes.shape[1]):
                    yield base.assign(list=probes[:, n], asks=True, code=b"", off=0.0, probes=home)

    return classes.select("rep", "label", "vector", "copies").mapInPandas(
        batches,
        "rep long, label int, vector array<double>, copies long, length int, list int, asks boolean, code binary, "
        "off double, probes array<int>",
    )


def linked(rows: DataFrame, index: dict[int, Index], least: float, work: Work) -> DataFrame:
    """``rep`` and the links that it has in one block, ``n``, and ``node``, the least class of
    its connected part of the block. Each pair of vectors meets in one block as query and entry.
    A link that either end finds counts for both."""
    spec = rows.sparkSession.sparkContext.broadcast(index)
    key = ["label", "length", "list"]
    sizes = rows.groupBy(*key).agg(
        F.ceil(F.count_if("asks") / BLOCK).cast("int").alias("m"),
        F.ceil(F.count_if(~F.col("asks")) / BLOCK).cast("int").alias("k"),
    )
    sized = rows.join(work.stored(sizes.where("m > 0 AND k > 0"), "lists"), key)
    block = F.xxhash64("rep")
    i, j = F.pmod(block, F.col("m")).cast("int"), F.pmod(block, F.col("k")).cast("int")
    every = F.when(F.col("asks"), F.sequence(F.lit(0), F.col("k") - 1)).otherwise(F.sequence(F.lit(0), F.col("m") - 1))
    spread = sized.withColumn("other", F.explode(every)).select(
        *key, "rep", "vector", "copies", "asks", "code", "off", "probes",
        F.when(F.col("asks"), i).otherwise(F.col("other")).alias("i"),
        F.when(F.col("asks"), F.col("other")).otherwise(j).alias("j"),
    )

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        asks, held = block[block["asks"]], block[~block["asks"]]
        none = pd.DataFrame({"rep": [], "n": [], "node": []}, dtype="int64")
        if not len(asks) or not len(held):
            return none
        a = np.stack(asks["vector"]).astype(np.float64)
        b = np.stack(held["vector"]).astype(np.float64)
        reps, others = asks["rep"].to_numpy(), held["rep"].to_numpy()
        near = reps[:, None] != others[None, :]
        own = spec.value.get(int(block["length"].iloc[0]))
        if own is not None:
            codes = np.stack([np.frombuffer(c, np.uint8) for c in held["code"]])
            coded = own.coded_cosines(units(a), codes, int(block["list"].iloc[0]))
            near &= coded + held["off"].to_numpy() >= least - ROUNDING
        p, q = np.nonzero(near)
        squares, others_squares = (a**2).sum(1), (b**2).sum(1)
        exact = np.zeros(len(p))
        for at in range(0, len(p), PAIRS):
            i, j = p[at : at + PAIRS], q[at : at + PAIRS]
            exact[at : at + PAIRS] = (a[i] * b[j]).sum(1) / np.sqrt(squares[i] * others_squares[j])
        p, q = p[exact >= least], q[exact >= least]
        if not len(p):
            return none
        n = np.bincount(p, held["copies"].to_numpy()[q], len(reps)).astype(np.int64)
        # A link counts for the entry here too, unless the entry finds it as a query in the list of the other.
        home, probed = np.stack(asks["probes"]), np.stack(held["probes"])
        one_way = np.concatenate(
            [(home[p[at : at + PAIRS]] != probed[q[at : at + PAIRS]]).all(1) for at in range(0, len(p), PAIRS)]
        )
        m = np.bincount(q[one_way], asks["copies"].to_numpy()[p[one_way]], len(others)).astype(np.int64)
        left, right = reps.copy(), others.copy()
        while True:
            low = np.minimum(left[p], right[q])
            before = left.sum() + right.sum()
            np.minimum.at(left, p, low)
            np.minimum.at(right, q, low)
            if left.sum() + right.sum() == before:
                break
        hit = np.unique(q)
        return pd.DataFrame(
            {
                "rep": np.concatenate([reps, others[hit]]),
                "n": np.concatenate([n, m[hit]]),
                "node": np.concatenate([left, right[hit]]),
            }
        )

    return spread.groupBy(*key, "i", "j").applyInPandas(compare, "rep long, n long, node long")


def near_vectors(vectors: DataFrame, work: Work, least: float = 0.93) -> DataFrame:
    """Per row ``vec_id``, ``n_links``, ``component_id`` and ``kept``."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    good = finite & F.exists(vector, lambda x: x != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.when(F.coalesce(good, F.lit(False)), F.col("label")).cast("int").alias("label"),
        vector.alias("vector"),
    )
    classes = work.stored(
        rows.where("label IS NOT NULL").groupBy("label", "vector")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")),
        "classes",
    )
    index = fit(classes, classes.count())
    found = work.stored(
        linked(work.stored(index_rows(classes, index), "rows"), index, least, work), "linked"
    )
    labels = components(
        found.where("rep <> node").select(F.col("rep").alias("a"), F.col("node").alias("b")), work
    )
    known = work.stored(
        classes.join(found.groupBy("rep").agg(F.sum("n").alias("n")), "rep", "left")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")),
        "known",
    )
    return (
        rows.join(known, ["label", "vector"], "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def op8_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of the embeddings of equal labels, by cosine of 0.93 and more."""
    return near_vectors(table(spark, sf_dir, "embeddings"), Work(spark, "vectors"))

