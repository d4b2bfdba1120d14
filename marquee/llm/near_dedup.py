"""Near-duplicate documents by circulant MinHash.

A document's set are its distinct runs of words. A first permutation scatters the set over the places of a table,
a second one gives each place a value, and circular shifts of the second one give all coordinates of the
signature: coordinate k is the least value at the set's places moved on by k. Bands of the
signature that two sets share make them candidates; the full sets then decide.

Equal sets are one class with one representative, so copies are never compared. In each bucket the member
that meets most others is the hub, and every member is compared with it. Members that are not connected with the
hub afterwards are compared with all members of the bucket, in blocks of bounded size. So every candidate
pair is either compared or known to be connected, while the pairs themselves are never listed.

Defined results: NULL and empty texts, and texts without words, have an empty set and are linked with nothing.
Rows that share an identifier count as one document for links, and each gives a row. A NULL identifier links
with nothing. Only identifier and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import WORD, Work, portions, table, whole_text
from marquee.llm.components import components
from marquee.llm.words import BASE, mix, shingles, stream, word_numbers

PLACES = 1 << 20
# Chance that bands miss a pair whose similarity is just the threshold.
MISSED = 1e-7
BLOCK = 256
ROWS_AT_ONCE = 4096
# Bytes of text whose sets a worker holds at a time, a single longer text aside.
BATCH_BYTES = 4 << 20


def bands_for(percent: int) -> tuple[int, int]:
    """Rows per band, the more the stricter the threshold, and bands, so that few pairs are missed."""
    rows = 5 if percent >= 85 else 4
    return rows, math.ceil(math.log(MISSED) / math.log(1 - (percent / 100) ** rows))


@lru_cache(maxsize=2)
def shifts(width: int) -> np.ndarray:
    """The second permutation, seen from each place: its values at ``width`` places in turn."""
    values = np.argsort(stream(0xC1, PLACES)).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([values, values[:width]]), width)


def signature(numbers: np.ndarray, width: int) -> np.ndarray:
    """All coordinates of a set. The first permutation is the mixing of the numbers, cut to a place."""
    seen = shifts(width)
    places = (mix(numbers ^ np.uint64(0xA5A5)) & np.uint64(PLACES - 1)).astype(np.int64)
    least = np.full(width, PLACES, np.uint32)
    for at in range(0, len(places), ROWS_AT_ONCE):
        np.minimum(least, seen[places[at : at + ROWS_AT_ONCE]].min(0), out=least)
    return least


def band_numbers(least: np.ndarray, rows: int) -> np.ndarray:
    """One number per band, which tells the bands apart as well."""
    by_band = least.reshape(-1, rows).astype(np.uint64)
    total = np.arange(1, len(by_band) + 1, dtype=np.uint64)
    for i in range(rows):
        total = mix(total * np.uint64(BASE) + by_band[:, i])
    return total.view(np.int64)


def signatures(docs: DataFrame, size: int, rows: int, bands: int) -> DataFrame:
    """``doc_id``, ``n`` (set size), ``key_a`` and ``key_b`` (a digest of the set), ``bands``."""

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in arrow for part in portions(whole, 1, BATCH_BYTES)):
            n, a, b, banded = [], [], [], []
            for text in batch.column(1):
                own = shingles(word_numbers(text.as_py(), True)[0], size)
                n.append(len(own))
                a.append(int(mix(own).sum(dtype=np.uint64).view(np.int64)) if len(own) else 0)
                b.append(int(mix(~own).sum(dtype=np.uint64).view(np.int64)) if len(own) else 0)
                banded.append(band_numbers(signature(own, rows * bands), rows) if len(own) else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(a, pa.int64()),
                    pa.array(b, pa.int64()),
                    pa.array(banded, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "key_a", "key_b", "bands"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        batches, "doc_id long, n long, key_a long, key_b long, bands array<long>"
    )


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """``rep`` and ``own``, the set of the document."""

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in arrow for part in portions(whole, 1, BATCH_BYTES)):
            own = [shingles(word_numbers(t.as_py(), True)[0], size).view(np.int64) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.list_(pa.int64()))], names=["rep", "own"]
            )

    return docs.select("rep", "text").mapInArrow(batches, "rep long, own array<long>")


def alike(common, n_a, n_b, percent: int):
    return 100 * common >= percent * (n_a + n_b - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("own").alias("own_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("own").alias("own_b"))
    common = F.size(F.array_intersect("own_a", "own_b"))
    return pairs.join(left, "a").join(right, "b").where(
        alike(common, F.size("own_a"), F.size("own_b"), percent)
    ).select("a", "b")


def rest_of_buckets(members: DataFrame, hubs: DataFrame, labels: DataFrame, sets: DataFrame, work: Work, percent: int):
    """Candidates ``a``, ``b`` between members that the hub does not connect, one at least for each
    two components that have a link within a bucket.

    Blocks hold the lower 31 bits of the numbers of the sets, which can only make sets look more alike."""
    label = labels.select(F.col("node").alias("rep"), "component")
    named = work.stored(
        members.join(label, "rep", "left").select(
            "value", "rep", "n", F.coalesce("component", "rep").alias("component")
        ),
        "named",
    )
    hub = hubs.join(label.withColumnRenamed("rep", "hub"), "hub", "left").select(
        "value", "size", F.coalesce("component", "hub").alias("main")
    )
    open_ = work.stored(
        named.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high").join(hub.where("size > 2"), "value")
        .select("value", "main", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")),
        "open",
    )
    short = sets.select("rep", F.transform("own", lambda x: x.bitwiseAND(0x7FFFFFFF).cast("int")).alias("own"))
    rows = named.join(open_, "value").join(short, "rep")
    block = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    given = ("value", "rep", "n", "component", "own")
    asking = rows.where(F.col("component") != F.col("main")).select(
        *given, F.lit(True).alias("asks"), block.alias("i"), others.alias("j")
    )
    asked = rows.select(*given, F.lit(False).alias("asks"), others.alias("i"), block.alias("j"))

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        asks = block[block["asks"]]
        rest = block[~block["asks"]]
        found: list[tuple[int, int]] = []
        if len(asks) and len(rest):
            codes, inverse = np.unique(np.concatenate([*rest["own"], *asks["own"]]), return_inverse=True)
            sizes = np.array([len(x) for x in rest["own"]])
            first = np.cumsum(sizes) - sizes
            inside, own = inverse[: sizes.sum()], inverse[sizes.sum() :]
            ends = np.cumsum([0, *(len(x) for x in asks["own"])])
            components_, reps = rest["component"].to_numpy(), rest["rep"].to_numpy()
            for k, (rep, n, component) in enumerate(zip(asks["rep"], asks["n"], asks["component"])):
                mask = np.zeros(len(codes), np.int32)
                mask[own[ends[k] : ends[k + 1]]] = 1
                common = np.add.reduceat(mask[inside], first)
                near = alike(common, n, rest["n"].to_numpy(), percent) & (components_ != component)
                # One partner of each component is enough.
                _, one = np.unique(components_[near], return_index=True)
                found.extend((int(rep), int(other)) for other in reps[near][one])
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return (
        asking.unionByName(asked).groupBy("value", "i", "j").applyInPandas(compare, "a long, b long").distinct()
    )


def near_duplicates(
    docs: DataFrame, work: Work, size: int = 5, percent: int = 80
) -> DataFrame:
    """Per row ``doc_id``, ``n_shingles``, ``component_id``, the least identifier that links of
    ``percent`` similarity and more reach, and ``kept``. Links that the similarity of a partner in the same
    component makes needless are not looked for."""
    rows, bands = bands_for(percent)
    found = work.stored(signatures(docs, size, rows, bands), "signatures")
    key = ["n", "key_a", "key_b"]
    classes = work.stored(
        found.where("n > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
        .where("rep IS NOT NULL"),
        "classes",
    )
    banded = classes.select("rep", "n", F.explode("bands").alias("value"))
    shared = work.stored(
        banded.groupBy("value").agg(F.count("*").alias("size")).where("size > 1"), "shared"
    )
    members = work.stored(banded.join(shared, "value"), "members")
    reach = members.groupBy("rep").agg(F.sum("size").alias("reach"))
    reached = work.stored(reach, "reach")
    hubs = work.stored(
        members.join(reached, "rep").groupBy("value")
        .agg(F.max(F.struct("reach", (-F.col("rep")).alias("hub"), "n", "size")).alias("best"))
        .select("value", (-F.col("best.hub")).alias("hub"), F.col("best.n").alias("hub_n"), F.col("best.size").alias("size")),
        "hubs",
    )
    near = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    pairs = work.stored(
        members.drop("size").join(hubs, "value").where((F.col("rep") != F.col("hub")) & near)
        .select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct(),
        "pairs",
    )
    texts = docs.select(F.col("doc_id").cast("bigint").alias("rep"), whole_text().alias("text"))
    sets = work.stored(full_sets(texts.join(reached.select("rep"), "rep", "left_semi"), size), "sets")
    links = work.stored(confirmed(pairs, sets, percent), "links")
    labels = components(links, work, "first")
    more = work.stored(rest_of_buckets(members, hubs, labels, sets, work, percent), "more-pairs")
    if not more.isEmpty():
        labels = components(
            labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(
                confirmed(more, sets, percent)
            ),
            work,
            "second",
        )
    placed = work.stored(
        classes.drop("bands").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select(*key, F.coalesce("component", "rep").alias("component")),
        "placed",
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        found.drop("bands").join(placed, key, "left")
        .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of the documents: runs of 3 words, similarity 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"), Work(spark, "near"), size=3, percent=85)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least identifier of each near-duplicate group: runs of 5 words,
    similarity 0.8."""
    work = Work(spark, "near-stage")
    dropped = near_duplicates(docs, work).where("not kept").select(F.col("doc_id").alias("__dropped"))
    return docs.join(dropped, docs["doc_id"] == F.col("__dropped"), "left_anti")


OP5_SQL = f"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS id, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '{WORD}') AS words
  FROM documents),
starts AS (SELECT id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM texts WHERE len(words) > 0),
shingles AS (SELECT DISTINCT id, array_to_string(words[i:i + 2], ' ') AS s FROM starts),
sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY id),
common AS (SELECT x.id AS a, y.id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.id <> y.id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sizes p ON p.id = a JOIN sizes q ON q.id = b
  WHERE 100 * common.n >= 85 * (p.n + q.n - common.n)),
reach AS (SELECT id, id AS other FROM texts UNION SELECT reach.id, b FROM reach JOIN links ON other = a),
least AS (SELECT reach.id, min(t.doc_id) AS component_id FROM reach JOIN texts t ON t.id = other GROUP BY reach.id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM texts JOIN least USING (id) LEFT JOIN sizes USING (id)
"""
