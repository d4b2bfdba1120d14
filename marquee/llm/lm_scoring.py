"""Language-model scores with stupid backoff, as joins of n-gram count tables.

The model counts all runs of 1 to ``ORDER`` words of the corpus. Each word of a document is scored against all other
occurrences: its longest run that occurs elsewhere has the score (count - 1) / (count of the run without its last word - 1),
each step to a shorter run costs a factor of 0.4, and a single word that occurs nowhere else counts as if it did once.
Logarithms are summed per document. A text begins with as many start marks as a run looks back.

Documents are counted in blocks of neighbouring rows. A block's distinct runs travel packed: one row holds the sorted
numbers and counts of one block in one range of hashes. The counts of a range are summed and joined back to the rows
that asked, and each block meets its answers to score its documents. A run is there once per block, however often it
occurs, so no range is hot. Ranges are counted in ``SLICES`` turns, whose shuffles are released one after the other.
The number of ranges follows the size of the corpus, so that a range fits into a task.

Defined results: NULL texts and texts without words have 0 words and the score NULL. Repeated rows each give a row.
Only identifier and text are read. An empty table gives an empty result. Rows are read more than once; a block whose runs
differ from what was counted is an error.
"""

from __future__ import annotations

import gc
import math
import time
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import WORD, Work, table, whole_text
from marquee.llm.words import BASE, mix, word_numbers

ORDER = 3
BACKOFF = 0.4
SLICES = 3
# Rows and code points of a block at most; a longer text is a block of its own. Blocks are of one of SIZES kinds.
BLOCK_ROWS = 1024
BLOCK_CHARS = 1 << 24
SIZES = 16
# Code points whose words are numbered at a time.
CHUNK_CHARS = 1 << 18
# Code points of the corpus for each range of hashes.
RANGE_CHARS = 1 << 21
# What every block asks for to learn the number of words in the corpus.
ALL_WORDS = np.uint64(0xA11)

ASKED = "range long, block long, runs binary, counts binary, ends binary, mark long"
ANSWERED = "block long, range long, counts binary, ends binary, mark long"


def word_runs(texts: list[str], order: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words of each text, and for each word of all texts the number of the run of 1, 2, ... ``order`` words
    that ends there."""
    words, sizes, chunk, held = [], [], [], 0
    for i, text in enumerate(texts, 1):
        chunk.append(text)
        held += len(text)
        if held > CHUNK_CHARS or i == len(texts):
            numbers, first, _, _ = word_numbers("\n".join(chunk), False)
            ends = np.cumsum([len(t.encode("utf-8", "surrogatepass")) + 1 for t in chunk])
            words.append(numbers)
            sizes.append(np.diff(np.searchsorted(first, ends), prepend=0))
            chunk, held = [], 0
    number = np.concatenate([np.zeros(0, np.uint64), *words])
    size = np.concatenate([np.zeros(0, np.int64), *sizes]).astype(np.int64)
    begin = np.repeat(np.cumsum(size) - size, size)
    place = np.arange(len(number)) - begin
    out, total = [], np.zeros(len(number), np.uint64)
    for k in range(order):
        back = number if not k else np.concatenate([np.ones(min(k, len(number)), np.uint64), number[:-k]])
        total = mix(total * np.uint64(BASE) + np.where(place < k, np.uint64(1), back))
        out.append(total)
    return size, out


def start_runs(order: int) -> np.ndarray:
    """The numbers of the runs of 1 to ``order`` - 1 start marks."""
    out, total = [], np.zeros(1, np.uint64)
    for _ in range(order - 1):
        total = mix(total * np.uint64(BASE) + np.uint64(1))
        out.append(total)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def first_of(ranges: int, at: int) -> int:
    """The least number that falls into range ``at`` of ``ranges`` equal ones."""
    return -(-(at << 64) // ranges)


def asked_runs(texts: list[str], order: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text and their runs as of :func:`word_runs`; the runs that no word of the text continues, as each
    last word has them; the further numbers that a block asks for, and their counts."""
    size, own = word_runs(texts, order)
    last = (np.cumsum(size) - 1)[size > 0]
    ends = np.concatenate([np.zeros(0, np.uint64), *(o[last] for o in own[:-1])])
    # Start marks are continued once in each text with words.
    extra = np.append(start_runs(order), ALL_WORDS)
    weights = np.array([len(last)] * (len(extra) - 1) + [size.sum()], np.int64)
    return size, own, ends, extra, weights


def count_runs(texts: list[str], order: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct runs of a block from ``low`` to below ``high``, sorted, how often each occurs, and how often
    as the last of a text."""
    _, own, last, extra, weights = asked_runs(texts, order)

    def inside(x: np.ndarray) -> np.ndarray:
        return x[(x >= np.uint64(low)) & (x <= np.uint64(high - 1))]

    found, counts = np.unique(np.concatenate([*map(inside, own), inside(extra)]), return_counts=True)
    for number, weight in zip(extra, weights):
        if low <= number < high:
            counts[np.searchsorted(found, number)] += weight - 1
    ends = np.zeros(len(found), np.int64)
    np.add.at(ends, np.searchsorted(found, inside(last)), 1)
    return found, counts, ends


def in_blocks(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``block``: ``BLOCK_ROWS`` rows of one reading task, or for each doubling of a text's length
    half as many, so that no block of several texts has more than ``BLOCK_CHARS`` code points."""
    text = whole_text()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.monotonically_increasing_id().alias("at"))
    most = BLOCK_ROWS.bit_length() - 1
    longer = F.ceil(F.log2(F.greatest(F.length("text"), F.lit(1)) / (BLOCK_CHARS / BLOCK_ROWS)))
    size = F.least(F.greatest(longer, F.lit(0)), F.lit(most)).cast("int")
    block = F.call_function("shiftright", F.col("at"), most - F.col("size"))
    return rows.withColumn("size", size).select("doc_id", "text", (block * SIZES + F.col("size")).cast("bigint").alias("block"))


def asked(rows: DataFrame, order: int, ranges: int, slice_: int) -> DataFrame:
    """What each block counts in the ranges of a slice, a row for each range."""
    first, end = slice_ * ranges // SLICES, (slice_ + 1) * ranges // SLICES
    edges = np.array([first_of(ranges, at) for at in range(first + 1, end)], np.uint64)

    def rows_of(block: int, texts: list[str]) -> pa.RecordBatch:
        found, counts, ends = count_runs(texts, order, first_of(ranges, first), first_of(ranges, end))
        cuts = [0, *np.searchsorted(found, edges).tolist(), len(found)]
        parts = [(at, slice(a, b)) for at, a, b in zip(range(first, end), cuts, cuts[1:]) if a < b]
        packed = [found[p].tobytes() for _, p in parts]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([at for at, _ in parts], pa.int64()),
                pa.array([block] * len(parts), pa.int64()),
                pa.array(packed, pa.binary()),
                pa.array([packed_counts(counts[p]) for _, p in parts], pa.binary()),
                pa.array([packed_counts(ends[p]) for _, p in parts], pa.binary()),
                pa.array([zlib.crc32(b) for b in packed], pa.int64()),
            ],
            names=["range", "block", "runs", "counts", "ends", "mark"],
        )

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The open block of each size of text.
        held: dict[int, tuple[int, list[str]]] = {}
        for batch in arrow:
            for block, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                size = block % SIZES
                if size in held and held[size][0] != block:
                    yield rows_of(*held.pop(size))
                held.setdefault(size, (block, []))[1].append(text.as_py())
        for block, texts in held.values():
            yield rows_of(block, texts)

    return rows.select("block", "text").mapInArrow(batches, ASKED)


def answer(group: pa.Table) -> pa.Table:
    """The corpus counts of a range, given back to each block in its own order."""
    blobs = group["runs"].to_pylist()
    found, place = np.unique(np.frombuffer(b"".join(blobs), np.uint64), return_inverse=True)
    own = np.split(place, np.cumsum([len(b) // 8 for b in blobs])[:-1])

    def summed(column: str) -> pa.Array:
        whole = np.bincount(place, unpacked_counts(group[column]), len(found)).astype(np.int64)
        return pa.array([packed_counts(whole[o]) for o in own], pa.binary())

    return pa.table(
        {
            "block": group["block"],
            "range": group["range"],
            "counts": summed("counts"),
            "ends": summed("ends"),
            "mark": group["mark"],
        }
    )


def packed_counts(counts: np.ndarray) -> bytes:
    """The lowest bytes of all counts, then the next ones. Most counts are small, so most bytes are long stretches of zeros,
    which Spark's compression takes out."""
    return np.ascontiguousarray(counts, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked_counts(column: pa.ChunkedArray) -> np.ndarray:
    """The counts of all rows one after the other."""
    each = [np.frombuffer(b, np.uint8).reshape(8, -1).T for b in column.to_pylist()]
    return np.concatenate([np.zeros((0, 8), np.uint8), *each]).view(np.int64).ravel()


def block_scores(texts: list[str], answers: pa.Table, order: int, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and sum of logarithms of each text of a block, given the answers to what it asked."""
    size, own, _, extra, _ = asked_runs(texts, order)
    asked_for = np.concatenate([*own, extra])
    by = np.argsort(asked_for)
    ordered = asked_for[by]
    new = np.append(True, ordered[1:] != ordered[:-1])
    found, place = ordered[new], np.empty(len(by), np.int64)
    place[by] = np.cumsum(new) - 1
    answers = answers.sort_by("range")
    at = answers["range"].to_pylist()
    cuts = np.searchsorted(found, np.array([first_of(ranges, r) for r in at], np.uint64)).tolist() + [len(found)]
    marks = [zlib.crc32(found[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]
    if cuts[0] or marks != answers["mark"].to_pylist():
        raise ValueError("the documents were read in another order than before; store them first")
    counts = unpacked_counts(answers["counts"])
    # How often a word continues a run.
    begun = counts - unpacked_counts(answers["ends"])
    n = len(own[0])
    start, words = place[order * n : -1], int(counts[place[-1]])
    first = (np.cumsum(size) - size)[size > 0]
    log = np.log(np.maximum(counts[place[:n]] - 1, 1) / max(words - 1, 1)) + (order - 1) * math.log(BACKOFF)
    for k in range(1, order):
        # A run without its last word is the run of one word less that ends a word before.
        run, context = counts[place[k * n : (k + 1) * n]], np.roll(place[(k - 1) * n : k * n], 1)
        context[first] = start[k - 1]
        seen = run > 1
        log[seen] = np.log((run[seen] - 1) / (begun[context[seen]] - 1)) + (order - 1 - k) * math.log(BACKOFF)
    sums = np.full(len(size), np.nan)
    if n:
        sums[size > 0] = np.add.reduceat(log, first)
    return size, sums


def scores(docs: DataFrame, work: Work, order: int = ORDER, scanned: bool = False) -> DataFrame:
    """Per row ``doc_id``, ``n_words``, ``log_score`` (sum) and ``score`` (per word). Rows are written first, unless
    they are ``scanned`` from files as they are and so come in the same order each time."""
    if not scanned:
        docs = work.stored(docs.select("doc_id", "text"), "documents")
    rows = in_blocks(docs)
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    ranges = max(SLICES, chars // RANGE_CHARS)
    parts = []
    for s in range(SLICES):
        counted = asked(rows, order, ranges, s).groupBy("range").applyInArrow(answer, ANSWERED)
        parts.append(work.stored(counted, f"counts-{s}"))
        del counted
        release(work.spark)
    answers = parts[0]
    for part in parts[1:]:
        answers = answers.unionByName(part)

    def scored(block: pa.Table, given: pa.Table) -> pa.Table:
        n, logs = block_scores(block["text"].to_pylist(), given, order, ranges)
        return pa.table(
            {"doc_id": block["doc_id"], "n_words": pa.array(n, pa.int64()), "log_score": pa.array(logs, pa.float64(), from_pandas=True)}
        )

    return (
        rows.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(scored, "doc_id long, n_words long, log_score double")
        .withColumn("score", _per_word())
    )


def _per_word() -> Column:
    return F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of jobs that nothing refers to any more. It does so when the
    driver collects garbage, which it may have no other reason to. What Python has let go of reaches the
    JVM a little later, so it takes two turns."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.5)


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's score under the model of all documents, rounded since the last digits depend on
    the order of summation."""
    scored = scores(table(spark, sf_dir, "documents"), Work(spark, "lm"), scanned=True)
    return scored.withColumns({c: F.round(c, 6) for c in ("log_score", "score")})


OP2_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS id, doc_id,
  regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
placed AS (SELECT id, unnest(words) AS c, unnest(list_concat([''], words[:len(words) - 1])) AS b,
  unnest(list_concat(['', ''], words[:greatest(len(words) - 2, 0)])[:len(words)]) AS a FROM texts WHERE len(words) > 0),
counted AS (SELECT id, count(*) OVER (PARTITION BY a, b, c) AS n3, count(*) OVER (PARTITION BY a, b) AS whole3,
  count(*) OVER (PARTITION BY b, c) AS n2, count(*) OVER (PARTITION BY b) AS whole2,
  count(*) OVER (PARTITION BY c) AS n1, count(*) OVER () AS whole1 FROM placed),
logs AS (SELECT id, CASE WHEN n3 > 1 THEN ln((n3 - 1) / (whole3 - 1))
  WHEN n2 > 1 THEN ln({BACKOFF} * (n2 - 1) / (whole2 - 1))
  ELSE ln({BACKOFF} * {BACKOFF} * greatest(n1 - 1, 1) / greatest(whole1 - 1, 1)) END AS log FROM counted),
summed AS (SELECT id, count(*) AS n, sum(log) AS log FROM logs GROUP BY id)
SELECT doc_id, coalesce(n, 0) AS n_words, round(log, 6) AS log_score, round(log / n, 6) AS score
FROM texts LEFT JOIN summed USING (id)
"""
