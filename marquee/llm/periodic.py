"""Periodic runs: stretches of words that repeat with a period, by a dictionary of basic factors.

The basic factors of a text are its stretches of 1, 2, 4, ... words. Equal factors get equal names, those of twice the
length from pairs of names. Where the next occurrence of a factor is no further than twice its length, and the one after
that lies as far again, the three are an arithmetic progression and propose a period. A proposed stretch is
extended word by word on both sides; stretches found twice count once, with their smallest period.

A run of period q has at least four periods, so factors of the first power of two from q on occur in it at i, i + q and
i + 2q for some i; they cannot occur closer, since two periods of a stretch as long as both have a common divisor
as period. So no run is missed. Factors that occur once have no name and leave the later steps.

Texts are taken as a batch, with a word of its own at every end, and each text is taken whole.

Defined results: a NULL text, an empty one and one without words have no runs. Rows that repeat an identifier or a text each
give a row. Only identifier and text are read, so other columns cannot clash. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import table, whole_text

# Words of texts that are taken together, a single longer text aside.
BATCH_WORDS = 400_000
LEAST_LENGTH, LEAST_PERIODS = 6, 4


def _names(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For keys in the order of their places: a name per key, whether the key occurs again, and the number of
    keys to the next occurrence (0 for the last one)."""
    order = np.argsort(keys, kind="stable")
    listed = keys[order]
    same = listed[1:] == listed[:-1]
    name = np.zeros(len(keys), np.int64)
    name[order[1:]] = np.cumsum(~same)
    again = np.zeros(len(keys), bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    follower = np.full(len(keys), -1, np.int64)
    follower[order[:-1][same]] = order[1:][same]
    return name, again, follower


def proposals(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``period``, and the first word and the end of a stretch that has it: neighbouring factors that occur again after
    ``period`` words and once more after as many, and the next occurrence of the last."""
    found = []
    place, key, length = np.arange(len(words)), words, 1
    while len(place):
        name, again, follower = _names(key)
        step = np.where(follower >= 0, place[follower] - place, 0)
        step[step > 2 * length] = 0
        progression = (step > 0) & (step[follower] == step)
        at = np.flatnonzero(progression)
        if len(at):
            apart = (np.diff(place[at]) != 1) | (np.diff(step[at]) != 0)
            first = np.concatenate([[0], np.flatnonzero(apart) + 1])
            last = np.append(first[1:], len(at)) - 1
            period, end = step[at[first]], place[at[last]] + length + step[at[last]]
            found += zip(period.tolist(), place[at[first]].tolist(), end.tolist())
        # A factor of twice the length recurs only if both of its halves do.
        place, name = place[again], name[again]
        other = np.searchsorted(place, place + length)
        held = (other < len(place)) & (place[np.minimum(other, len(place) - 1)] == place + length) if len(place) else other
        place, key = place[held], name[held] * (len(words) + 1) + name[other[held]]
        length *= 2
    return found


def _extent(words: np.ndarray, low: int, high: int, period: int) -> tuple[int, int]:
    """The longest stretch around the words from ``low`` to ``high`` in which words ``period`` apart are equal."""
    width = 64
    while True:
        begin = max(low - width, 0)
        unequal = np.flatnonzero(words[begin:low] != words[begin + period : low + period])
        if len(unequal) or not begin:
            low = begin + int(unequal[-1]) + 1 if len(unequal) else 0
            break
        low, width = begin, 2 * width
    width = 64
    while True:
        end = min(high + width, len(words))
        unequal = np.flatnonzero(words[high:end] != words[high - period : end - period])
        if len(unequal) or end == len(words):
            return low, high + int(unequal[0]) if len(unequal) else end
        high, width = end, 2 * width


def find_runs(words: np.ndarray) -> list[tuple[int, int, int]]:
    """``start``, ``length`` and ``period`` of all runs in a sequence of numbers, by start, then period."""
    runs: dict[tuple[int, int], int] = {}
    period_before = stop = -1
    for period, first, end in sorted(proposals(words)):
        if period != period_before:
            period_before, stop = period, -1
        if end <= stop:
            continue  # within the stretch that was extended last
        low, stop = _extent(words, first, end, period)
        if stop - low >= max(LEAST_LENGTH, LEAST_PERIODS * period):
            # Sorted by period, so the smallest one comes first.
            runs.setdefault((low, stop), period)
    return sorted((low, stop - low, period) for (low, stop), period in runs.items())


def runs_of_texts(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, given as its words."""
    number: dict[bytes, int] = {}
    ids = []
    for n, words in enumerate(texts):
        ids += [number.setdefault(w, len(number)) for w in words]
        ids.append(-1 - n)
    starts = np.cumsum([0, *(len(words) + 1 for words in texts)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    runs = find_runs(np.array(ids, np.int64))
    owner = np.searchsorted(starts, [r[0] for r in runs], "right") - 1
    for (start, length, period), n in zip(runs, owner.tolist()):
        out[n].append((start - int(starts[n]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int32)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept = np.cumsum(depth[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


def words_of(text: str) -> list[bytes]:
    """The words of a text: bytes.split() separates at the same six characters."""
    return text.encode("utf-8", "surrogatepass").split()


def looped(key: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document as the contract reads them: every tenth document by its CRC-32 repeats a stretch to its
    end. Documents without an identifier are left as they are."""
    if key is None or not words:
        return words
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    cycle = words[a : a + p]
    return words[:a] + (cycle * ((n - a) // p + 1))[: n - a]


RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def _batches(arrow: Iterator[pa.RecordBatch], loop: bool) -> Iterator[tuple[list, list, list]]:
    """Keys, words and runs of as many texts as are taken together."""
    for batch in arrow:
        keys, texts, total = [], [], 0
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = words_of(text.as_py())
            keys.append(key)
            texts.append(looped(key, words) if loop else words)
            total += len(words)
            if total >= BATCH_WORDS:
                yield keys, texts, runs_of_texts(texts)
                keys, texts, total = [], [], 0
        if keys:
            yield keys, texts, runs_of_texts(texts)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per row ``doc_id``, all ``runs`` of the text, and ``collapsed``: the text without the repetitions, its
    words joined by blanks."""

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts, found in _batches(arrow, False):
            runs = [[dict(zip(("start", "length", "period"), r)) for r in each] for each in found]
            kept = [b" ".join(collapsed(w, r)).decode("utf-8", "replace") for w, r in zip(texts, found)]
            span = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(runs, pa.list_(span)), pa.array(kept, pa.string())],
                names=["doc_id", "runs", "collapsed"],
            )

    return _keyed(docs).mapInArrow(batches, RUNS)


DIGESTS = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def run_digests(docs: DataFrame) -> DataFrame:
    """Per row the number of runs, the longest one, and digests of all runs and of the collapsed text, of the
    documents as :func:`looped` reads them."""

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts, found in _batches(arrow, True):
            rows = []
            for key, words, runs in zip(keys, texts, found):
                start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
                listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
                rows.append(
                    (
                        key,
                        len(runs),
                        start,
                        length,
                        period,
                        1000 * length // period if runs else None,
                        hashlib.sha256(listed.encode()).hexdigest(),
                        hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest(),
                    )
                )
            names = [c.split()[0] for c in DIGESTS.split(", ")]
            kinds = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return _keyed(docs).mapInArrow(batches, DIGESTS)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents."""
    return run_digests(table(spark, sf_dir, "documents"))
