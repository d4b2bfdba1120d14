"""Removal of long passages that occur more than once.

A window is ``LENGTH`` consecutive words of one document. Each word goes that lies in a window whose words also
start anywhere else. Each window belongs to one anchor, the run of ``ANCHOR`` words in it with the least
number, so equal windows have equal anchors at equal places. Neighbouring windows with one anchor form a
segment. Only anchors that occur twice are followed up. A segment that occurs twice as a whole is settled by that; the
windows of the others are counted one by one, against each other and against one copy of each settled segment.
All counting is by key with partial sums before the shuffle, so a passage that very many documents share is no
hot spot, and work grows with the text. (Automata of the whole reference, as broadcasts, would grow with the
corpus, and all documents would have to pass all of them; see the README.)

A segment or window is told by the 64-bit number of its anchor and another one of all its words; a document's row
by a 64-bit number of identifier and text.

Defined results: NULL texts and texts without words have no words and keep none (the digest is that
of the empty text). Rows with equal identifiers and texts are different places, so their windows occur twice.
Only identifier and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.common import WORD, Work, table, whole_text
from marquee.llm.words import BASE, mix, powers, word_numbers

LENGTH = 35
ANCHOR = 6
RATIO = 0xD1342543DE82EF95
BACK = pow(RATIO, -1, 1 << 64)

# What a document is asked for: a segment that occurs elsewhere, one that also lends its windows
# to the comparison, and one whose windows are to be compared.
WHOLE, LENT, OPEN = 0, 1, 2
_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _ratios(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of RATIO and of its inverse, kept for texts of usual length."""
    size = 1 << max(n, 1 << 15).bit_length()
    if size not in _cache:
        _cache.clear()
        _cache[size] = powers(RATIO, size), powers(BACK, size)
    return _cache[size]


class Text:
    """Numbers of runs of words of one text."""

    def __init__(self, text: str, length: int = LENGTH):
        self.length = length
        self.numbers = word_numbers(text, False)[0]
        n = len(self.numbers)
        up, self.down = _ratios(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(self.numbers ^ np.uint64(0x77)) * up[:n], out=self.sums[1:])

    def runs(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A number for the words from ``first`` up to ``end``."""
        return mix((self.sums[end] - self.sums[first]) * self.down[first] + (end - first).astype(np.uint64))

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor and number of each segment, its first window and how many windows it has."""
        n, anchor = len(self.numbers), min(ANCHOR, self.length)
        if n < self.length:
            none = np.zeros(0, np.int64)
            return none, none, none, none
        grams = np.zeros(n - anchor + 1, np.uint64)
        for i in range(anchor):
            grams = mix(grams * np.uint64(BASE) + self.numbers[i : i + len(grams)])
        windows = np.lib.stride_tricks.sliding_window_view(grams, self.length - anchor + 1)
        at = windows.argmin(1) + np.arange(len(windows))
        first = np.flatnonzero(np.diff(at, prepend=-1))
        count = np.diff(first, append=len(at))
        own = self.runs(first, first + count - 1 + self.length)
        return grams[at[first]].view(np.int64), own.view(np.int64), first, count


def _keyed(docs: DataFrame) -> DataFrame:
    text = whole_text()
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("row"), text.alias("text"))


def anchor_counts(keyed: DataFrame, length: int) -> DataFrame:
    """``anchor`` and in how many segments it is. Counts are first taken in each batch."""

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            each = [Text(t.as_py(), length).segments()[0] for t in batch.column(0)]
            anchors, n = np.unique(np.concatenate(each), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(anchors), pa.array(n)], names=["anchor", "n"])

    return keyed.select("text").mapInArrow(batches, "anchor long, n long").groupBy("anchor").agg(
        F.sum("n").alias("n")
    )


def all_segments(keyed: DataFrame, length: int) -> DataFrame:
    """``row``, ``anchor``, ``own``, and ``at``: 64 times the first window plus the number of windows."""

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            each = [Text(t.as_py(), length).segments() for t in batch.column(1)]
            rows = np.repeat(batch.column(0).to_numpy(), [len(e[0]) for e in each])
            anchor, own, first, count = (np.concatenate([e[i] for e in each]) for i in range(4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (rows, anchor, own, first * 64 + count)],
                names=["row", "anchor", "own", "at"],
            )

    return keyed.select("row", "text").mapInArrow(batches, "row long, anchor long, own long, at long")


RESULT = "doc_id long, row long, n_words long, n_removed long, kept_sha256 string"
WINDOWS = "array<struct<anchor: long, own: long, at: int, weight: int>>"


def _kept(text: str, covered: np.ndarray) -> tuple[int, int, str]:
    words = text.encode("utf-8", "surrogatepass").split()
    kept = b" ".join(compress(words, (~covered).tolist()))
    return len(words), int(covered.sum()), hashlib.sha256(kept).hexdigest()


def _cover(n: int, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, end, -1)
    return np.cumsum(edges[:-1]) > 0


def first_look(asked: DataFrame, length: int) -> DataFrame:
    """Results of texts that need no comparison of windows; of the others the text,
    the windows that are settled (``whole``, as ``at``) and those to compare."""

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            out = []
            for doc_id, row, text, asks in zip(*(c.to_pylist() for c in batch.columns)):
                asks = asks or []
                whole = [a["at"] for a in asks if a["kind"] != OPEN]
                listed = [a for a in asks if a["kind"] != WHOLE]
                if not listed:
                    n = len(text.encode("utf-8", "surrogatepass").split())
                    at = np.array(whole, np.int64)
                    covered = _cover(n, at // 64, at // 64 + at % 64 - 1 + length)
                    out.append((doc_id, row, *_kept(text, covered), None, None, None))
                    continue
                runs, windows = Text(text, length), []
                for ask in listed:
                    first = ask["at"] // 64 + np.arange(ask["at"] % 64)
                    own = runs.runs(first, first + length).view(np.int64)
                    weight = 2 if ask["kind"] == LENT else 1
                    windows.extend(
                        {"anchor": ask["anchor"], "own": o, "at": f, "weight": weight}
                        for o, f in zip(own.tolist(), first.tolist())
                    )
                out.append((doc_id, row, None, None, None, text, whole, windows))
            kinds = [
                pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()),
                pa.list_(pa.struct([("anchor", pa.int64()), ("own", pa.int64()), ("at", pa.int32()), ("weight", pa.int32())])),
            ]
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["doc_id", "row", "n_words", "n_removed", "kept_sha256", "text", "whole", "windows"],
            )

    return asked.select("doc_id", "row", "text", "asks").mapInArrow(
        batches, f"{RESULT}, text string, whole array<long>, windows {WINDOWS}"
    )


def last_look(rows: DataFrame, length: int) -> DataFrame:
    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in arrow:
            out = []
            for doc_id, row, text, whole, found in zip(*(c.to_pylist() for c in batch.columns)):
                n = len(text.encode("utf-8", "surrogatepass").split())
                at = np.array([*whole, *(64 * f + 1 for f in found or [])], np.int64)
                covered = _cover(n, at // 64, at // 64 + at % 64 - 1 + length)
                out.append((doc_id, row, *_kept(text, covered)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["doc_id", "row", "n_words", "n_removed", "kept_sha256"],
            )

    return rows.select("doc_id", "row", "text", "whole", "found").mapInArrow(batches, RESULT)


def remove_repeats(docs: DataFrame, work: Work, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256``."""
    keyed = _keyed(docs)
    repeated = work.stored(anchor_counts(keyed, length).where("n > 1").select("anchor"), "anchors")
    places = work.stored(all_segments(keyed, length).join(repeated, "anchor"), "places")
    segments = work.stored(
        places.groupBy("anchor", "own").agg(F.count("*").alias("n"), F.min(F.struct("row", "at")).alias("lent")),
        "segments",
    )
    mixed = work.stored(
        segments.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor", F.lit(True).alias("mixed")),
        "mixed",
    )
    known = work.stored(segments.join(mixed, "anchor", "left"), "known")
    kind = (
        F.when(F.col("n") == 1, OPEN)
        .when(F.coalesce("mixed", F.lit(False)) & (F.struct("row", "at") == F.col("lent")), LENT)
        .otherwise(WHOLE)
    )
    asks = work.stored(
        places.join(known, ["anchor", "own"]).select("row", F.struct("anchor", "at", kind.alias("kind")).alias("ask")),
        "asks",
    )
    # Rows that repeat identifier and text share one list: each of them puts in the same asks.
    by_row = asks.groupBy("row").agg(F.collect_set("ask").alias("asks"))
    looked = work.stored(first_look(keyed.join(by_row, "row", "left"), length), "looked")
    windows = looked.where("windows IS NOT NULL").select("row", F.explode("windows").alias("w")).select("row", "w.*")
    twice = work.stored(
        windows.groupBy("anchor", "own").agg(F.sum("weight").alias("n")).where("n > 1").select("anchor", "own"),
        "twice",
    )
    found = work.stored(windows.join(twice, ["anchor", "own"]).select("row", "at"), "found")
    found = found.groupBy("row").agg(F.collect_set("at").alias("found"))
    rest = last_look(looked.where("windows IS NOT NULL").join(found, "row", "left"), length)
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    return looked.where("windows IS NULL").select(*columns).unionByName(rest.select(*columns))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with the words that repeated passages take from it."""
    return remove_repeats(table(spark, sf_dir, "documents"), Work(spark, "passages"))


OP6_SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS id, doc_id,
  regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
starts AS (SELECT id, words, unnest(range(1, len(words) - {LENGTH} + 2)) AS i FROM texts WHERE len(words) >= {LENGTH}),
windows AS (SELECT id, i, md5(array_to_string(words[i:i + {LENGTH} - 1], ' ')) AS w FROM starts),
repeated AS (SELECT id, i FROM windows QUALIFY count(*) OVER (PARTITION BY w) > 1),
covered AS (SELECT DISTINCT id, unnest(range(i, i + {LENGTH})) AS i FROM repeated),
single AS (SELECT id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM texts),
kept AS (SELECT id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
  FROM single ANTI JOIN covered USING (id, i) GROUP BY id)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (id)
"""
