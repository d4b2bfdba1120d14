"""Packing: tokenised documents into sequences of a fixed length, by shortest-pack-first over the length histogram.

1. A pass over the texts encodes each document, ends it with id 0 and cuts it into pieces: as many of the full length as it
   has, and the rest. A piece is known by its length and its number among the pieces of that length in its task.
2. The histogram of the lengths (no more rows than a sequence has tokens) goes to the driver. There the lengths are placed
   longest first, each into the pack with the most room, a new one if it fits none; packs with equal contents are
   one pattern with a count, so the work depends on the number of lengths and not on that of the documents.
3. A sequence that would lack more than a 64th of its length is cut at powers of two, at which no padding is needed. So
   padding stays below a 64th whatever the lengths are; it is usually below a thousandth.
4. Patterns are joined back to the pieces by rank. The rank of a piece is its number in its task and the number of such
   pieces in the tasks before, a running sum over counts per task.

Defined results: a NULL or empty text is the id 0 alone. Rows are independent, so rows that repeat an identifier or a text
each have pieces of their own. Only identifier and text are read, so other columns cannot clash. An empty table gives
an empty table. Texts of any length are encoded whole.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import Work, table, whole_text
from marquee.llm.fast_encode import Encoder

LENGTH = 1024
END = 0
# A sequence may lack this part of its length; one that lacks more is cut.
SPARE = 64


@dataclass(frozen=True)
class Slot:
    """``count`` pieces of ``length``, from the rank ``first`` on, lie in a pattern with their tokens from
    ``start`` to ``stop``."""

    length: int
    first: int
    start: int
    stop: int

    @property
    def size(self) -> int:
        return self.stop - self.start

    def part(self, start: int, stop: int) -> Slot:
        return Slot(self.length, self.first, self.start + start, self.start + stop)


@dataclass(frozen=True)
class Pattern:
    """``count`` sequences with the same contents."""

    count: int
    slots: tuple[Slot, ...]

    @property
    def used(self) -> int:
        return sum(s.size for s in self.slots)

    def tokens(self, start: int, stop: int) -> Pattern:
        """Their tokens from ``start`` to ``stop``."""
        cut, at = [], 0
        for s in self.slots:
            low, high = max(start - at, 0), min(stop - at, s.size)
            if low < high:
                cut.append(s.part(low, high))
            at += s.size
        return Pattern(self.count, tuple(cut))


def shortest_pack_first(histogram: dict[int, int], length: int) -> list[Pattern]:
    """Patterns of a histogram of lengths up to ``length``: longest first, each into the emptiest pack."""
    packs: list[tuple[int, int, int, tuple | None]] = []  # used, order, count, contents from the last on
    order = 0
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            if packs and packs[0][0] + size <= length:
                used, _, count, contents = heapq.heappop(packs)
            else:
                used, count, contents = 0, left, None
            taken = min(left, count)
            order += 2
            heapq.heappush(packs, (used + size, order, taken, (size, contents)))
            if count > taken:
                heapq.heappush(packs, (used, order + 1, count - taken, contents))
            left -= taken
    ranks: dict[int, int] = defaultdict(int)
    patterns = []
    for _, _, count, contents in sorted(packs, key=lambda p: p[1]):
        slots = []
        while contents:
            size, contents = contents
            slots.append(Slot(size, ranks[size], 0, size))
            ranks[size] += count
        patterns.append(Pattern(count, tuple(reversed(slots))))
    return patterns


def cut_at_powers(patterns: list[Pattern], length: int, spare: int) -> list[Pattern]:
    """The same tokens, with patterns that have more than ``spare`` tokens of room cut where powers of two
    (largest first) end: such sequences need no padding."""
    done = []
    for p in patterns:
        used, at = p.used, 0
        if length - used <= spare:
            done.append(p)
            continue
        for power in reversed(range(used.bit_length())):
            if used >> power & 1:
                done.append(p.tokens(at, at + (1 << power)))
                at += 1 << power
    return done


def patterns_of(histogram: dict[int, int], length: int = LENGTH) -> list[Pattern]:
    return cut_at_powers(shortest_pack_first(histogram, length), length, length // SPARE)


SLOTS = (
    "length int, first long, stop long, cut_start int, cut_length int, sequence long, offset int"
)


def slot_rows(patterns: list[Pattern]) -> list[tuple]:
    """A row per slot: which ranks of which length lie there, which of their tokens, the sequence of the first of
    them and where in it. Sequences are numbered pattern by pattern."""
    rows, sequence = [], 0
    for p in patterns:
        at = 0
        for s in p.slots:
            rows.append((s.length, s.first, s.first + p.count, s.start, s.size, sequence, at))
            at += s.size
        sequence += p.count
    return rows


@lru_cache(maxsize=1)
def _encoder(model: str) -> Encoder:
    return Encoder(model)


PIECES = (
    "doc_id long, start long, length int, doc_tokens long, part int, place long, crc long, ids binary"
)


def cut_documents(docs: DataFrame, model: str, length: int = LENGTH) -> DataFrame:
    """The pieces of each document: where they start, their length, the CRC-32 of their ids, and the ids themselves
    (little-endian, 32 bits each) unless the piece has the full length. ``place`` numbers the pieces of one
    length in a task, ``part``."""
    spec = docs.sparkSession.sparkContext.broadcast(model)

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec.value)
        part = TaskContext.get().partitionId()
        seen = [0] * (length + 1)
        rows: list[tuple] = []
        for batch in arrow:
            keys = batch.column(0).to_pylist()
            for key, ids in zip(keys, encoder.texts(batch.column(1))):
                raw = ids.astype("<u4").tobytes() + END.to_bytes(4, "little")
                tokens = len(raw) // 4
                for start in range(0, tokens, length):
                    piece = raw[4 * start : 4 * (start + length)]
                    size = len(piece) // 4
                    kept = piece if size < length else None
                    rows.append((key, start, size, tokens, part, seen[size], zlib.crc32(piece), kept))
                    seen[size] += 1
                if len(rows) >= 4096:
                    yield _batch(rows)
                    rows = []
        if rows:
            yield _batch(rows)

    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return keyed.mapInArrow(batches, PIECES)


_TYPES = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
_NAMES = ("doc_id", "start", "length", "doc_tokens", "part", "place", "crc", "ids")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=list(_NAMES))


def pack(docs: DataFrame, model: str, work: Work, length: int = LENGTH) -> DataFrame:
    """Per piece ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset``.
    ``length`` must be a power of two."""
    if length & (length - 1):
        raise ValueError(f"length must be a power of two, not {length}")
    spark = docs.sparkSession
    # Written once: the numbers in a task hold only for one run of it.
    pieces = work.stored(cut_documents(docs, model, length), "pieces")
    counts = work.stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["length", "part"]).withColumn("rank", F.col("before") + F.col("place"))
    # There are at most two patterns per length, a pattern has no more slots than tokens: small, whatever the input.
    rows = slot_rows(patterns_of(histogram, length))
    slots = spark.createDataFrame(rows, SLOTS).withColumnRenamed("length", "slot_length")
    here = (F.col("slot_length") == F.col("length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("stop"))
    cut = F.expr("substring(ids, 4 * cut_start + 1, 4 * cut_length)")
    return ranked.join(F.broadcast(slots), here).select(
        "doc_id",
        (F.col("start") + F.col("cut_start")).alias("start"),
        F.col("cut_length").cast("bigint").alias("length"),
        F.when(F.col("cut_length") == F.col("length"), F.col("crc")).otherwise(F.crc32(cut)).alias("ids_crc32"),
        "doc_tokens",
        (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"),
        F.col("offset").cast("bigint").alias("offset"),
    )


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The library's description of an installed public vocabulary."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1,024 tokens."""
    return pack(table(spark, sf_dir, "documents"), vocabulary(), Work(spark, "packing"))
