"""Byte-level BPE: encoding and decoding of whole texts with the tokenizers library.

Every byte stands for one printable character (the byte table), so that the library's merges work on
bytes. A text is cut into pieces by the vocabulary's pattern and each piece is encoded by itself. Merges are
derived from the rank file: every way in which two ranked tokens make up a third, in the order of the third's rank.

Defined results: a NULL or empty text has no tokens and decodes to the empty text. Ids outside
of the vocabulary raise. Rows are independent, so ties and repeated rows each give their own row; further
columns of the input are not read, so their names cannot clash. An empty table gives an empty table.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from marquee.llm.common import whole_text

# Words and pieces whose ids a task remembers, of each; beyond that it forgets half. Only speed depends on it.
KNOWN_WORDS = 400_000
# Longer pieces are not remembered.
LONG_PIECE = 64
# Longer texts are cut, at places where two pieces meet in any case, before their pieces are listed.
CHUNK_CHARS = 1 << 20
# Characters of text that are encoded together.
BATCH_CHARS = 2 << 20


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is printable, else the next
    one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a token in base64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def model_json(ranks: dict[bytes, int]) -> str:
    """The library's model of a rank file, as the text that workers load."""
    table = byte_characters()
    name = {token: "".join(table[b] for b in token) for token in ranks}
    merges = [
        (name[token[:i]], name[token[i:]])
        for token in sorted(ranks, key=ranks.get)
        for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    vocab = {name[token]: rank for token, rank in ranks.items()}
    return Tokenizer(models.BPE(vocab=vocab, merges=merges, ignore_merges=True)).to_str()


class Codec:
    """Encodes and decodes in a worker."""

    def __init__(self, model: str, pattern: str):
        library = Tokenizer.from_str(model)
        self.model, self.pieces = library.model, regex.compile(pattern).findall
        # Latin-1 maps bytes to code points one to one, so this is the byte table.
        self.table = dict(enumerate(byte_characters()))
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.bytes_of = {
            i: bytes(byte_of[c] for c in token) for token, i in library.get_vocab(False).items()
        }
        tokens = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of, default=-1) + 1)]
        self.size_of = np.array([len(t) for t in tokens], np.int64)
        self.first_of = np.cumsum(self.size_of) - self.size_of
        self.all_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        # One object per id, whatever number of remembered words holds it.
        self.number = list(range(len(self.size_of)))
        self.decimal = list(map(str, self.number))
        self.known: dict[str, list[int]] = {}
        self.seen: dict[str, list[int]] = {}

    def merge(self, text: str) -> list[int]:
        """The ids of a text, piece by piece."""
        pieces, seen = self.pieces(text), self.seen
        if len(pieces) == 1:
            return seen.get(pieces[0]) or self._merge_piece(pieces[0])
        ids = []
        for piece in pieces:
            ids += seen.get(piece) or self._merge_piece(piece)
        return ids

    def _merge_piece(self, piece: str) -> list[int]:
        raw = piece.encode("utf-8", "replace").decode("latin-1").translate(self.table)
        ids = [self.number[token.id] for token in self.model.tokenize(raw)]
        if len(piece) <= LONG_PIECE:
            self.seen[piece] = ids
        return ids

    def learn(self, words: set[str]) -> None:
        """Remember the ids of words with the blank before them. They are empty for a word that is
        empty or has white space at an end: its pieces depend on its neighbours."""
        for name in ("known", "seen"):
            if len(have := getattr(self, name)) > KNOWN_WORDS:
                # What came first is what is frequent.
                setattr(self, name, dict(islice(have.items(), KNOWN_WORDS // 2)))
        known, merge = self.known, self.merge
        for word in words - known.keys():
            alone = word and not word[0].isspace() and not word[-1].isspace()
            known[word] = merge(" " + word) if alone else []

    def forget(self) -> None:
        """Give the memory of words and pieces back. Workers outlive their tasks and run those of later steps."""
        self.known, self.seen = {}, {}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts. Between a character and a single blank two pieces always meet, so a
        text is taken word by word; a part of it with other white space around blanks is
        taken whole."""
        parts = [[part.split(" ") for part in chunks(t)] for t in texts]
        self.learn({w for text in parts for part in text for w in part[1:]})
        return [
            np.fromiter(chain.from_iterable(map(self._part, text)), np.int32) for text in parts
        ]

    def _part(self, words: list[str]) -> list[int]:
        first, rest = words[0], words[1:]
        if not first and rest:  # the part begins with a blank
            first, rest = " " + rest[0], rest[1:]
        each = list(map(self.known.__getitem__, rest))
        if [] in each or first[-1:].isspace():
            return self.merge(" ".join(words))
        return [*self.merge(first), *chain.from_iterable(each)]

    def starts(self, text: str, ids: np.ndarray) -> np.ndarray:
        """The code point of the text in which each token starts."""
        sizes = self.size_of[ids]
        first = np.cumsum(sizes) - sizes
        raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        if len(raw) != len(text):
            # Byte to character: bytes 0x80 to 0xBF continue the character before them.
            first = (np.cumsum((raw & 0xC0) != 0x80) - 1)[first]
        return first.astype(np.int32)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids, copied out of the byte table of the vocabulary."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.size_of):
            raise ValueError("an id is outside of the vocabulary")
        sizes = self.size_of[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.first_of[ids] - ends + sizes, sizes)
        return self.all_bytes[shift + np.arange(len(shift))].tobytes()

    def decode_each(self, ids: list[int]) -> list[str]:
        """The text that each token completes: of a character that is split over tokens, the
        last one yields it and the others nothing. Bytes that are no UTF-8 become U+FFFD."""
        step = codecs.getincrementaldecoder("utf-8")("replace")
        return [step.decode(self.bytes_of[i], n == len(ids)) for n, i in enumerate(ids, 1)]


def runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Rows to take together: as many as have BATCH_CHARS between them, one at least."""
    first = total = 0
    for row, size in enumerate(sizes.tolist(), 1):
        total += size
        if total >= BATCH_CHARS or row == len(sizes):
            yield first, row
            first, total = row, 0


def chunks(text: str) -> Iterator[str]:
    """A text in parts. Parts end between a letter or digit and a blank, where every
    match of the pattern ends too, and which no match looks across."""
    between = re.compile(r"(?<=[A-Za-z0-9])(?= )")
    start = 0
    while len(text) - start > CHUNK_CHARS:
        cut = between.search(text, start + CHUNK_CHARS)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


@lru_cache(maxsize=2)
def _codec(model: str, pattern: str) -> Codec:
    return Codec(model, pattern)


ENCODED = "ids array<int>, starts array<int>"


def encode(
    docs: DataFrame, model: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``key``, ``ids`` and ``starts`` (the code point in which each token starts; two tokens
    with one start share a character). ``model`` is what ``model_json`` gives; it goes out as one broadcast
    whose size is that of the vocabulary."""
    spec = docs.sparkSession.sparkContext.broadcast((model, pattern))
    kind = docs.schema[key].dataType.simpleString()

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*spec.value)
        for batch in arrow:
            keys, texts = batch.column(0), batch.column(1)
            for first, last in runs(pc.utf8_length(texts).to_numpy(False)):
                some = texts.slice(first, last - first).to_pylist()
                ids = codec.encode(some)
                starts = [codec.starts(*both) for both in zip(some, ids)]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(first, last - first), _lists(ids), _lists(starts)],
                    names=[key, "ids", "starts"],
                )
        codec.forget()

    return docs.select(key, whole_text(text).alias("text")).mapInArrow(
        batches, f"`{key}` {kind}, {ENCODED}"
    )


def decode(encoded: DataFrame, model: str, key: str = "doc_id") -> DataFrame:
    """All columns of ``encoded`` and ``decoded``: the bytes of ``ids``, which is the text
    in UTF-8 where the ids came from a text."""
    spec = encoded.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in encoded.columns if c != "decoded"]
    given = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in columns)
    at = columns.index("ids")

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(spec.value, ".")
        for batch in arrow:
            raw = [codec.decode(x.values.to_numpy()) if x.is_valid else None for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(raw, pa.binary())], names=[*columns, "decoded"]
            )

    return encoded.select(*columns).mapInArrow(batches, f"{given}, decoded binary")


def digests(
    docs: DataFrame, model: str, pattern: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encodes each text and decodes the ids again, and gives digests of both in place of the
    ids and bytes: ``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and ``last_start``, the
    code point in which the last token starts."""
    spec = docs.sparkSession.sparkContext.broadcast((model, pattern))
    kind = docs.schema[key].dataType.simpleString()

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(*spec.value)
        for batch in arrow:
            keys, texts = batch.column(0), batch.column(1)
            for first, last in runs(pc.utf8_length(texts).to_numpy(False)):
                rows = []
                some = texts.slice(first, last - first).to_pylist()
                for whole, ids in zip(some, codec.encode(some)):
                    numbers = " ".join(map(codec.decimal.__getitem__, ids.tolist()))
                    starts = codec.starts(whole, ids)
                    rows.append(
                        (
                            len(ids),
                            hashlib.sha256(numbers.encode()).hexdigest(),
                            hashlib.sha256(codec.decode(ids)).hexdigest(),
                            int(starts[-1]) if len(starts) else None,
                        )
                    )
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), DIGEST_TYPES)]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(first, last - first), *columns], names=[key, *DIGEST_NAMES]
                )
        codec.forget()

    return docs.select(key, whole_text(text).alias("text")).mapInArrow(
        batches,
        f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, last_start long",
    )


DIGEST_NAMES = ("n_tokens", "ids_sha256", "decoded_sha256", "last_start")
DIGEST_TYPES = (pa.int64(), pa.string(), pa.string(), pa.int64())


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts)))


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> tuple[str, str]:
    """Model and pattern of an installed public vocabulary."""
    import public_tokenizers

    return model_json(read_ranks(public_tokenizers.path(name))), public_tokenizers.PATTERN


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document encoded and decoded again: digests of the ids and of the decoded bytes,
    and where the last token starts."""
    model, pattern = vocabulary()
    return digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), model, pattern)


def stage_byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as training data: identifier and source, ids, and where each token starts."""
    model, pattern = vocabulary()
    keyed = docs.withColumn("__key", F.to_json(F.struct("doc_id", "source")))
    return encode(keyed, model, pattern, "__key").select(
        *(F.from_json("__key", "doc_id long, source string")[c].alias(c) for c in ("doc_id", "source")),
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        "starts",
    )
