"""Ids of many texts at a time, as the tokenizers library gives them.

The library cuts a text into pieces (words with the blank before them, numbers, signs, white space) and merges
bytes within each. Here NumPy finds the cuts of a whole batch, Arrow lists the distinct pieces, and the library
encodes each of those once; pieces that were met before are remembered. The class of a character (letter, number,
space, other) is asked of the library's own cutter, so that both cut alike."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from marquee.llm.bpe import CHUNK_CHARS, byte_characters, chunks

LETTER, NUMBER, OTHER, SPACE, UNKNOWN = range(5)
# Bytes of text that are encoded together, a single longer text aside.
BATCH_BYTES = 6 << 20
# Distinct pieces, and bytes of them, beyond which all are forgotten. Only speed depends on it.
KNOWN_PIECES, KNOWN_BYTES = 700_000, 24 << 20


class Encoder:
    """Encodes in a worker. ``model`` is the library's description of a byte-level BPE without a normalizer
    and with the cutter's own pattern. The strings of special tokens are ordinary text."""

    def __init__(self, model: str):
        self.library = Tokenizer.from_str(model)
        self.model = self.library.model
        # Latin-1 maps bytes to code points one to one, so this is the byte table.
        self.table = dict(enumerate(byte_characters()))
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.known_bytes = 0
        self.first = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.int32)
        self.used = 0

    def _merge(self, piece: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(piece.decode("latin-1").translate(self.table))]

    def _class_of(self, code: int) -> int:
        char, cut = chr(code), self.library.pre_tokenizer.pre_tokenize_str
        for kind, around in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")):
            if len(cut(around + char + around)) == 1:
                return kind
        return SPACE

    def _classes(self, codes: np.ndarray) -> np.ndarray:
        out = self.classes[codes]
        if (out == UNKNOWN).any():
            for code in np.unique(codes[out == UNKNOWN]).tolist():
                self.classes[code] = self._class_of(code)
            out = self.classes[codes]
        return out

    def cuts(self, raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The bytes of ``raw`` at which a piece begins; texts begin at ``starts``."""
        at = np.flatnonzero((raw & 0xC0) != 0x80)  # the first byte of each character
        codes = _code_points(raw, at)
        kind = self._classes(codes)
        n = len(at)
        begins = np.zeros(n + 1, bool)
        begins[np.searchsorted(at, starts)] = True
        begins[n] = True
        change = begins.copy()
        change[1:n] |= kind[1:] != kind[:-1]
        cut = begins.copy()
        spaces = kind == SPACE
        run = change[:n]
        # A single blank before a run of anything but white space belongs to it.
        joined = np.zeros(n, bool)
        joined[1:] = run[1:] & ~spaces[1:] & (codes[:-1] == 32) & ~begins[1:n]
        cut[:n] |= run & ~joined
        cut[: n - 1] |= joined[1:]
        # The last character of white space before a run is a piece of its own or begins one.
        last = np.zeros(n, bool)
        last[:-1] = spaces[:-1] & ~spaces[1:] & ~begins[1:n]
        cut[:n] |= last
        self._contractions(codes, kind, run & ~joined, begins, cut)
        return at[cut[:n]]

    @staticmethod
    def _contractions(
        codes: np.ndarray, kind: np.ndarray, opens: np.ndarray, begins: np.ndarray, cut: np.ndarray
    ) -> None:
        """An apostrophe that opens a piece takes the ending after it: s, t, m, d, re, ve or ll."""
        n = len(codes)
        for i in np.flatnonzero(opens & (codes == 39)).tolist():
            if i + 1 >= n or begins[i + 1] or kind[i + 1] != LETTER:
                continue
            one = chr(codes[i + 1])
            two = one + chr(codes[i + 2]) if i + 2 < n and not begins[i + 2] else ""
            taken = 1 if one in "stmd" else 2 if two in ("re", "ve", "ll") else 0
            if taken:
                cut[i + 1] = False
                cut[i + 1 + taken] = True

    def _places(self, pieces: list[bytes]) -> np.ndarray:
        """Where the ids of each distinct piece are listed."""
        if len(self.known) > KNOWN_PIECES or self.known_bytes > KNOWN_BYTES:
            self._forget()
        known = self.known
        new = [p for p in pieces if p not in known]
        if new:
            ids = list(map(self._merge, new))
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            total = int(sizes.sum())
            flat = np.fromiter((i for e in ids for i in e), np.int32, total)
            have = len(known)
            self.flat = _grown(self.flat, self.used + total)
            self.first, self.size = _grown(self.first, have + len(new)), _grown(self.size, have + len(new))
            self.flat[self.used : self.used + total] = flat
            self.first[have : have + len(new)] = self.used + np.cumsum(sizes) - sizes
            self.size[have : have + len(new)] = sizes
            self.used += total
            self.known_bytes += sum(map(len, new))
            known.update(zip(new, range(have, have + len(new))))
        return np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts are ``raw[offsets[i]:offsets[i + 1]]``. All ids, and where those of each text begin (with the
        end of the last)."""
        filled = offsets[:-1][np.diff(offsets) > 0]
        if not len(filled):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        cut = self.cuts(raw, filled)
        ends = np.append(cut, len(raw)).astype(np.int32)
        data = pa.py_buffer(np.ascontiguousarray(raw))
        listed = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(ends), data]).dictionary_encode()
        place = self._places(_values(listed.dictionary))[listed.indices.to_numpy()]
        sizes, first = self.size[place], self.first[place]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(first - ends + sizes, sizes) + np.arange(int(ends[-1]))]
        before = np.concatenate([[0], ends])
        return ids, before[np.searchsorted(cut, offsets)]

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of an Arrow column without NULLs, one array after the other."""
        column = column.cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8)
        row = 0
        while row < len(column):
            # As many rows as fit, one at least.
            last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BATCH_BYTES, "right")) - 1)
            low, high = int(offsets[row]), int(offsets[last])
            if last == row + 1 and high - low > CHUNK_CHARS:
                yield self._long(raw[low:high].tobytes().decode("utf-8", "replace"))
            else:
                ids, first = self.encode(raw[low:high], offsets[row : last + 1] - low)
                yield from np.split(ids, first[1:-1])
            row = last

    def _long(self, text: str) -> np.ndarray:
        """Of a text that is long by itself, part by part."""
        parts = []
        for part in chunks(text):
            raw = np.frombuffer(part.encode("utf-8"), np.uint8)
            parts.append(self.encode(raw, np.array([0, len(raw)], np.int64))[0])
        return np.concatenate(parts)


def _values(listed: pa.BinaryArray) -> list[bytes]:
    ends = np.frombuffer(listed.buffers()[1], np.int32)[: len(listed) + 1].tolist()
    data = listed.buffers()[2].to_pybytes()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def _grown(values: np.ndarray, size: int) -> np.ndarray:
    if size <= len(values):
        return values
    out = np.zeros(max(size, 2 * len(values)), values.dtype)
    out[: len(values)] = values
    return out


def _code_points(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The code point of each character from its UTF-8 bytes."""
    codes = raw[at].astype(np.int32)
    for lead, mask, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
        these = np.flatnonzero((raw[at] >= lead) & (raw[at] < (0xE0, 0xF0, 0x100)[more - 1]))
        if not len(these):
            continue
        code = codes[these] & mask
        for k in range(1, more + 1):
            code = (code << 6) | (raw[np.minimum(at[these] + k, len(raw) - 1)] & 0x3F)
        codes[these] = np.minimum(code, 0x10FFFF)
    return codes
