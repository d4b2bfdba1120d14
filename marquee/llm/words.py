"""Words of a text as 64-bit numbers, for many words at a time.

A word's number is a polynomial in a fixed odd base over random values of its bytes. It depends on the
word alone, so equal words have equal numbers in every task."""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` values of splitmix64."""
    at = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + np.uint64(seed)
    return mix(at)


BASE = 0x9E3779B97F4A7C15
BYTES = stream(0x5EED, 256)
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_separates = np.zeros(256, bool)
_separates[[0x20, *range(0x09, 0x0E)]] = True


def powers(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1 modulo 2^64."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


_powers = powers(BASE, 64)


def word_numbers(text: str, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the words, and their first and end bytes in the text's UTF-8 bytes, which come last.
    With ``lower`` the letters A-Z count as a-z."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = ~_separates[raw]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        return np.zeros(0, np.uint64), first, end, raw
    sizes = end - first
    longest = int(sizes.max())
    power = _powers if longest <= len(_powers) else powers(BASE, longest)
    letters = (_lower[raw] if lower else raw)[inside]
    begin = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(begin, sizes)
    numbers = np.add.reduceat(BYTES[letters] * power[place], begin)
    return mix(numbers + sizes.astype(np.uint64)), first, end, raw


def shingles(numbers: np.ndarray, size: int) -> np.ndarray:
    """The distinct runs of ``size`` words, as sorted numbers; fewer words are one run."""
    if not len(numbers):
        return numbers
    size = min(size, len(numbers))
    total = np.zeros(len(numbers) - size + 1, np.uint64)
    for i in range(size):
        total = mix(total * np.uint64(BASE) + numbers[i : i + len(total)] + np.uint64(i + 1))
    return np.unique(total)
