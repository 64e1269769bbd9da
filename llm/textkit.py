"""Whole texts of an Arrow batch as NumPy word tables: bounds, 64-bit word hashes, shingle hashes.

Everything works on the UTF-8 bytes of a column at once. A batch is cut into
slices of whole documents of about `SLICE_BYTES`, so the temporary arrays stay
small however long the batch is; one document longer than that is a slice alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

# The odd multipliers of the splitmix64 finaliser and the golden-ratio step.
MIX_A, MIX_B, STEP = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15
POWER = np.uint64(0x9DDFEA08EB382D69)  # odd, so that every power is invertible

WHITESPACE = bytes([0x20, *range(0x09, 0x0E)])
PUNCTUATION = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x + np.uint64(STEP)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Alphabet:
    """Which bytes part words, and the value that stands for each other byte."""

    parts: np.ndarray
    values: np.ndarray


def alphabet(separators: bytes, fold: bool = True) -> Alphabet:
    parts = np.zeros(256, bool)
    parts[list(separators)] = True
    values = mix64(np.arange(256, dtype=np.uint64))
    if fold:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[parts] = 0
    return Alphabet(parts, values)


PLAIN_WORDS = alphabet(WHITESPACE)
LETTER_WORDS = alphabet(WHITESPACE + PUNCTUATION)

_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 4096), POWER, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


@dataclass
class Words:
    """Words of consecutive documents: `first[d]:first[d + 1]` are those of document d."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def documents(self) -> int:
        return len(self.first) - 1

    def of(self, d: int) -> np.ndarray:
        return self.hashes[self.first[d] : self.first[d + 1]]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, nulls as empty, and the offset of each text."""
    plain = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    body = plain.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_table(data: np.ndarray, offsets: np.ndarray, letters: Alphabet = PLAIN_WORDS) -> Words:
    inside = ~letters.parts[data]
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    filled = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[heads] = inside[heads]
    closes[tails] = inside[tails]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(data, offsets, starts, ends, first, np.zeros(0, np.uint64))
    body = data[starts[0] :]
    spans = np.diff(starts, append=len(data))
    places = np.arange(len(body)) - np.repeat(starts - starts[0], spans)
    table = powers(int(spans.max()))
    sums = np.add.reduceat(letters.values[body] * table[places], starts - starts[0])
    return Words(data, offsets, starts, ends, first, mix64(sums))


def slices(column: pa.Array, letters: Alphabet = PLAIN_WORDS) -> Iterator[tuple[int, Words]]:
    """(index of the first document, word table) for slices that together cover the column."""
    data, offsets = column_bytes(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        part = offsets[at : to + 1]
        yield at, word_table(data[part[0] : part[-1]], part - part[0], letters)
        at = to


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of every k consecutive words, in order."""
    if len(hashes) < k:
        return np.zeros(0, np.uint64)
    m = len(hashes) - k + 1
    total = hashes[:m].copy()
    for j in range(1, k):
        total = total * POWER + hashes[j : j + m]
    return mix64(total)


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """Per document the sorted distinct shingle hashes: k words, or the whole shorter sequence."""
    every = rolling(words.hashes, k)
    for d in range(words.documents()):
        a, b = int(words.first[d]), int(words.first[d + 1])
        if b - a >= k:
            yield np.unique(every[a : b - k + 1])
        elif b > a:
            yield rolling(words.hashes[a:b], b - a) ^ np.uint64(b - a)
        else:
            yield np.zeros(0, np.uint64)
