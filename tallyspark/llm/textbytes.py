"""Texts of an Arrow batch as one numpy byte array, with word, line and shingle hashes.

All functions work on the UTF-8 bytes of several texts at once, so a task does a few array passes
instead of one Python step per word. A word, line or shingle is known by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20  # a memory bound: texts handled at a time; one longer text is handled alone

_ODD = 0x9E3779B97F4A7C15  # any odd number has an inverse modulo 2**64
_INVERSE = pow(_ODD, -1, 1 << 64)


def _byte_codes() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def table(members: str, negate: bool = False) -> np.ndarray:
    """Which of the 256 byte values are in a set of ASCII characters."""
    flags = np.zeros(256, bool)
    flags[list(members.encode())] = True
    return ~flags if negate else flags


WHITE = table(" \t\n\x0b\x0c\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CODES = _byte_codes()
LOWER_CODES = CODES[LOWER]


class Texts(NamedTuple):
    """Rows [first, last) of a batch: text i is data[offsets[i]:offsets[i + 1]]."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray


def texts_of(batch: pa.RecordBatch, column: str = "text", at_most: int = SLICE_BYTES) -> Iterator[Texts]:
    """Consecutive rows of a batch with about `at_most` bytes of text each; null is empty."""
    values = pc.fill_null(batch.column(column), "").cast(pa.large_binary())
    count = len(values)
    if not count:
        return
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + count + 1]
    body = values.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < count:
        last = int(np.searchsorted(offsets, offsets[first] + at_most, side="right")) - 1
        last = min(max(last, first + 1), count)
        low, high = int(offsets[first]), int(offsets[last])
        yield Texts(first, last, data[low:high], offsets[first : last + 1] - low)
        first = last


class Hasher:
    """Polynomial hashes of byte ranges from one running sum; keeps its power tables."""

    def __init__(self) -> None:
        self._powers = np.ones(1, np.uint64)
        self._inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self._powers) <= size:
            size = max(size + 1, 1 << 16)
            with np.errstate(over="ignore"):
                for name, base in (("_powers", _ODD), ("_inverses", _INVERSE)):
                    steps = np.full(size, base, np.uint64)
                    steps[0] = 1
                    setattr(self, name, np.multiply.accumulate(steps))

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = CODES) -> np.ndarray:
        """A hash of data[starts[i]:ends[i]] for every i, whatever the place it stands at."""
        self._grow(len(data))
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(codes[data] * self._powers[: len(data)], out=sums[1:])
            raw = (sums[ends] - sums[starts]) * self._inverses[starts]
            return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(_ODD))

    def windows(self, data: np.ndarray, width: int) -> np.ndarray:
        """Hashes of all windows of `width` bytes."""
        count = len(data) - width + 1
        if count <= 0:
            return np.zeros(0, np.uint64)
        starts = np.arange(count)
        return self.ranges(data, starts, starts + width)


def spans_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of `inside` that do not cross texts: starts, ends, and runs before each offset."""
    size = len(inside)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[offsets < size]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    edges = offsets[offsets > 0] - 1
    stops[edges] = inside[edges]
    ends = np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(texts: Texts, hasher: Hasher, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words (runs without ASCII white space): starts, ends, hashes, and words before each offset."""
    starts, ends, before = spans_of(~WHITE[texts.data], texts.offsets)
    return starts, ends, hasher.ranges(texts.data, starts, ends, codes), before


def grams(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of `width` consecutive word hashes at every word that has enough followers."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(count, width, np.uint64)
        for k in range(width):
            out = mix(out * np.uint64(_ODD) + words[k : k + count])
    return out


def shingle_sets(texts: Texts, hasher: Hasher, width: int) -> Iterator[np.ndarray]:
    """For each text, its sorted distinct `width`-word shingles (A-Z lower-cased); short texts: one."""
    _, _, words, before = word_hashes(texts, hasher, LOWER_CODES)
    every = grams(words, width)
    for low, high in zip(before[:-1], before[1:], strict=True):
        count = high - low
        if count >= width:
            yield np.unique(every[low : high - width + 1])
        elif count:
            yield grams(words[low:high], int(count))
        else:
            yield np.zeros(0, np.uint64)
