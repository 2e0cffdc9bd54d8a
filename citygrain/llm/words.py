"""Vectorised hashing of words, shingles and MinHash signatures over Arrow text buffers.

Texts are read straight from the buffers of an Arrow column, as bytes; no Python string is made
per word. A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and
carriage return; A-Z are lower-cased first. A null text counts as an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that are worked on at once; a text is cut at blanks only, so a longer word widens a slice.
SLICE_BYTES = 1 << 20

_SEPARATORS = np.zeros(256, dtype=bool)
_SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD_BYTE = ~_SEPARATORS
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_random = np.random.default_rng(20240229)
_BYTE_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_SHINGLE_FACTOR = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, length: int) -> np.ndarray:
    """Powers of an odd base modulo 2^64, widened when a longer slice comes."""
    table = _powers.get(base)
    if table is None or len(table) < length:
        table = np.full(max(length, SLICE_BYTES + 1), base, dtype=np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        _powers[base] = table
    return table[:length]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (finaliser of SplitMix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column, and where each text begins (one more entry than texts)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if buffers[2] is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    return _LOWER[data]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of at most ``limit`` bytes together; a longer text is a run of its own."""
    low, count = 0, len(offsets) - 1
    while low < count:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield low, min(high, count)
        low = min(high, count)


def _segments(data: np.ndarray, breaks: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut bytes at blanks or text ends into segments of about SLICE_BYTES."""
    low = 0
    while low < len(data):
        high = min(len(data), low + SLICE_BYTES)
        if high < len(data):
            blanks = np.flatnonzero(_SEPARATORS[data[low:high]])
            at = int(np.searchsorted(breaks, high, side="right")) - 1
            cut = max(low + int(blanks[-1]) + 1 if len(blanks) else low, int(breaks[at]))
            if cut <= low:  # one word longer than a segment
                after = np.flatnonzero(_SEPARATORS[data[high:]])
                end = high + int(after[0]) + 1 if len(after) else len(data)
                cut = min(end, int(breaks[at + 1]))
            high = cut
        yield low, high
        low = high


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of the texts, and the index of each text's first word.

    The hash of a word is a difference of prefix sums of a polynomial, so it costs a few operations
    per byte. ``offsets`` are relative to ``data``, which is already lower-cased.
    """
    found, starts = [], []
    for low, high in _segments(data, offsets):
        part = data[low:high]
        word = _WORD_BYTE[part]
        edge = np.zeros(len(part) + 1, dtype=bool)
        inner = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high, side="right")] - low
        edge[inner] = True
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1] | edge[1:-1]
        ends[:-1] &= ~word[1:] | edge[1:-1]
        begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[part] * _power_table(_BASE, len(part)), out=sums[1:])
        values = (sums[end] - sums[begin]) * _power_table(_BASE_INVERSE, len(part))[begin]
        found.append(mixed(values + (end - begin).astype(np.uint64)))
        starts.append(begin + low)
    if not found:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    return np.concatenate(found), np.searchsorted(np.concatenate(starts), offsets)


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words of a text, and the index of each text's first shingle.

    A text of fewer words is one shingle of them all; a text without words has none.
    """
    counts = np.diff(first)
    shingles = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begins = np.zeros(len(first), dtype=np.int64)
    np.cumsum(shingles, out=begins[1:])
    out = np.zeros(int(begins[-1]), dtype=np.uint64)
    if len(words) >= size:
        rolled = np.zeros(len(words) - size + 1, dtype=np.uint64)
        for step in range(size):
            rolled += words[step : step + len(rolled)] * _SHINGLE_FACTOR[step]
        long = counts >= size
        source = np.repeat(first[:-1][long] - begins[:-1][long], shingles[long])
        target = np.repeat(long, shingles)
        out[target] = rolled[source + np.flatnonzero(target)]
    for text in np.flatnonzero((counts > 0) & (counts < size)):
        own = words[first[text] : first[text + 1]]
        out[begins[text]] = (own * _SHINGLE_FACTOR[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mixed(out), begins


class MinHash:
    """Minima of many universal hash permutations of 32-bit shingle hashes."""

    def __init__(self, permutations: int, seed: int = 7) -> None:
        random = np.random.default_rng(seed)
        self.factor = random.integers(0, 1 << 31, permutations, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.shift = random.integers(0, 1 << 32, permutations, dtype=np.uint32)

    def signature(self, shingles: np.ndarray, block: int = 1024) -> np.ndarray:
        """One minimum per permutation; all ones where there are no shingles."""
        best = np.full(len(self.factor), 0xFFFFFFFF, dtype=np.uint32)
        values = (shingles >> np.uint64(32)).astype(np.uint32)
        for low in range(0, len(values), block):
            hashed = self.factor[:, None] * values[None, low : low + block]
            hashed += self.shift[:, None]
            np.minimum(best, hashed.min(axis=1), out=best)
        return best
