"""Words of whole Arrow text columns as numpy arrays: positions, counts and 64-bit hashes, without Python strings.

A word is a maximal run of bytes other than space and ``\\t \\n \\v \\f \\r``; null texts have no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """``bounds[d]:bounds[d + 1]`` are the words of document d; bytes of word i: ``data[start[i]:end[i]]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def documents(self) -> np.ndarray:
        """Document of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts())


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offsets of each text; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def split_words(column: pa.Array, lower: bool = False) -> Words:
    """Words of every text; ``lower`` maps A-Z only."""
    data, offsets = text_buffer(column)
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: int, count: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64."""
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def hash_words(words: Words, seed: int = 0) -> np.ndarray:
    """64-bit polynomial hash of each word over random byte values; two seeds give independent functions."""
    if len(words.start) == 0:
        return np.zeros(0, np.uint64)
    values = np.random.default_rng(seed + 7919).integers(1, 2**63, 257, dtype=np.uint64)
    length = words.end - words.start
    begin = np.cumsum(length) - length
    place = np.arange(length.sum()) - np.repeat(begin, length)
    body = words.data[place + np.repeat(words.start, length)]
    terms = values[:256][body] * powers(int(values[256]) | 1, int(length.max()))[place]
    return mix(np.add.reduceat(terms, begin) + length.astype(np.uint64))


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that each piece holds about ``size`` bytes of text, or one longer document."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at, done = 0, 0
        while at < len(ends):
            stop = max(at + 1, int(np.searchsorted(ends, done + size, "right")))
            yield batch.slice(at, stop - at)
            at, done = stop, int(ends[stop - 1])
