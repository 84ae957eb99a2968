"""Different runs of characters of a text column, and what belongs to each put together again text by text, without a loop over runs.

A run is a maximal stretch without ASCII white space; null texts have none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from logweir.llm.words import text_buffer

_GRAPHIC = np.ones(256, bool)
_GRAPHIC[[0x20, *range(0x09, 0x0E)]] = False


def distinct_runs(column: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The different runs, the number of the run at each place, and the bounds of each text's places."""
    data, offsets = text_buffer(column)
    inside = _GRAPHIC[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(first)
    letters = data[inside]
    ends = np.append(np.cumsum(inside)[starts] - 1, len(letters)).astype(np.int64)
    runs = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    coded = runs.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.searchsorted(starts, offsets)


def gather(values: list[bytes] | pa.Array, places: np.ndarray, bounds: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The values at all places one after the other, and where those of each text begin and end."""
    put = (values if isinstance(values, pa.Array) else pa.array(values, pa.large_binary())).take(pa.array(places))
    if len(put) == 0:
        return memoryview(b""), np.zeros(len(bounds), np.int64)
    ends = np.frombuffer(put.buffers()[1], np.int64)[put.offset : put.offset + len(put) + 1]
    data = put.buffers()[2]
    return memoryview(data) if data is not None else memoryview(b""), ends[bounds]
