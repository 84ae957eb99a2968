"""SimHash near-duplicates by Golay-code fuzzy hashing.

Fingerprint: majority vote per bit over the XXH64 of all 4-word shingles, repeats included. Candidate search: the 64
bits are three segments of 22, 21 and 21 bits, each read as a word of the perfect binary Golay code [23, 12, 7]. Every
segment gives the index of its own nearest codeword and of those nearest to it with one bit changed, one to six
different ones. Two segments with at most two differing bits share an index, as the word halfway between them is one
change from either. Four differing bits leave at least two of three segments with at most two each, so two linked
fingerprints share a key of two indices. Candidates are verified by counting differing bits: no link is lost.

Defined results: a null text has no words and fingerprint zero; documents of equal fingerprint are one node, whatever
their number; a repeated row gets the same result again; a null ``doc_id`` keeps its row and never names a component
unless all its members are null; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.buckets import block_pairs, runs, spanning
from logweir.llm.components import components
from logweir.llm.staging import stage

#: Generator polynomial of the Golay code, segments (first bit, bits), bits of a fingerprint.
GENERATOR = 0b110001110101
SEGMENTS = ((0, 22), (22, 21), (43, 21))
BITS = 64


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """SimHash of one text as unsigned 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    count = max(1, len(words) - shingle + 1)
    spans = zip(starts[:count].tolist(), ends[min(shingle, len(words)) - 1 :].tolist())
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(joined[a:b], seed) for a, b in spans]), np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, count, 4096):  # keeps the unpacked bits in the cache
        ones += np.unpackbits(hashes[at : at + 4096], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fingerprint) of every row; the fingerprint is a signed long with the same bits."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(x.as_py()) for x in batch.column(1)]
            values = pa.array(np.array(marks, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=[key, "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(compute, f"`{key}` {kind}, fingerprint bigint")


@cache
def _decoder() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of the upper 12 bits, and the error of up to three bits for each syndrome."""

    def remainder(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << bit - 11
        return word

    upper = np.array([remainder(x << 11) for x in range(4096)], np.int32)
    errors = np.zeros(2048, np.int32)
    ones = [1 << i for i in range(23)]
    for i, a in enumerate(ones):
        errors[remainder(a)] = a
        for j, b in enumerate(ones[i + 1 :], i + 1):
            errors[remainder(a | b)] = a | b
            for c in ones[j + 1 :]:
                errors[remainder(a | b | c)] = a | b | c
    return upper, errors


def decode(word: np.ndarray) -> np.ndarray:
    """Index (0 to 4095) of the only codeword within three bits of each 23-bit word."""
    upper, errors = _decoder()
    return (word ^ errors[upper[word >> 11] ^ (word & 2047)]) >> 11


def segment_indices(word: np.ndarray, bits: int) -> np.ndarray:
    """Sorted indices of each word and its one-bit neighbours, one row a word; repeats are -1."""
    near = np.stack([decode(word), *(decode(word ^ np.int32(1 << i)) for i in range(bits))], axis=1)
    near.sort(axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    near = -np.sort(-near, axis=1)
    return near[:, : int((near >= 0).sum(axis=1).max(initial=1))]


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all fingerprints and, for each key, the position of its fingerprint."""
    bits = prints.view(np.uint64)
    parts = []
    for first, width in SEGMENTS:
        word = ((bits >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int32)
        parts.append(segment_indices(word, width).astype(np.int64))
    keys, owners = [], []
    for n, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        a, b = parts[i][:, :, None], parts[j][:, None, :]
        valid = (a >= 0) & (b >= 0)
        keys.append(((n << 24) | (a << 12) | b)[valid])
        owners.append(np.broadcast_to(np.arange(len(prints))[:, None, None], valid.shape)[valid])
    return np.concatenate(keys), np.concatenate(owners)


def _emit_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = batch.column(0).to_numpy(zero_copy_only=False)
        for at in range(0, len(values), 8192):
            piece = values[at : at + 8192]
            keys, owners = keys_of(piece)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(piece[owners])], names=["key", "fingerprint"])


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _link(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Spanning edges of each group of sorted rows (key, left, right, fingerprint)."""

    def out(pairs: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(pairs.reshape(-1, 2), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    for piece in runs(batches, ["key", "left", "right"]):
        key, left, right, value = (piece.column(c).to_numpy() for c in ("key", "left", "right", "fingerprint"))
        change = (key[1:] != key[:-1]) | (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        begin = np.concatenate([[0], np.flatnonzero(change) + 1])
        size = np.diff(np.concatenate([begin, [len(key)]]))
        bits = value.view(np.uint64)
        found = []
        small = np.repeat(size <= 4, size)
        place = np.arange(len(key)) - np.repeat(begin, size)
        ahead = np.repeat(size, size) - place
        for step in (1, 2, 3):
            at = np.flatnonzero(small & (ahead > step))
            at = at[distance(bits[at], bits[at + step]) <= most]
            found.append(np.stack([value[at], value[at + step]], axis=1))
        for b, n in zip(begin[size > 4], size[size > 4]):
            own = value[b : b + n]
            edges = np.array(spanning(distance(bits[b : b + n, None], bits[None, b : b + n]) <= most), np.int64)
            found.append(own[edges.reshape(-1, 2)])
        pairs = np.concatenate(found)
        if len(pairs):
            yield out(np.sort(pairs, axis=1))


def linked_fingerprints(prints: DataFrame, most: int = 4, block: int = 1024) -> DataFrame:
    """Edges (a, b) between different fingerprints: each pair within ``most`` bits is joined by a path of edges."""
    if most > 4:
        raise ValueError("three segments with one changed bit each find up to four differing bits")
    keys = prints.select("fingerprint").mapInArrow(_emit_keys, "key bigint, fingerprint bigint")
    groups = block_pairs(keys, "key", "fingerprint", block).select("key", "left", "right", "fingerprint")
    sorted_groups = groups.repartition("key", "left", "right").sortWithinPartitions("key", "left", "right")
    return sorted_groups.mapInArrow(lambda batches: _link(batches, most), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", most: int = 4) -> DataFrame:
    """(key, fingerprint as 16 hex digits, component_id) of every row."""
    marked = stage(with_fingerprint(docs, text, key))
    prints = stage(marked.groupBy("fingerprint").agg(F.min(key).alias("least")))
    root = components(linked_fingerprints(prints, most))
    joined = prints.join(root, prints.fingerprint == root.node, "left")
    rooted = stage(joined.select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return marked.join(named.select("fingerprint", "component_id"), "fingerprint").select(
        key, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
