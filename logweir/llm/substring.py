"""Removal of passages that repeat across a corpus, with a count-min prefilter.

A window is ``window`` consecutive words of one document. Texts are cut into blocks of bounded size, staged once, and every
step reads whole blocks.

First pass: every block counts its windows in a sketch of ``depth`` rows, and sends the cells it counted, packed by cell range.
One task a range merges the sketches of all blocks and answers each block with one bit a cell: counted twice or more. So no
task and no broadcast ever holds the whole sketch, and it has two to four cells a window at every size of the corpus. A count-min
estimate is never below the true count, so every window that repeats passes all rows. Second pass: only windows that
pass are grouped exactly, by 96-bit fingerprints of their word sequence, in buckets whose number grows with the input; a
block sends a window that it holds several times once, so that a passage of many documents gives one row for each block. The
buckets answer with the places of those that repeat. Third pass: each block removes the words that these cover.

A block sends at most one row a range and row of the sketch, and never more rows than windows; with ever more ranges the
rows become small (some 700 windows at 30 GB, 20 at 1 TB).

Defined results: a null or short text has no window and keeps its words; a repeated row repeats its windows, so all
its windowed words go from both; rows are told apart by their place in the staged blocks; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.staging import stage
from logweir.llm.words import Words, blocks, hash_words, mix, powers, split_words, text_buffer

#: Fixed value: odd base of the rolling window hash.
BASE = 0x9E3779B97F4A7C15
#: Least cells of a sketch row, most cells of one merge range, bytes of text of a block and for a bucket of the exact grouping.
RANGE, PART, BLOCK, BUCKET_BYTES = 1 << 20, 1 << 24, 4 << 20, 1 << 26
#: Bytes of a row group of the staged blocks: a reader holds a few blocks at a time.
ROW_GROUP = 16 << 20

CELLS = "row int, part int, block bigint, size int, cells binary, twice binary"
PASSES = "row int, part int, block bigint, passes binary"
WINDOWS = "bucket int, block bigint, words int, size int, places binary, high binary, low binary, again binary"
REPEATED = "block bigint, words int, size int, places binary"


def rolling(words: Words, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window that lies inside one document, and the index of its first word."""
    count = len(hashes)
    if count < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inverse = pow(BASE, -1, 1 << 64)
    total = np.zeros(count + 1, np.uint64)
    np.cumsum(hashes * powers(BASE, count), out=total[1:])
    at = np.arange(count - window + 1)
    document = words.documents()
    at = at[document[at] == document[at + window - 1]]
    return mix((total[at + window] - total[at]) * powers(inverse, count)[at]), at


def cells(first: np.ndarray, row: int, width: int) -> np.ndarray:
    """Cell of each window in one row of the sketch."""
    return (mix(first + np.uint64(0x632BE59BD9B4E019) * np.uint64(row + 1)) >> np.uint64(64 - width)).astype(np.int64)


def _low_bits(count: int, universe: int) -> int:
    return max(0, (universe // max(count, 1)).bit_length() - 1)


def pack(places: np.ndarray, universe: int) -> bytes:
    """Sorted distinct numbers below ``universe``: their low bits side by side, then a set bit for each high part."""
    count = len(places)
    low = _low_bits(count, universe)
    high = np.zeros(count + (universe >> low) + 1, bool)
    high[(places >> low) + np.arange(count)] = True
    lows = np.unpackbits(places.astype(">u4").view(np.uint8).reshape(count, 4), axis=1)[:, 32 - low :]
    return np.packbits(lows).tobytes() + np.packbits(high).tobytes()


def unpack(data: bytes, count: int, universe: int) -> np.ndarray:
    low = _low_bits(count, universe)
    wide = np.zeros((count, 32), np.uint8)
    size = -(-count * low // 8)
    wide[:, 32 - low :] = np.unpackbits(np.frombuffer(data, np.uint8, size), count=count * low).reshape(count, low)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=size))) - np.arange(count)
    return high << low | np.packbits(wide, axis=1).view(">u4")[:, 0].astype(np.int64)


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(data: bytes, count: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=count).astype(bool)


def _cut(groups: np.ndarray) -> list[tuple[int, int, int]]:
    """(group, begin, end) of each run of equal numbers."""
    begin = np.flatnonzero(np.diff(groups, prepend=-1))
    return list(zip(groups[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(groups)]))


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.table({name: pa.array(list(c), kind) for (name, kind), c in zip(fields, columns)}, pa.schema(fields))


def _in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block: the list of keys, its number, where each text ends, and all texts compressed."""
    task = TaskContext.get().partitionId()
    for n, batch in enumerate(blocks(batches, size=BLOCK)):
        data, offsets = text_buffer(batch.column("text"))
        keys = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("key"))
        body = pa.compress(data.tobytes(), "zstd", asbytes=True) if len(data) else b""
        values = [pa.array([task << 32 | n]), pa.array([offsets.astype("<i8").tobytes()]), pa.array([body])]
        yield pa.RecordBatch.from_arrays([keys, *values], names=["keys", "block", "offsets", "body"])


@dataclass
class Block:
    number: int
    data: bytes
    offsets: np.ndarray
    words: Words

    @classmethod
    def of(cls, number: int, offsets: bytes, body: bytes) -> Block:
        ends = np.frombuffer(offsets, "<i8")
        data = pa.decompress(body, int(ends[-1]), "zstd", asbytes=True) if ends[-1] else b""
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        texts = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, buffers)
        return cls(number, data, ends, split_words(texts))

    @classmethod
    def each(cls, table: pa.Table | pa.RecordBatch) -> Iterator[Block]:
        for n in range(table.num_rows):
            yield cls.of(*(table.column(c)[n].as_py() for c in ("block", "offsets", "body")))

    def windows(self, window: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        return rolling(self.words, hash_words(self.words, seed), window)


def _partial_sketch(
    batches: Iterator[pa.RecordBatch], window: int, depth: int, width: int, part: int
) -> Iterator[pa.RecordBatch]:
    """Cells that a block counted, and which of them more than once, by row and range of ``part`` cells."""
    for batch in batches:
        for block in Block.each(batch):
            first, _ = block.windows(window)
            rows = []
            for row in range(depth):
                found, counts = np.unique(cells(first, row, width), return_counts=True)
                for name, a, b in _cut(found // part):
                    packed = pack(found[a:b] - name * part, part)
                    rows.append((row, name, block.number, b - a, packed, _bits(counts[a:b] > 1)))
            yield from _table(rows, CELLS).to_batches()


def _merge(sent: pa.Table, part: int) -> pa.Table:
    """Which of the cells that a block sent are counted twice or more by the sketches of all blocks together."""
    rows, total, own = sent.to_pylist(), np.zeros(part, np.uint8), []
    for row in rows:
        place = unpack(row["cells"], row["size"], part).astype(np.int32)
        total[place] = np.minimum(total[place] + 1, 2)
        total[place[_flags(row["twice"], row["size"])]] = 2
        own.append(place)
    return _table([(r["row"], r["part"], r["block"], _bits(total[p] > 1)) for r, p in zip(rows, own)], PASSES)


def _passing(first: np.ndarray, answers: pa.Table, depth: int, width: int, part: int) -> np.ndarray:
    """Which windows the merged sketch estimates at two or more."""
    bits = {(r["row"], r["part"]): r["passes"] for r in answers.to_pylist()}
    keep = np.ones(len(first), bool)
    for row in range(depth):
        found, of = np.unique(cells(first, row, width), return_inverse=True)
        keep &= np.concatenate([_flags(bits[row, name], b - a) for name, a, b in _cut(found // part)])[of]
    return keep


def _windows(
    left: pa.Table, answers: pa.Table, window: int, depth: int, width: int, part: int, buckets: int
) -> pa.Table:
    """The windows of a block that pass, by bucket. Of those that the block itself holds more than once, one is sent and
    marked, and a row of their own, without fingerprints, has all their places."""
    rows: list[tuple] = []
    for block in Block.each(left):
        high, at = block.windows(window)
        if len(high) == 0:
            continue
        keep = _passing(high, answers, depth, width, part)
        if not keep.any():
            continue
        low = (block.windows(window, 1)[0][keep] >> np.uint64(32)).astype("<u4")
        high, at, size = high[keep], at[keep], len(block.words.start)
        order = np.lexsort((low, high))
        new = np.ones(len(order), bool)
        new[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
        many = np.zeros(len(order), bool)
        many[order] = np.diff(np.flatnonzero(new), append=len(order))[np.cumsum(new) - 1] > 1
        if many.any():
            places = at[many]
            rows.append((block.number % buckets, block.number, size, len(places), pack(places, size), None, None, None))
        sent = np.sort(order[new])
        bucket = (high[sent] % np.uint64(buckets)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        sent = sent[by_bucket]
        for name, a, b in _cut(bucket[by_bucket]):
            own = sent[a:b]
            packed = pack(at[own], size), high[own].astype("<u8").tobytes(), low[own].tobytes(), _bits(many[own])
            rows.append((name, block.number, size, len(own), *packed))
    return _table(rows, WINDOWS)


def _repeated(sent: pa.Table) -> pa.Table:
    """Places of the windows of a bucket that occur more than once, for each block."""
    known, rows, found = [], [], []
    for row in sent.to_pylist():
        (known if row["high"] is None else rows).append(row)
    if rows:
        high = np.concatenate([np.frombuffer(r["high"], "<u8") for r in rows])
        low = np.concatenate([np.frombuffer(r["low"], "<u4") for r in rows])
        repeated = np.concatenate([_flags(r["again"], r["size"]) for r in rows])
        order = np.lexsort((low, high))
        same = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
        repeated[order[1:][same]] = repeated[order[:-1][same]] = True
        for row, own in zip(rows, np.split(repeated, np.cumsum([r["size"] for r in rows])[:-1])):
            places = unpack(row["places"], row["size"], row["words"])[own]
            if len(places):
                found.append((row["block"], row["words"], len(places), pack(places, row["words"])))
    return _table([*((r["block"], r["words"], r["size"], r["places"]) for r in known), *found], REPEATED)


def _remove(left: pa.Table, right: pa.Table, window: int, key: str) -> pa.Table:
    """The texts of a block without the words that repeated windows cover."""
    block = next(Block.each(left))
    words, step = block.words, np.zeros(len(block.words.start) + 1, np.int64)
    for row in right.to_pylist():
        places = unpack(row["places"], row["size"], row["words"])  # distinct within a row
        step[places] += 1
        step[places + window] -= 1
    kept = np.cumsum(step)[:-1] == 0
    removed = np.concatenate([[0], np.cumsum(~kept)])
    removed = removed[words.bounds[1:]] - removed[words.bounds[:-1]]
    out = []
    for d in range(len(block.offsets) - 1):
        pieces = block.data[block.offsets[d] : block.offsets[d + 1]].split()
        if removed[d]:
            own = kept[words.bounds[d] : words.bounds[d + 1]]
            pieces = [w for w, stays in zip(pieces, own.tolist()) if stays]
        out.append(b" ".join(pieces).decode("utf-8", "surrogatepass"))
    keys = left.column("keys").combine_chunks().flatten()
    columns = [keys, pa.array(words.counts()), pa.array(removed), pa.array(out, pa.string())]
    return pa.table(columns, names=[key, "n_words", "n_removed", "kept_text"])


def sketch_width(size: int, max_cells: int | None = None) -> int:
    """Logarithm of the cells of a sketch row for ``size`` bytes of text: at least a third of them."""
    width = max((size // 3).bit_length(), RANGE.bit_length() - 1)
    return width if max_cells is None else min(width, max_cells.bit_length() - 1)


def remove_repeats(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = 35,
    depth: int = 2,
    max_cells: int | None = None,
) -> DataFrame:
    """(key, n_words, n_removed, kept_text) of every row; ``kept_text`` has one space between words.

    ``max_cells`` bounds a sketch row by choice: more windows then reach the exact grouping, the result is the same.
    """
    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = sketch_width(size, max_cells)
    part = min(PART, 1 << width)
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES + 1)
    kind = docs.schema[key].dataType.simpleString()
    whole = stage(
        source.mapInArrow(_in_blocks, f"keys array<{kind}>, block bigint, offsets binary, body binary"), row_group=ROW_GROUP
    )
    sketches = whole.mapInArrow(lambda x: _partial_sketch(x, window, depth, width, part), CELLS)
    answers = sketches.repartition(buckets, "row", "part").groupBy("row", "part").applyInArrow(lambda x: _merge(x, part), PASSES)
    texts = whole.repartition(buckets, "block").groupBy("block")
    by_block = texts.cogroup(answers.repartition(buckets, "block").groupBy("block"))
    passed = by_block.applyInArrow(lambda a, b: _windows(a, b, window, depth, width, part, buckets), WINDOWS)
    found = passed.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_repeated, REPEATED)
    by_block = texts.cogroup(found.repartition(buckets, "block").groupBy("block"))
    return by_block.applyInArrow(
        lambda a, b: _remove(a, b, window, key), f"`{key}` {kind}, n_words bigint, n_removed bigint, kept_text string"
    )
