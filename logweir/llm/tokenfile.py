"""Token ids of a corpus as files of concatenated ids with Elias-Fano encoded document boundaries.

A file is a Parquet table; a row is a block: part and number of the block, tokens of the part before it, document keys,
ids as little-endian numbers of ``width`` bytes, and the ends of all documents inside the block. The ends never fall,
so each is split into ``low_bits`` low bits, packed side by side, and a high part in unary: bit ``high + i`` of the
upper bitmap is set for end i. That is at most two bits and ``low_bits`` bits a document. The select structure is the place
of every ``SAMPLE``-th set bit, an eighth of a bit a document: from the sample before it, the i-th set bit and so an end is
found by looking at a short stretch of the bitmap, without a table of 64-bit offsets. Single documents and stretches of
documents are read that way.

Blocks follow the order of the keys: the input is range-partitioned and sorted by key, nulls first, and rows of one
key are dealt over several parts by a hash of their texts. Texts are encoded by
the tokenizers library; runs of ASCII white space are never part of a token, so each different run of other characters
is encoded once a worker, and of plain runs each different piece. Defined results: a null or empty text has the end id only; repeated keys keep all their rows,
in any order; further columns are ignored; an empty table gives no blocks.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.bpe import byte_symbols
from logweir.llm.runs import distinct_runs, gather
from logweir.llm.words import blocks


#: Set bits from one sample of the select structure to the next.
SAMPLE = 256
#: Documents whose ends are unpacked at a time.
STRETCH = 4096


@dataclass
class EliasFano:
    """A non-decreasing sequence of ``count`` numbers below ``2**63``, with 32-bit samples of the places of set bits."""

    count: int
    low_bits: int
    lower: bytes
    upper: bytes
    samples: bytes

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        if len(values) == 0:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, (int(values[-1]) // len(values)).bit_length() - 1)
        high = (values >> low_bits) + np.arange(len(values))
        upper = np.zeros(int(high[-1]) + 1, bool)
        upper[high] = True
        lower = (values[:, None] >> np.arange(low_bits) & 1).astype(bool)
        samples = high[::SAMPLE].astype("<u4").tobytes()
        return cls(len(values), low_bits, np.packbits(lower.ravel()).tobytes(), np.packbits(upper).tobytes(), samples)

    def _low(self, index: np.ndarray) -> np.ndarray:
        if self.low_bits == 0:
            return np.zeros(len(index), np.int64)
        place = index[:, None] * self.low_bits + np.arange(self.low_bits)
        bits = np.frombuffer(self.lower, np.uint8)[place >> 3] >> (7 - (place & 7)) & 1
        return (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)

    def stretch(self, first: int, stop: int) -> np.ndarray:
        """The numbers from ``first`` up to ``stop``, out of the part of the bitmap between two samples."""
        if first >= stop:
            return np.zeros(0, np.int64)
        samples = np.frombuffer(self.samples, "<u4")
        before, after = first // SAMPLE, -(-stop // SAMPLE)
        begin = int(samples[before]) // 8
        end = int(samples[after]) // 8 + 1 if after < len(samples) else len(self.upper)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.upper, np.uint8)[begin:end]))
        ones = ones[np.searchsorted(ones, int(samples[before]) - 8 * begin) :]  # bits of the first byte that lie before the sample
        index = np.arange(first, stop)
        places = ones[index - before * SAMPLE] + 8 * begin
        return (places - index << self.low_bits) + self._low(index)

    def select(self, index: int) -> int:
        """The number at ``index``."""
        return int(self.stretch(index, index + 1)[0])

    def decode(self) -> np.ndarray:
        """All numbers."""
        return self.stretch(0, self.count)


BLOCK = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("begin", pa.int64()),
        ("n_tokens", pa.int64()),
        ("keys", pa.list_(pa.int64())),
        ("width", pa.int32()),
        ("ids", pa.binary()),
        ("low_bits", pa.int32()),
        ("lower", pa.binary()),
        ("upper", pa.binary()),
        ("samples", pa.binary()),
    ]
)
BLOCK_DDL = (
    "part int, block int, begin bigint, n_tokens bigint, keys array<bigint>, width int, ids binary, low_bits int, "
    "lower binary, upper binary, samples binary"
)


#: Runs whose lower case, composition and character classes are the same to every engine.
PLAIN = re.compile(r"[!-~À-ÿ]+")


class Encoder:
    """Ids of runs of characters other than white space, as little-endian numbers of ``width`` bytes.

    Plain runs are lower-cased and cut into pieces by the file's own pattern, and each different piece goes to the
    library's merging alone; all other runs, and all runs of a file of another layout, go to the whole library. A task
    has one core, so the library's own threads would only wait for each other.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        self.added = re.compile("|".join(re.escape(x["content"]) for x in data["added_tokens"]) or r"(?!)")
        self.cut = self._pattern(data)
        self.symbols = byte_symbols()
        self.runs: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    @staticmethod
    def _pattern(data: dict) -> regex.Pattern | None:
        """The pattern of a lower-casing file that splits by it and maps bytes to symbols; None for other files."""
        steps = [x["type"] for x in (data.get("normalizer") or {}).get("normalizers", [])]
        cuts = (data.get("pre_tokenizer") or {}).get("pretokenizers", [])
        plain_added = all(not (x["normalized"] or x["lstrip"] or x["rstrip"]) for x in data["added_tokens"])
        if steps != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in cuts] != ["Split", "ByteLevel"] or not plain_added:
            return None
        split, symbols = cuts
        if split["behavior"] != "Removed" or not split["invert"] or symbols["add_prefix_space"] or symbols["use_regex"]:
            return None
        return regex.compile(split["pattern"]["Regex"])

    def _bytes(self, ids: list[list[int]]) -> list[bytes]:
        flat = np.fromiter(chain.from_iterable(ids), f"<u{self.width}").tobytes()
        stops = np.cumsum([len(x) * self.width for x in ids], dtype=np.int64).tolist()
        return [flat[a:b] for a, b in zip([0, *stops], stops)]

    def _plain(self, texts: list[str]) -> list[bytes]:
        find, merge, known = self.cut.findall, self.tokenizer.model.tokenize, self.pieces
        parts = [[low] if (low := t.lower()).isalpha() else find(low) for t in texts]
        new = list({p for part in parts for p in part if p not in known})
        spelt = [p if p.isascii() else p.encode("utf-8").decode("latin-1").translate(self.symbols) for p in new]
        known.update(zip(new, self._bytes([[t.id for t in merge(s)] for s in spelt])))
        return [b"".join([known[p] for p in part]) for part in parts]

    def learn(self, runs: list[bytes], memory: int) -> None:
        """Encodes runs that are not known; ``memory`` bounds the pieces kept."""
        for at in range(0, len(runs), 4096):
            if len(self.pieces) > memory:
                self.pieces.clear()
            part = runs[at : at + 4096]
            texts = [w.decode("utf-8") for w in part]
            plain = [bool(self.cut and PLAIN.fullmatch(t) and not self.added.search(t)) for t in texts]
            self.runs.update(zip(compress(part, plain), self._plain(list(compress(texts, plain)))))
            other = [not x for x in plain]
            codes = self.tokenizer.encode_batch_fast(list(compress(texts, other)), add_special_tokens=False)
            self.runs.update(zip(compress(part, other), self._bytes([e.ids for e in codes])))


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_column(texts: pa.Array, path: str, memory: int = 500_000) -> tuple[list[memoryview], int]:
    """Ids of each text as bytes, and the bytes of an id. ``memory`` bounds the remembered runs of a worker."""
    encoder = _encoder(path)
    known = encoder.runs
    runs, places, bounds = distinct_runs(texts)
    if len(known) > memory:
        known.clear()
    encoder.learn([w for w in runs if w not in known], memory)
    data, ends = gather([known[w] for w in runs], places, bounds)
    stops = ends.tolist()
    return [data[x:y] for x, y in zip(stops, stops[1:])], encoder.width


def encode_texts(texts: list[str | None], path: str) -> tuple[list[bytes], int]:
    found, width = encode_column(pa.array(texts, pa.large_string()), path)
    return [bytes(x) for x in found], width


def _block(part: int, number: int, begin: int, keys: list, ids: list[memoryview | bytes], width: int) -> pa.RecordBatch:
    """``ids`` are those of each text followed by its end."""
    ends = np.cumsum([len(x) // width + 1 for x in ids[::2]])
    packed = EliasFano.encode(ends)
    row = {
        "part": part,
        "block": number,
        "begin": begin,
        "n_tokens": int(ends[-1]),
        "keys": keys,
        "width": width,
        "ids": b"".join(ids),
        "low_bits": packed.low_bits,
        "lower": packed.lower,
        "upper": packed.upper,
        "samples": packed.samples,
    }
    return pa.RecordBatch.from_pylist([row], BLOCK)


def _write(batches: Iterator[pa.RecordBatch], path: str, end_id: int, size: int) -> Iterator[pa.RecordBatch]:
    part, number, begin = TaskContext.get().partitionId(), 0, 0
    keys, ids, held, width = [], [], 0, 2
    for batch in blocks(batches, "text", 4 << 20):
        codes, width = encode_column(batch.column("text"), path)
        end = end_id.to_bytes(width, "little")
        for key, code in zip(batch.column(0).to_pylist(), codes):
            keys.append(key)
            ids += code, end
            held += len(code) // width + 1
            if held >= size:
                yield _block(part, number, begin, keys, ids, width)
                number, begin, keys, ids, held = number + 1, begin + held, [], [], 0
    if ids:
        yield _block(part, number, begin, keys, ids, width)


def write_tokens(
    docs: DataFrame, location: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2, size: int = 1 << 20
) -> None:
    """Writes the ids of all texts in ascending order of ``key``; ``tokenizer`` is the path of the vocabulary file."""
    ordered = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    ordered = ordered.repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions("key")
    ordered.mapInArrow(lambda x: _write(x, tokenizer, end_id, size), BLOCK_DDL).write.parquet(location)


def _packed(row: dict) -> tuple[EliasFano, np.ndarray]:
    """The ends and the ids of a block."""
    ends = EliasFano(len(row["keys"]), row["low_bits"], row["lower"], row["upper"], row["samples"])
    return ends, np.frombuffer(row["ids"], f"<u{row['width']}")


def _read(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            packed, all_ids = _packed(row)
            before = 0
            for first in range(0, packed.count, STRETCH):
                stop = min(first + STRETCH, packed.count)
                ends = packed.stretch(first, stop)
                starts = np.concatenate([[before], ends[:-1]])
                ids = all_ids[before : int(ends[-1])].astype("<u4")
                sums = [zlib.crc32(ids[a:b]) for a, b in zip((starts - before).tolist(), (ends - before).tolist())]
                before = int(ends[-1])
                columns = [
                    pa.array(row["keys"][first:stop], pa.int64()),
                    pa.array(starts + row["offset"] + row["begin"]),
                    pa.array(ends - starts),
                    pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)


def _fetch(batches: Iterator[pa.RecordBatch], wanted: set[int | None], names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            packed, ids = _packed(row)
            places = [i for i, key in enumerate(row["keys"]) if key in wanted]
            cut = [ids[packed.select(i - 1) if i else 0 : packed.select(i)].astype(np.int64) for i in places]
            keys = pa.array([row["keys"][i] for i in places], pa.int64())
            yield pa.RecordBatch.from_arrays([keys, pa.array(cut, pa.list_(pa.int64()))], names=names)


def fetch_tokens(spark, location: str, keys: list[int | None], key: str = "doc_id") -> DataFrame:
    """(key, ids) of the documents of some keys: blocks that hold none are left out, and in the others two selects give each."""
    written = spark.read.schema(BLOCK_DDL).parquet(location)
    values = F.array(*[F.lit(k).cast("bigint") for k in keys if k is not None]).cast("array<bigint>")
    has = F.arrays_overlap("keys", values) if None not in keys else F.exists("keys", lambda k: k.isNull()) | F.arrays_overlap("keys", values)
    wanted = set(keys)
    return written.where(F.coalesce(has, F.lit(False))).mapInArrow(
        lambda x: _fetch(x, wanted, [key, "ids"]), f"`{key}` bigint, ids array<bigint>"
    )


def read_tokens(spark, location: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the files alone."""
    written = spark.read.schema(BLOCK_DDL).parquet(location)
    totals = written.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    ends = np.cumsum([row.n for row in totals]).tolist()
    offsets = [(row.part, end - row.n) for row, end in zip(totals, ends)]
    parts = spark.createDataFrame(offsets, "part int, offset bigint")
    placed = written.join(F.broadcast(parts), "part")
    names = [key, "start", "n_tokens", "ids_crc32"]
    return placed.mapInArrow(
        lambda x: _read(x, names), f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
