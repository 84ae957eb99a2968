"""Language-model scoring with a weighted backoff automaton, whose n-grams are all those seen twice or more.

Model: a word has (c + 0.5) / (N + 0.5 (V + 1)). A pair or triple is kept from ``LEAST`` occurrences on, at every corpus
size, and has (c - discount) / c(context); what the kept ones of a context leave is given to all other words in
proportion to the shorter context. The count of every word is exact, however rare it is.

Exchange: texts are cut into blocks of bounded size and read once; a block is then one row, its different words and their
numbers in the order of the texts. A block sends the sorted hashes of its different n-grams, with its own counts, to
buckets of the hash range, one packed row for each bucket that gets any, so never more rows than n-grams. A bucket adds
the counts up and answers in the order of the block's own hashes, so no hash travels back: totals of words, and of longer
n-grams which are kept and their totals. Words and pairs go first; only triples of two kept pairs can be kept, so no
others are sent. The first block of a kept n-gram adds it to the sums of its context, all whole numbers; a last exchange
of contexts adds these up, and every block makes the backoff weights of them. Both blocks and buckets are bounded, their number grows with the texts,
nothing is broadcast, and a hot n-gram gives one value for each block.

Automaton: each block builds the part of the automaton that its texts can reach, with the weights of the whole corpus.
States are the empty context, words and kept pairs; arcs consume a word, failure arcs go to the next shorter context and
carry its backoff weight. All texts of a block are read from left to right in step, each with its state and its sum: a
text takes failure arcs until its state has an arc for the next word, and then that arc. Two words lead from any state to
the same state, so long texts are cut into stretches that begin two words early, without a change of the path.

Defined results: a null text is empty and has the end token only; without training texts every token has probability
one; a null ``doc_id`` counts as empty text when texts are divided; repeated rows are all counted and scored; further
columns are ignored. Words and n-grams are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.staging import release, stage
from logweir.llm.words import blocks, hash_words, split_words

#: Occurrences from which on a pair or triple is kept; bytes of text of a block and, at most, of a bucket; least buckets.
LEAST = 2
BLOCK, BUCKET, BUCKETS = 8 << 20, 24 << 20, 128
#: Bytes of a row group of the staged blocks: a reader holds a few blocks at a time.
ROW_GROUP = 16 << 20
#: Mark of packed counts that are compressed.
COMPRESSED = 128
#: What stands for the begin and the end of a text among the hashes of words, and what joins hashes.
BEGIN, END = np.uint64(0xB5026F5AA96619E9), np.uint64(0x5851F42D4C957F2D)
JOIN, JOIN_PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)

SENT = "block bigint, kind int, bucket int, size int, keys binary, data binary"
ANSWER = "block bigint, kind int, bucket int, kept binary, data binary, own binary, more binary, tokens bigint, types bigint"
BLOCK_PARTS = ["block", "size", "trained", "words", "line"]
#: Words of a text that are read in one stretch, and words after which the state no longer depends on the earlier ones.
STRETCH, SETTLED = 256, 2


@dataclass
class Grams:
    """Different n-grams of one length, sorted; ``place`` has the n-gram of each position ``at``."""

    keys: np.ndarray
    first: np.ndarray
    place: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, at: np.ndarray) -> Grams:
        values, first, place = np.unique(keys, return_index=True, return_inverse=True)
        return cls(values, at[first], place.astype(np.int32), at)

    def everywhere(self, size: int) -> np.ndarray:
        """The n-gram that ends at each place of the line, -1 where none does."""
        out = np.full(size, -1, np.int32)
        out[self.at] = self.place
        return out


class Line:
    """Begin, words and end of all texts of a block in a row, and the n-grams that end at each of them."""

    def __init__(self, block: dict) -> None:
        keys, place = _unpack_line(block["words"], block["size"], block["line"])
        self.words = Grams(keys, place, place, np.arange(len(place), dtype=np.int32))
        self.line = keys[place]
        self.inner = self.line != BEGIN
        self.starts = np.flatnonzero(~self.inner)
        self.texts = len(self.starts)
        self.counts = np.diff(self.starts, append=len(place)) - 2
        self.text = np.repeat(np.arange(self.texts, dtype=np.int32), self.counts + 2)
        self.trained = np.unpackbits(np.frombuffer(block["trained"], np.uint8), count=self.texts).astype(bool)[self.text]

    @cached_property
    def pairs(self) -> Grams:
        at = np.flatnonzero(self.inner).astype(np.int32)
        return Grams.of(self.line[at - 1] * JOIN + self.line[at], at)

    def triples(self, kept: np.ndarray) -> Grams:
        """Triples whose two pairs are ``kept``, which tells it of the pair that ends at each place."""
        at = np.flatnonzero(self.inner & kept).astype(np.int32)
        at = at[self.inner[at - 1] & kept[at - 1]]
        line = self.line
        return Grams.of((line[at - 2] * JOIN + line[at - 1]) * JOIN_PAIR + line[at], at)


def _hash_line(texts: pa.Array) -> np.ndarray:
    words = split_words(texts, lower=True)
    size = len(words.bounds) - 1
    line = np.empty(len(words.start) + 2 * size, np.uint64)
    line[words.bounds[:-1] + 2 * np.arange(size)] = BEGIN
    line[words.bounds[1:] + 2 * np.arange(size) + 1] = END
    line[np.arange(len(words.start)) + 2 * words.documents() + 1] = hash_words(words)
    return line


def _pack_line(line: np.ndarray) -> tuple[bytes, bytes]:
    """Different hashes, the most frequent first, and the line as their numbers, all low bytes first, compressed."""
    keys, place, counts = np.unique(line, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(keys), "<u4")
    rank[order] = np.arange(len(keys))
    planes = np.ascontiguousarray(rank[place].view(np.uint8).reshape(-1, 4).T)
    return keys[order].tobytes(), pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _unpack_line(words: bytes, size: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes, and the line as their numbers."""
    keys = np.frombuffer(words, np.uint64)
    planes = np.frombuffer(pa.decompress(data, 4 * size, "zstd", asbytes=True), np.uint8).reshape(4, -1)
    order = np.argsort(keys)
    rank = np.empty(len(keys), np.int32)
    rank[order] = np.arange(len(keys), dtype=np.int32)
    return keys[order], rank[np.ascontiguousarray(planes.T).view("<u4")[:, 0]]


def _parts(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, begin, end) of each bucket that has some of the sorted hashes."""
    if len(keys) == 0:
        return []
    of = np.minimum(keys // np.uint64(2**64 // buckets), np.uint64(buckets - 1)).astype(np.int64)
    begin = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1])
    return list(zip(of[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(keys)]))


def _pack_keys(keys: np.ndarray, bucket: int, buckets: int) -> tuple[int, bytes]:
    """Number of sorted hashes of a bucket, and the gaps between them in as few bytes each as the largest needs."""
    gaps = np.diff(keys, prepend=np.uint64(bucket * (2**64 // buckets)))
    width = max(1, -(-int(gaps.max()).bit_length() // 8))
    return len(keys), np.ascontiguousarray(gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpack_keys(size: int, data: bytes, bucket: int, buckets: int) -> np.ndarray:
    wide = np.zeros((size, 8), np.uint8)
    wide[:, : len(data) // size] = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.cumsum(wide.view("<u8")[:, 0], dtype=np.uint64) + np.uint64(bucket * (2**64 // buckets))


def _packed(counts: np.ndarray) -> bytes:
    """Number of bytes that the largest count needs, then all low bytes first, compressed where that is shorter."""
    width = max(1, -(-int(counts.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(counts.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    small = pa.compress(planes, "zstd", asbytes=True)
    return bytes([width | COMPRESSED]) + small if len(small) < len(planes) else bytes([width]) + planes


def _unpacked(data: bytes, size: int) -> np.ndarray:
    width, planes = data[0] & ~COMPRESSED, data[1:]
    if data[0] & COMPRESSED:
        planes = pa.decompress(planes, width * size, "zstd", asbytes=True)
    wide = np.zeros((size, 8), np.uint8)
    wide[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, size).T
    return wide.view("<i8")[:, 0]


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.table({name: pa.array(list(c), kind) for (name, kind), c in zip(fields, columns)}, pa.schema(fields))


def _sent(block: int, kind: int, keys: np.ndarray, buckets: int, pack) -> list[tuple]:
    """One row for each bucket that has some of the sorted hashes; ``pack`` gives its data from the part of them."""
    return [
        (block, kind, bucket, *_pack_keys(keys[a:b], bucket, buckets), pack(a, b)) for bucket, a, b in _parts(keys, buckets)
    ]


def _send_grams(block: int, line: Line, buckets: int, kinds: list[tuple[int, Grams]]) -> pa.Table:
    rows = []
    for kind, grams in kinds:
        counts = np.bincount(grams.place[line.trained[grams.at]], minlength=len(grams.keys))
        rows += _sent(block, kind, grams.keys, buckets, lambda a, b: _packed(counts[a:b]))
    return _table(rows, SENT)


@dataclass
class Bucket:
    """The hashes of all blocks in one bucket: ``order`` sorts them, blocks in their order, ``begin`` starts equal ones."""

    rows: list[dict]
    sizes: list[int]
    order: np.ndarray
    begin: np.ndarray
    group: np.ndarray
    keys: np.ndarray

    @classmethod
    def of(cls, sent: pa.Table, buckets: int) -> Bucket:
        rows = sent.sort_by("block").to_pylist()
        keys = np.concatenate([_unpack_keys(r["size"], r.pop("keys"), r["bucket"], buckets) for r in rows])
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        begin = np.flatnonzero(new)
        return cls(rows, [r["size"] for r in rows], order, begin, np.cumsum(new) - 1, keys[begin])

    def back(self, values: np.ndarray) -> list[np.ndarray]:
        """One value for each different hash, dealt to the blocks in the order in which they sent the hashes."""
        out = np.empty((len(self.order), *values.shape[1:]), values.dtype)
        out[self.order] = values[self.group]
        return np.split(out, np.cumsum(self.sizes)[:-1])


def _answer_counts(sent: pa.Table, buckets: int) -> pa.Table:
    """Totals of words; which longer n-grams are kept, their totals, and which of those a block is the first to have."""
    bucket = Bucket.of(sent, buckets)
    counts = np.concatenate([_unpacked(r["data"], n) for r, n in zip(bucket.rows, bucket.sizes)])
    sums = np.add.reduceat(counts[bucket.order], bucket.begin)
    own = np.zeros(len(counts), bool)
    own[bucket.order[bucket.begin]] = True
    owned, rows = np.split(own, np.cumsum(bucket.sizes)[:-1]), []
    if bucket.rows[0]["kind"] == 1:
        word = bucket.keys != BEGIN
        found = int(sums[word].sum()), int((sums[word] > 0).sum())
        for row, total in zip(bucket.rows, bucket.back(sums)):
            rows.append((row["block"], 1, row["bucket"], None, _packed(total), None, None, *found))
            found = 0, 0
        return _table(rows, ANSWER)
    for row, total, first in zip(bucket.rows, bucket.back(sums), owned):
        kept = total >= LEAST
        if kept.any():
            bits = (np.packbits(x).tobytes() for x in (kept, first[kept]))
            rows.append((row["block"], row["kind"], row["bucket"], next(bits), _packed(total[kept]), next(bits), None, 0, 0))
    return _table(rows, ANSWER)


class Known:
    """A block with the totals of its words and pairs, and then of the triples whose pairs are kept."""

    def __init__(self, block: dict, answers: pa.Table, buckets: int) -> None:
        self.line = Line(block)
        self.rows = {(r["kind"], r["bucket"]): r for r in answers.to_pylist()}
        self.buckets = buckets
        words, pairs = self.line.words, self.line.pairs
        size = len(self.line.line)
        self.word, self.pair = words.everywhere(size), pairs.everywhere(size)
        self.words, _ = self._totals(1, words.keys)
        self.pairs, self.own_pairs = self._totals(2, pairs.keys)
        self.grams = self.line.triples((self.pair >= 0) & (self.pairs[self.pair] > 0))

    def with_triples(self) -> Known:
        self.triples, self.own_triples = self._totals(3, self.grams.keys)
        return self

    def weigh(self, mass: float, discount: float) -> Known:
        """Probabilities of all words and of kept pairs and triples, and the weights of their contexts."""
        pairs, triples = self.line.pairs, self.grams
        self.single = (self.words + 0.5) / mass
        before = self.words[self.word[pairs.first - 1]]
        self.pair_p = np.where(self.pairs > 0, self.pairs - discount, 0) / np.maximum(before, 1)
        before = self.pairs[self.pair[triples.first - 1]]
        self.triple_p = np.where(self.triples > 0, self.triples - discount, 0) / np.maximum(before, 1)

        kept = np.flatnonzero(self.pairs > 0)
        common = np.flatnonzero(self.words >= LEAST)
        types, own, shorter = self._sums(11, self.line.words.keys[common])
        self.word_weight = np.zeros(len(self.words))
        self.word_weight[common] = _weight(own - discount * types, self.words[common], shorter + 0.5 * types, mass)
        types, own, shorter = self._sums(12, pairs.keys[kept])
        last = self.words[self.word[pairs.first[kept]]]
        self.pair_weight = _weight(own - discount * types, self.pairs[kept], shorter - discount * types, last)
        return self

    def _totals(self, kind: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        total, own = np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        for bucket, a, b in _parts(keys, self.buckets):
            row = self.rows.get((kind, bucket))
            if kind == 1:
                total[a:b] = _unpacked(row["data"], b - a)
            elif row is not None:  # else no n-gram is kept
                kept = a + np.flatnonzero(np.unpackbits(np.frombuffer(row["kept"], np.uint8), count=b - a))
                total[kept] = _unpacked(row["data"], len(kept))
                own[kept] = np.unpackbits(np.frombuffer(row["own"], np.uint8), count=len(kept))
        return total, own

    def contexts(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, hashes, sums) of contexts. Of this block's own kept n-grams, the sums have for each context: how many
        go on after it, their counts, and the counts of the n-grams that the shorter context has in their place."""
        words, pairs, triples = self.line.words, self.line.pairs, self.grams

        def sums(context: np.ndarray, size: int, counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
            order = np.argsort(context, kind="stable")
            context, values = context[order], np.stack([np.ones_like(counts), counts, shorter], axis=1)[order]
            out = np.zeros((size, 3), np.int64)
            begin = np.flatnonzero(np.diff(context, prepend=-1))
            if len(begin):
                out[context[begin]] = np.add.reduceat(values, begin, axis=0)
            return out

        own = np.flatnonzero(self.own_pairs & (self.pairs > 0))
        at = pairs.first[own]
        after_word = sums(self.word[at - 1], len(words.keys), self.pairs[own], self.words[self.word[at]])
        own = np.flatnonzero(self.own_triples & (self.triples > 0))
        at = triples.first[own]
        after_pair = sums(self.pair[at - 1], len(pairs.keys), self.triples[own], self.pairs[self.pair[at]])
        kept = self.pairs > 0
        common = self.words >= LEAST
        return [(11, words.keys[common], after_word[common]), (12, pairs.keys[kept], after_pair[kept])]

    def _sums(self, kind: int, keys: np.ndarray) -> np.ndarray:
        out = np.zeros((3, len(keys)), np.int64)
        for bucket, a, b in _parts(keys, self.buckets):
            row = self.rows.get((kind, bucket))
            if row is not None:  # else no kept n-gram goes on after any of them
                some = a + np.flatnonzero(np.unpackbits(np.frombuffer(row["kept"], np.uint8), count=b - a))
                out[:, some] = [_unpacked(row[c], len(some)) for c in ("own", "data", "more")]
        return out

    def automaton(self) -> Automaton:
        """States: 0 the empty context, 1 + w word w, then the kept pairs in their order."""
        words, pairs, triples = self.line.words, self.line.pairs, self.grams
        kept = np.flatnonzero(self.pairs > 0)
        state = np.zeros(len(pairs.keys), np.int64)
        state[kept] = 1 + len(words.keys) + np.arange(len(kept))
        at = pairs.first[kept]
        longest = np.flatnonzero(self.triples > 0)
        end = triples.first[longest]
        source = np.concatenate([1 + self.word[at - 1], state[self.pair[end - 1]]])
        word = np.concatenate([self.word[at], self.word[end]])
        target = np.concatenate([state[kept], state[self.pair[end]]])
        weight = np.log10(np.concatenate([self.pair_p[kept], self.triple_p[longest]]))
        key = source.astype(np.int64) * len(words.keys) + word
        order = np.argsort(key)
        return Automaton(
            single=np.log10(self.single),
            keys=key[order],
            target=target[order],
            weight=weight[order],
            failure=np.concatenate([np.zeros(1 + len(words.keys), np.int64), 1 + self.word[at]]),
            backoff=np.concatenate([[0.0], self.word_weight, self.pair_weight]),
        )

    def scores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """n_known, base score and score of each text."""
        line = self.line
        known = (self.words > 0)[self.word] & line.inner
        single = np.where(line.inner, np.log10(self.single)[self.word], 0)

        def sums(x: np.ndarray) -> np.ndarray:
            return np.bincount(line.text, x, line.texts)

        return sums(known).astype(np.int64), sums(single), self.automaton().read(line)


@dataclass
class Automaton:
    """Arcs sorted by (source, word) of all states but the empty one, which has an arc for each word to that word's state."""

    single: np.ndarray
    keys: np.ndarray
    target: np.ndarray
    weight: np.ndarray
    failure: np.ndarray
    backoff: np.ndarray

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State after the next word, and log probability of the way there, for many texts."""
        after, gained = np.empty_like(state), np.zeros(len(state))
        open_ = np.arange(len(state))
        while len(open_):
            here, next_word = state[open_], word[open_]
            root = here == 0
            done = open_[root]
            after[done] = 1 + next_word[root]
            gained[done] += self.single[next_word[root]]
            open_, here, next_word = open_[~root], here[~root], next_word[~root]
            key = here * len(self.single) + next_word
            arc = np.searchsorted(self.keys, key)
            has = arc < len(self.keys)
            has[has] = self.keys[arc[has]] == key[has]
            after[open_[has]] = self.target[arc[has]]
            gained[open_[has]] += self.weight[arc[has]]
            open_, here = open_[~has], here[~has]
            gained[open_] += self.backoff[here]
            state = state.copy()
            state[open_] = self.failure[here]
        return after, gained

    def read(self, line: Line) -> np.ndarray:
        """Log probability of each text, without its begin."""
        words, pieces = line.words.place, -(-(line.counts + 1) // STRETCH)
        text = np.repeat(np.arange(line.texts), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = line.starts[text] + 1 + nth * STRETCH
        size = np.minimum(STRETCH, line.starts[text] + line.counts[text] + 2 - begin)
        order = np.argsort(-size, kind="stable")
        text, begin, size = text[order], begin[order], size[order]
        state, total = np.zeros(len(text), np.int64), np.zeros(len(text))
        for at in range(-SETTLED, STRETCH):
            active = np.searchsorted(-size, -at, "left") if at > 0 else len(text)  # stretches with more than ``at`` words
            if active == 0:
                break
            some = np.arange(active) if at >= 0 else np.flatnonzero(begin + at >= line.starts[text])
            state[some], gained = self.step(state[some], words[begin[some] + at])
            if at >= 0:
                total[some] += gained
        return np.bincount(text, total, line.texts)


def _weight(own: np.ndarray, context: np.ndarray, shorter: np.ndarray, shorter_context: np.ndarray | float) -> np.ndarray:
    """log10 of what the kept n-grams of a context leave, over what their shorter ones leave of the shorter context."""
    left, left_shorter = (1 - part / np.maximum(whole, 1e-300) for part, whole in ((own, context), (shorter, shorter_context)))
    return np.where(own > 0, np.log10(np.maximum(left, 1e-12)) - np.log10(np.maximum(left_shorter, 1e-12)), 0.0)


def _send_contexts(known: Known, block: int) -> pa.Table:
    """The data has a bit for each context that has sums, the sizes of the three packed sums, and these."""
    rows = []

    def pack(a: int, b: int) -> bytes:
        some = sums[a:b, 0] > 0
        parts = [_packed(x) for x in sums[a:b][some].T]
        return np.packbits(some).tobytes() + np.array([len(x) for x in parts], "<u4").tobytes() + b"".join(parts)

    for kind, keys, sums in known.contexts():
        rows += _sent(block, kind, keys, known.buckets, pack)
    return _table(rows, SENT)


def _unpack_sums(data: bytes, size: int) -> np.ndarray:
    bits, out = -(-size // 8), np.zeros((size, 3), np.int64)
    some = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, bits), count=size))
    ends = np.cumsum([bits + 12, *np.frombuffer(data, "<u4", 3, bits).tolist()])
    for n in range(3):
        out[some, n] = _unpacked(data[ends[n] : ends[n + 1]], len(some))
    return out


def _answer_contexts(sent: pa.Table, buckets: int) -> pa.Table:
    """Sums of all blocks for the contexts that have any: how many n-grams, their counts, counts of the shorter ones."""
    bucket = Bucket.of(sent, buckets)
    sums = np.concatenate([_unpack_sums(r["data"], n) for r, n in zip(bucket.rows, bucket.sizes)])
    sums, rows = np.add.reduceat(sums[bucket.order], bucket.begin, axis=0), []
    for row, part in zip(bucket.rows, bucket.back(sums)):
        some = part[:, 0] > 0
        if some.any():
            types, own, shorter = (_packed(x) for x in part[some].T)
            bits = np.packbits(some).tobytes()
            rows.append((row["block"], row["kind"], row["bucket"], bits, own, types, shorter, 0, 0))
    return _table(rows, ANSWER)


def _in_blocks(batches: Iterator[pa.RecordBatch], passed: list[str]) -> Iterator[pa.RecordBatch]:
    """One row for each block: the lists of the passed columns, bits of training texts, words and line."""
    task = TaskContext.get().partitionId()
    for n, batch in enumerate(blocks(batches, size=BLOCK)):
        line = _hash_line(batch.column("text"))
        words, packed = _pack_line(line)
        trained = np.packbits(batch.column("trained").to_numpy(zero_copy_only=False).astype(bool)).tobytes()
        lists = [pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column(c)) for c in passed]
        block = [[task << 32 | n], [len(line)], [trained], [words], [packed]]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays(
            [*lists, *map(pa.array, block, kinds)], names=[*passed, *BLOCK_PARTS]
        )


def _words_and_pairs(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for n in range(batch.num_rows):
            block = batch.slice(n, 1).to_pylist()[0]
            line = Line(block)
            yield from _send_grams(block["block"], line, buckets, [(1, line.words), (2, line.pairs)]).to_batches()


def score(
    docs: DataFrame, trained: Column, passed: list[str], text: str = "text", discount: float = 0.75
) -> tuple[DataFrame, int]:
    """``passed`` columns, n_tokens, n_known, base_score and score of every row by the model of the ``trained`` rows.

    The second value is the number of training tokens.
    """
    spark = docs.sparkSession
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in passed)
    named = [f"p{i}" for i in range(len(passed))]
    source = docs.select(*(F.col(c).alias(n) for n, c in zip(named, passed)), F.col(text).alias("text"), trained.alias("trained"))
    lists = ", ".join(f"{n} array<{docs.schema[c].dataType.simpleString()}>" for n, c in zip(named, passed))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    buckets = max(BUCKETS, -(-size // BUCKET))
    whole = stage(
        source.mapInArrow(lambda x: _in_blocks(x, named), f"{lists}, block bigint, size bigint, trained binary, words binary, line binary"),
        row_group=ROW_GROUP,
    )

    def first(table: pa.Table) -> dict:
        return table.select(BLOCK_PARTS).to_pylist()[0]

    def triples(left: pa.Table, right: pa.Table) -> pa.Table:
        known = Known(first(left), right, buckets)
        return _send_grams(left.column("block")[0].as_py(), known.line, buckets, [(3, known.grams)])

    def contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        known = Known(first(left), right, buckets).with_triples()
        return _send_contexts(known, left.column("block")[0].as_py())

    def answered(sent: DataFrame, answer) -> DataFrame:
        found = stage(sent.groupBy("kind", "bucket").applyInArrow(lambda t: answer(t, buckets), ANSWER))
        del sent
        release(spark)
        return found

    lines = whole.select(*BLOCK_PARTS)
    counts = answered(lines.mapInArrow(lambda x: _words_and_pairs(x, buckets), SENT), _answer_counts)
    totals = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    tokens, mass = totals[0], totals[0] + 0.5 * (totals[1] + 1)
    by_block = lines.groupBy("block").cogroup(counts.groupBy("block"))
    counts = counts.unionByName(answered(by_block.applyInArrow(triples, SENT), _answer_counts))
    by_block = lines.groupBy("block").cogroup(counts.groupBy("block"))
    weights = answered(by_block.applyInArrow(contexts, SENT), _answer_contexts)

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        known = Known(first(left), right, buckets).with_triples().weigh(mass, discount)
        columns = [left.column(n).combine_chunks().flatten() for n in named] + [pa.array(known.line.counts + 1), *map(pa.array, known.scores())]
        return pa.table(columns, names=[*passed, "n_tokens", "n_known", "base_score", "score"])

    answers = counts.unionByName(weights).groupBy("block")
    found = whole.groupBy("block").cogroup(answers).applyInArrow(
        scored, f"{kinds}, n_tokens bigint, n_known bigint, base_score double, score double"
    )
    return found, tokens


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the key as text leaves ``part`` modulo ``parts``; a null key is empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts == part
