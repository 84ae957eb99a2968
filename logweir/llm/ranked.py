"""Ranked lexical search by NRA: sequential reads of impact-sorted lists, with a score interval for every document.

The score of a document for an item is the sum of the impacts of the item's terms in it; statistics (documents, terms,
document frequencies) are those of all documents. Items are taken in blocks of at most ``block_terms`` term occurrences,
or one longer item; for each block

1. one pass over the documents keeps, for every document, its number of terms and the frequencies of the block's terms;
   equal terms are found by exact comparison, and the result is written to the shared folder;
2. document frequencies are counted in Spark; there are at most as many as the block has terms;
3. every task makes *shards* of at most ``shard`` postings of its documents, or one longer document, sorts each term's
   postings by falling impact, and answers each item by NRA: it reads every list to a common depth, doubles the depth, and
   keeps for every document a lower bound (impacts read) and an upper bound (plus, for every list in which it has not yet
   been met, the impact last read there). Documents whose upper bound is below the k-th best lower bound, of this shard or of
   those that the task has read before, are out. Reading ends when all others have equal bounds: membership, ties
   and scores are then final. In the worst case all lists are read to their end, once;
4. the k best rows of each item and task are ranked by a window, which Spark limits to k a partition before the shuffle.

Documents are never gathered by term, so a term in a third of all documents makes no large group.

Defined results: null and empty texts have no terms; items without terms and documents with score 0 give no rows; rows of
equal ``doc_id`` are documents of their own, rows of equal ``item_id`` items of their own; equal scores are ordered by
``doc_id``, null last; empty tables give an empty result; only the columns named are read, so others cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logweir.llm.staging import stage
from logweir.llm.words import blocks, text_buffer

_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: Depth of the first reads of a list.
FIRST_DEPTH = 1024


def split_terms(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of all texts, A-Z lower-cased, and the bounds of each text's terms."""
    data, offsets = text_buffer(column)
    inside = _TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    starts = np.flatnonzero(first)
    letters = _LOWER[data[inside]]
    ends = np.append(np.cumsum(inside)[starts] - 1, len(letters)).astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)])
    return terms, np.searchsorted(starts, offsets)


def _postings(batches: Iterator[pa.RecordBatch], vocabulary: list[bytes]) -> Iterator[pa.RecordBatch]:
    wanted = pa.array(vocabulary, pa.large_binary())
    for batch in blocks(batches, "text", 8 << 20):
        terms, bounds = split_terms(batch.column("text"))
        n = np.diff(bounds)
        code = pc.fill_null(pc.index_in(terms, value_set=wanted), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        document = np.repeat(np.arange(len(n)), n)
        pair, times = np.unique((document * len(vocabulary) + code)[code >= 0], return_counts=True)
        at = np.searchsorted(pair, np.arange(len(n) + 1) * len(vocabulary)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(v.astype(np.int32))) for v in (pair % len(vocabulary), times)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n.astype(np.int64)), *lists], names=["document", "n", "terms", "times"]
        )


@dataclass(frozen=True)
class Corpus:
    """Documents with terms, all terms, and the weight of each term of the block."""

    documents: int
    terms: int
    weights: np.ndarray

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """The length part of each document's impact, in exact integers however large the corpus is."""
        if len(n) and 25 * int(n.max()) * self.documents >= 2**63:
            n = n.astype(object)
        return (75 + 25 * n * self.documents // max(self.terms, 1)).astype(np.int64)


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


class Shard:
    """Impact-sorted lists of the terms of some documents."""

    def __init__(self, tables: list[pa.RecordBatch], corpus: Corpus):
        table = pa.Table.from_batches(tables).combine_chunks()
        self.keys = table.column("document").combine_chunks()
        self.size = table.num_rows
        order = pc.sort_indices(self.keys, null_placement="at_end").to_numpy()
        self.rank = np.empty(self.size, np.int64)
        self.rank[order] = np.arange(self.size)
        terms, times = (table.column(c).combine_chunks() for c in ("terms", "times"))
        term = terms.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        tf = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        held = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
        document = np.repeat(np.arange(self.size, dtype=np.int32), held)
        m = corpus.lengths(table.column("n").to_numpy())[document]
        impact = corpus.weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m))
        order = np.lexsort((-impact, term))
        self.document, self.impact = document[order], impact[order]
        self.bounds = np.searchsorted(term[order], np.arange(len(corpus.weights) + 1))

    def best(self, item: list[tuple[int, int]], k: int, floor: int) -> list[tuple[int, object]]:
        """The k best (score, key) of an item given as (term, repeats), of those with score ``floor`` or more, by NRA."""
        lists = []
        for term, repeats in item:
            part = slice(self.bounds[term], self.bounds[term + 1])
            if part.start < part.stop and self.impact[part.start] > 0:
                lists.append((self.document[part], self.impact[part] * repeats))
        lower = np.zeros(self.size, np.int64)
        candidates, done, depth = np.arange(self.size), 0, FIRST_DEPTH
        while True:
            last = [int(impact[depth - 1]) if depth < len(impact) else 0 for _, impact in lists]
            met = np.zeros(self.size, np.int64)
            for (document, impact), bound in zip(lists, last):
                lower[document[done:depth]] += impact[done:depth]
                if bound:
                    met[document[:depth]] += bound
            low = lower[candidates]
            if len(low) >= k:
                floor = max(floor, int(np.partition(low, -k)[-k]))
            high = low + (sum(last) - met[candidates])
            stay = high >= max(floor, 1)
            candidates, low, high = candidates[stay], low[stay], high[stay]
            if (low == high).all():
                break
            done, depth = depth, 2 * depth
        order = np.lexsort((self.rank[candidates], -low))[:k]
        return list(zip(low[order].tolist(), self.keys.take(pa.array(candidates[order])).to_pylist()))


def _order(found: tuple[int, object]) -> tuple:
    score, key = found
    return -score, key is None, 0 if key is None else key


def shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    """Pieces of at most ``size`` postings, or one document with more."""
    held, postings = [], 0
    for batch in batches:
        ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
        at = before = 0
        while at < batch.num_rows:
            stop = int(np.searchsorted(ends, before + size - postings, "right"))
            stop = max(stop, at if held else at + 1)
            if stop > at:
                held.append(batch.slice(at, stop - at))
                postings += int(ends[stop - 1]) - before
                at, before = stop, int(ends[stop - 1])
            if at < batch.num_rows:
                yield held
                held, postings = [], 0
    if held:
        yield held


def _search(
    batches: Iterator[pa.RecordBatch], items: dict[int, list[tuple[int, int]]], corpus: Corpus, k: int, size: int
) -> Iterator[pa.RecordBatch]:
    best: dict[int, list[tuple[int, object]]] = {item: [] for item in items}
    kind = pa.null()
    for piece in shards(batches, size):
        shard = Shard(piece, corpus)
        kind = shard.keys.type
        for item, terms in items.items():
            floor = best[item][-1][0] if len(best[item]) == k else 1
            best[item] = sorted([*best[item], *shard.best(terms, k, floor)], key=_order)[:k]
    rows = [(item, key, score) for item, found in best.items() for score, key in found]
    if rows:
        numbers, keys, scores = zip(*rows)
        columns = [pa.array(numbers, pa.int64()), pa.array(keys, kind), pa.array(scores, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "document", "score"])


def item_blocks(rows: Iterator, limit: int) -> Iterator[dict[int, Counter]]:
    """Terms of (item, text) rows, in blocks of at most ``limit`` term occurrences or one longer item."""
    block, held = {}, 0
    for item, text in rows:
        terms, _ = split_terms(pa.array([text], pa.large_string()))
        if block and held + len(terms) > limit:
            yield block
            block, held = {}, 0
        if len(terms):
            block[item] = Counter(terms.to_pylist())
            held += len(terms)
    if block:
        yield block


def _answer(docs: DataFrame, block: dict[int, Counter], k: int, shard: int) -> DataFrame:
    """(item, document, score): the k best of every task for each item of the block."""
    vocabulary = sorted({t for terms in block.values() for t in terms})
    place = {t: i for i, t in enumerate(vocabulary)}
    kind = docs.schema["document"].dataType.simpleString()
    postings = stage(
        docs.mapInArrow(
            lambda x: _postings(x, vocabulary), f"document {kind}, n bigint, terms array<int>, times array<int>"
        )
    )
    total = postings.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("terms")).first()
    counted = postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(vocabulary), np.int64)
    for term, frequency in counted:
        weights[term] = weight(total.documents, frequency)
    corpus = Corpus(total.documents, total.terms or 0, weights)
    items = {item: [(place[t], n) for t, n in sorted(terms.items())] for item, terms in block.items()}
    return postings.where(F.size("terms") > 0).mapInArrow(
        lambda x: _search(x, items, corpus, k, shard), f"item bigint, document {kind}, score bigint"
    )


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    block_terms: int = 1 << 20,
    shard: int = 1 << 22,
) -> DataFrame:
    """(item_key, rank, key, score): the k best documents of every item."""
    spark: SparkSession = docs.sparkSession
    source = docs.select(docs[key].alias("document"), docs[text].alias("text"))
    numbered = stage(
        items.select(items[item_key].alias("name"), items[item_text].alias("text"), F.monotonically_increasing_id().alias("item"))
    )
    found = spark.createDataFrame([], f"item bigint, document {source.schema['document'].dataType.simpleString()}, score bigint")
    for block in item_blocks(numbered.select("item", "text").toLocalIterator(), block_terms):
        found = found.unionByName(_answer(source, block, k, shard))
    best_first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("document"))
    ranked = found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "name"), "item").select(
        F.col("name").alias(item_key), "rank", F.col("document").alias(key), "score"
    )
