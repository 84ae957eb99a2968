"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Besides a weight for each feature, every pair of features has a low-rank weight ``<v_i, v_j>``. The sum over all pairs is
half of (square of the sum minus sum of the squares) of each factor, so a text is scored in time linear in its words.

Features: words hashed to ``BUCKETS`` numbers with damped counts of unit length, structure statistics of the text, and
the length that the metadata states. Fitting uses at most ``rows_per_class`` labelled texts of each class.

Defined results: null and empty texts have no words and all statistics zero; a null stated length is marked as missing;
without both classes in training every score is the share of label 1 (1 without labels, so that nothing is rejected);
repeated rows repeat their score; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.fitting import sigmoid, training_sample
from logweir.llm.words import blocks, hash_words, split_words, text_buffer

#: Buckets of words, rank of the pair weights.
BUCKETS, RANK = 1 << 12, 6

#: Bytes of text whose words a task holds at once while it scores; their arrays take some thirty times as much.
SCORED = 1 << 20

_CLASSES = {
    "digit": list(b"0123456789"),
    "upper": list(range(65, 91)),
    "sign": list(b"#$%&*+/<=>@[]^_`{|}~\\"),
    "stop": list(b".!?"),
    "comma": list(b",;:"),
    "bar": list(b"|"),
    "break": list(b"\n"),
    "wide": list(range(128, 256)),
}


@dataclass
class Features:
    """Sparse word features (text, bucket, value), sorted by text, and the dense ones, one row a text."""

    text: np.ndarray
    bucket: np.ndarray
    value: np.ndarray
    dense: np.ndarray


def extract(texts: pa.Array, stated: pa.Array) -> Features:
    count = len(texts)
    data, offsets = text_buffer(texts)
    words = split_words(texts)
    hashes = hash_words(words)
    docs, per = words.documents(), words.counts()
    some, size = np.maximum(per, 1), np.maximum(np.diff(offsets), 1)
    length = words.end - words.start

    def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        return np.diff(total[bounds])

    order = np.lexsort((hashes, docs))
    h, d = hashes[order], docs[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(h)))
    owner = d[first]
    most = np.zeros(count, np.int64)
    np.maximum.at(most, owner, times)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (docs[1:] == docs[:-1])
    columns = [
        np.log1p(per),
        sums(length, words.bounds) / some,
        np.bincount(owner, minlength=count) / some,
        most / some,
        sums(again, words.bounds) / some,
        sums(length > 15, words.bounds) / some,
        sums(length == 1, words.bounds) / some,
        np.log1p(np.diff(offsets)),
    ]
    for members in _CLASSES.values():
        table = np.zeros(256, bool)
        table[members] = True
        columns.append(sums(table[data], offsets) / size)
    said = pc.fill_null(stated.cast(pa.float64()), -1).to_numpy(zero_copy_only=False)
    columns += [np.log1p(np.maximum(said, 0)), (said < 0).astype(float)]

    code = owner * BUCKETS + (h[first] % np.uint64(BUCKETS)).astype(np.int64)
    code, back = np.unique(code, return_inverse=True)
    amount = np.bincount(back, np.log1p(times), len(code)) if len(code) else np.zeros(0)
    text = code // BUCKETS
    norm = np.sqrt(np.bincount(text, amount**2, count)) if len(code) else np.ones(count)
    return Features(text, code % BUCKETS, amount / norm[text], np.stack(columns, axis=1))


def extract_rows(texts: list[str | None], stated: list[int | None], size: int = 1 << 18) -> Features:
    """Features of texts in the driver, read by blocks of ``size`` bytes: what all words take at once would be many times the texts."""
    whole = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(stated, pa.int64())], names=["text", "stated"])
    parts, at = [], 0
    for block in blocks([whole], size=size):
        x = extract(block.column(0), block.column(1))
        parts.append((x.text + at, x.bucket, x.value, x.dense))
        at += block.num_rows
    return Features(*(np.concatenate(column) for column in zip(*parts)))


@dataclass
class QualityModel:
    """Weights and factors of the words, then of the dense features, which are standardised and clipped first."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    constant: float | None = None

    def standard(self, dense: np.ndarray) -> np.ndarray:
        return np.clip((dense - self.mean) / self.spread, -4, 4)

    def decisions(self, x: Features) -> np.ndarray:
        """Linear time: the sums over pairs come from sums and squares of each factor."""
        dense = self.standard(x.dense)
        w, v = self.weights[BUCKETS:], self.factors[BUCKETS:]
        total = self.bias + dense @ w
        sums, squares = dense @ v, (dense**2) @ (v**2)
        total += np.bincount(x.text, x.value * self.weights[x.bucket], len(dense))
        for f in range(RANK):
            part = x.value * self.factors[x.bucket, f]
            sums[:, f] += np.bincount(x.text, part, len(dense))
            squares[:, f] += np.bincount(x.text, part**2, len(dense))
        return total + 0.5 * (sums**2 - squares).sum(axis=1)


def fit(
    rows: list[tuple[str | None, int | None, int]], epochs: int = 12, batch: int = 32, rate: float = 0.03, seed: int = 5
) -> QualityModel:
    """Model of (text, stated length, label) rows: logistic loss, mini-batches, step sizes by accumulated squares."""
    labels = np.array([r[2] for r in rows], float)
    size = BUCKETS
    if len(set(labels.tolist())) < 2:
        none = np.zeros(size)
        return QualityModel(0.0, none, none, none, none, float(labels.mean()) if len(labels) else 1.0)
    x = extract_rows([r[0] for r in rows], [r[1] for r in rows])
    mean, spread = x.dense.mean(axis=0), x.dense.std(axis=0) + 1e-6
    dense_count = x.dense.shape[1]
    random = np.random.default_rng(seed)
    weights = np.zeros(size + dense_count)
    factors = random.normal(0, 0.03, (size + dense_count, RANK))
    bias, past = 0.0, [1e-8, np.full(len(weights), 1e-8), np.full(factors.shape, 1e-8)]
    dense = np.clip((x.dense - mean) / spread, -4, 4)
    bounds = np.searchsorted(x.text, np.arange(len(rows) + 1))
    for _ in range(epochs):
        order = random.permutation(len(rows))
        for begin in range(0, len(order), batch):
            own = order[begin : begin + batch]
            at = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in own])
            row = np.repeat(np.arange(len(own)), bounds[own + 1] - bounds[own])
            index = np.concatenate([x.bucket[at], np.tile(np.arange(size, size + dense_count), len(own))])
            value = np.concatenate([x.value[at], dense[own].ravel()])
            row = np.concatenate([row, np.repeat(np.arange(len(own)), dense_count)])
            part = value[:, None] * factors[index]
            sums = np.stack([np.bincount(row, part[:, f], len(own)) for f in range(RANK)], axis=1)
            squares = np.bincount(row, (part**2).sum(axis=1), len(own))
            z = bias + np.bincount(row, value * weights[index], len(own)) + 0.5 * ((sums**2).sum(axis=1) - squares)
            error = (sigmoid(z) - labels[own]) / len(own)
            names, back = np.unique(index, return_inverse=True)
            gw = np.bincount(back, error[row] * value) + 1e-4 * weights[names]
            inner = (error[row] * value)[:, None] * (sums[row] - part)
            gv = np.stack([np.bincount(back, inner[:, f]) for f in range(RANK)], axis=1) + 1e-3 * factors[names]
            past[0] += error.sum() ** 2
            past[1][names] += gw**2
            past[2][names] += gv**2
            bias -= rate * error.sum() / np.sqrt(past[0])
            weights[names] -= rate * gw / np.sqrt(past[1][names])
            factors[names] -= rate * gv / np.sqrt(past[2][names])
    return QualityModel(bias, weights, factors, mean, spread)


def _score(
    batches: Iterator[pa.RecordBatch], shared: Broadcast, passed: list[str], name: str, place: int
) -> Iterator[pa.RecordBatch]:
    """The passed columns come first in each batch, the stated length last; ``place`` is that of the text, passed or not."""
    model: QualityModel = shared.value
    at = len(passed)
    for batch in batches:
        renamed = pa.RecordBatch.from_arrays(batch.columns, names=[f"c{i}" for i in range(batch.num_columns)])
        for block in blocks([renamed], f"c{place}", SCORED):
            if model.constant is None:
                score = sigmoid(model.decisions(extract(block.column(place), block.column(block.num_columns - 1))))
            else:
                score = np.full(block.num_rows, model.constant)
            yield pa.RecordBatch.from_arrays([*block.columns[:at], pa.array(score)], names=[*passed, name])


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    held_out: Column,
    passed: list[str],
    text: str = "text",
    stated: str = "n_chars",
    rows_per_class: int = 1500,
    name: str = "score",
) -> DataFrame:
    """``passed`` columns and the score, as ``name``, of every row of ``docs``, learnt from labels outside ``held_out``."""
    model = fit(training_sample(docs, labels, "quality", held_out, rows_per_class, [text, stated]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in passed)
    place = passed.index(text) if text in passed else len(passed)
    sent = [docs[f"`{c}`"] for c in passed] + ([docs[text]] if place == len(passed) else []) + [docs[stated].cast("bigint")]
    source = docs.select(*[c.alias(f"c{i}") for i, c in enumerate(sent)])
    return source.mapInArrow(lambda x: _score(x, shared, passed, name, place), f"{kinds}, `{name}` double")
