"""Toxicity by a support vector machine on a gap-weighted subsequence string kernel with Nystroem landmarks.

Two words are as similar as the triples of letters that both contain in order, where each triple weighs
``decay ** span``: letters put between the ones that matter cost little, so spaced and padded insults stay near the plain
one. Runs of single-letter words are read as one word, too. The kernel is normalised by each word's own length.

Landmarks are words: the ones that tell toxic training texts best, chosen greedily so that each covers texts that the
earlier ones left, and words of clean texts. A word's features are its kernel values with all landmarks, whitened
(Nystroem). Training units are labelled sentences. A sentence of a toxic text need not be toxic itself: the text's witness,
the unit with the highest decision, stands for it and is chosen anew in each round; every sentence of a clean text gives
its own highest unit as a negative example. A text scores by its highest unit, turned into a probability.

The kernel is an inner product of triple weights, so landmarks, whitening and the machine's weights fold into one table
of triples, and scoring takes time in proportion to the letters. Words longer than ``WIDE`` letters are cut into
overlapping stretches that hold every triple of span ``REACH``.

Fitting uses at most ``rows_per_class`` labelled texts of each class. Defined results: null and empty texts have no unit
and score as the least toxic training text; without both classes in training every score is the share of label 1 (0
without labels); repeated rows repeat their score; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame

from logweir.llm.fitting import calibration, newton, training_sample
from logweir.llm.words import blocks, hash_words, split_words, text_buffer

#: Letters of a stretch (with the mark of the word's start), reach of a triple, symbols.
WIDE, REACH, SYMBOLS = 20, 9, 32
#: Digits and signs that stand for letters.
STANDS_FOR = dict(zip("013457@$!|", "oieastasii"))
SENTENCE = re.compile(r"[.!?\n]+")


#: UTF-8 of white space beyond ASCII: first byte, and what may follow it.
_WIDE_SPACES: dict[bytes, list[bytes]] = {}
for _space in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000):
    _bytes = chr(_space).encode()
    _WIDE_SPACES.setdefault(_bytes[:1], []).append(_bytes[1:])


@lru_cache(maxsize=1)
def _symbols() -> dict[str, int]:
    plain = {chr(97 + i): i + 1 for i in range(26)}
    return plain | {c: plain[v] for c, v in STANDS_FOR.items()}


def letters(word: str) -> list[int]:
    """Symbols of a word: 0 marks the start, 1-26 are letters, 27-30 other letters by code point, 31 all else."""
    table = _symbols()
    core = word.lower().strip("\"'.,;:()[]{}<>-_*~`?")
    return [0, *(table.get(c) or (27 + ord(c) % 4 if c.isalnum() else 31) for c in core)]


def stretches(word: str) -> list[list[int]]:
    code = letters(word)
    if len(code) <= WIDE:
        return [code] if len(code) > 1 else []
    step = WIDE - REACH
    return [code[at : at + WIDE] for at in range(0, len(code) - REACH, step)]


@lru_cache(maxsize=WIDE + 1)
def _triples(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    found = [
        (i, j, k) for i in range(length) for j in range(i + 1, length) for k in range(j + 1, min(length, i + REACH + 1))
    ]
    i, j, k = np.array(found, np.int64).reshape(-1, 3).T
    return i, j, k, (k - i + 1).astype(np.float32)


def features(codes: np.ndarray, decay: float) -> tuple[np.ndarray, np.ndarray]:
    """Triple numbers and weights of stretches of one length; equal triples of a stretch are added up and normalised."""
    i, j, k, span = _triples(codes.shape[1])
    numbers = (codes[:, i] * SYMBOLS + codes[:, j]) * SYMBOLS + codes[:, k]
    order = np.argsort(numbers, axis=1, kind="stable")
    numbers = np.take_along_axis(numbers, order, axis=1)
    weights = (decay**span)[order]
    rows, columns = numbers.shape
    if columns == 0:
        return numbers, weights
    new = np.ones((rows, columns), bool)
    new[:, 1:] = numbers[:, 1:] != numbers[:, :-1]
    at = np.flatnonzero(new.ravel())
    sums = np.add.reduceat(weights.ravel(), at)
    total = np.zeros(rows * columns, np.float32)
    total[at] = sums
    total = total.reshape(rows, columns)
    return numbers, total / np.sqrt((total**2).sum(axis=1, keepdims=True))


def by_length(codes: list[list[int]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, matrix) of the stretches of each length."""
    sizes = np.array([len(c) for c in codes])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        for begin in range(0, len(at), 2048):
            part = at[begin : begin + 2048]
            yield part, np.array([codes[x] for x in part], np.int64)


def kernel_with(codes: list[list[int]], table: np.ndarray, decay: float) -> np.ndarray:
    """Inner products of stretches with the columns of ``table``, one row for each triple number."""
    out = np.zeros((len(codes), table.shape[1]), np.float32)
    for at, matrix in by_length(codes):
        numbers, weights = features(matrix, decay)
        for begin in range(0, len(at), 64):
            part = slice(begin, begin + 64)
            out[at[part]] = np.einsum("rt,rtm->rm", weights[part], table[numbers[part]])
    return out


def folded_decisions(codes: list[list[int]], weights: np.ndarray, decay: float) -> np.ndarray:
    """Inner product of each stretch with one weight for each triple."""
    out = np.zeros(len(codes))
    for at, matrix in by_length(codes):
        numbers, values = features(matrix, decay)
        out[at] = (values * weights[numbers]).sum(axis=1)
    return out


def landmark_table(codes: list[list[int]], decay: float) -> np.ndarray:
    table = np.zeros((SYMBOLS**3, len(codes)), np.float32)
    for at, matrix in by_length(codes):
        numbers, weights = features(matrix, decay)
        for row, column in enumerate(at):
            np.add.at(table[:, column], numbers[row], weights[row])
    return table


def units(text: str) -> list[str]:
    """Words of a sentence; a run of three or more single characters is one word, too."""
    words = text.split()
    out, run = words[:], []
    for word in [*words, "  "]:
        core = word.strip("\"'.,;:()-_*")
        if len(core) == 1:
            run.append(core)
            continue
        if len(run) >= 3:
            out.append("".join(run))
        run = []
    return out


@dataclass
class ToxicityModel:
    """Decision of a stretch: ``weights`` of its triples, plus ``shift``. Probability: ``slope`` and ``offset``."""

    weights: np.ndarray
    shift: float
    slope: float
    offset: float
    decay: float
    floor: float
    constant: float | None = None
    _seen: dict[int, float] = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_seen": {}}

    def decisions(self, words: list[str]) -> np.ndarray:
        """Highest decision of each word; words without letters have the floor."""
        codes = [stretches(w) for w in words]
        owner = np.repeat(np.arange(len(words)), [len(c) for c in codes])
        flat = [x for c in codes for x in c]
        out = np.full(len(words), self.floor)
        np.maximum.at(out, owner, folded_decisions(flat, self.weights, self.decay) + self.shift)
        return out

    def probability(self, decisions: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decisions + self.offset, -35, 35)))


def _choose_landmarks(texts: list[list[set[str]]], labels: np.ndarray, count: int) -> list[str]:
    """Words that tell toxic texts, each chosen for the toxic texts that the earlier ones left, then words of clean texts."""
    sets = [set().union(*t) for t in texts]
    clean: Counter = Counter(w for s, y in zip(sets, labels) if y == 0 for w in s)
    total_clean = max(1, int((labels == 0).sum()))
    toxic = [s for s, y in zip(sets, labels) if y == 1]
    left, chosen = list(range(len(toxic))), []
    counts: Counter = Counter(w for s in toxic for w in s)
    while left and len(chosen) < count:
        def gain(w: str) -> float:
            share, other = counts[w] / len(toxic), clean[w] / total_clean
            return (share - 3 * other) * (len(w) > 3)

        word = max(sorted(counts), key=gain, default=None)
        if word is None or gain(word) <= 0:
            break
        chosen.append(word)
        gone = [i for i in left if word in toxic[i]]
        for i in gone:
            counts.subtract(toxic[i])
        counts += Counter()
        left = [i for i in left if word not in toxic[i]]
    common = [w for w, _ in sorted(clean.items(), key=lambda x: (-x[1], x[0])) if len(w) > 2]
    step = max(1, len(common) // max(1, count))
    return list(dict.fromkeys(chosen + common[: count // 2] + common[::step][: count // 2]))


def fit(rows: list[tuple[str | None, int]], landmarks: int = 160, decay: float = 0.7, rounds: int = 4) -> ToxicityModel:
    """Model of (text, label) rows."""
    labels = np.array([y for _, y in rows], np.int64)
    empty = np.zeros(SYMBOLS**3, np.float32)
    if len(set(labels.tolist())) < 2:
        return ToxicityModel(empty, 0.0, 1.0, 0.0, decay, 0.0, float(labels.mean()) if len(labels) else 0.0)
    texts = [[units(s) for s in SENTENCE.split(t or "") if s.strip()] for t, _ in rows]
    core = [[{w.lower().strip("\"'.,;:()[]{}<>-_*~`?") for w in s} for s in t] for t in texts]
    names = _choose_landmarks(core, labels, landmarks)
    marks = [stretch for w in names for stretch in stretches(w)]
    table = landmark_table(marks, decay)
    gram = table.T @ table
    value, vector = np.linalg.eigh(gram.astype(np.float64))
    use = value > 1e-4 * value.max()
    whiten = vector[:, use] / np.sqrt(value[use])
    words = sorted({w for t in texts for s in t for w in s})
    place = {w: i for i, w in enumerate(words)}
    pieces = [stretches(w) or [[0, 31]] for w in words]
    owner = np.repeat(np.arange(len(words)), [len(p) for p in pieces])
    flat = [stretch for p in pieces for stretch in p]
    starts = np.searchsorted(owner, np.arange(len(words)))

    def of_words(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The highest value of each word's stretches, and which stretch has it."""
        order = np.lexsort((-values, owner))
        return values[order][starts], order[starts]

    sentences = [(d, [place[w] for w in s]) for d, t in enumerate(texts) for s in t if s]
    # first witnesses: the words nearest to those that tell toxic texts
    owners = [w for w in names for _ in stretches(w)]
    tells = {w for w in names if _rate(w, core, labels) > 0}
    telling = [i for i, w in enumerate(owners) if w in tells]
    decision, best_stretch = of_words(folded_decisions(flat, table[:, telling].sum(axis=1), decay))
    weights, shift = np.zeros(whiten.shape[1]), 0.0
    for _ in range(rounds):
        witness: dict[int, int] = {}
        negative: set[int] = set()
        for d, own in sentences:
            best = max(own, key=decision.__getitem__)
            if labels[d]:
                if d not in witness or decision[best] > decision[witness[d]]:
                    witness[d] = best
            else:
                negative.add(best)
        positive = Counter(witness.values())
        index = np.array([*positive, *sorted(negative)], np.int64)
        y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
        amount = np.array([*positive.values(), *[1.0] * len(negative)], float)
        amount[y < 0] *= amount[y > 0].sum() / max(1, (y < 0).sum())
        phi = kernel_with([flat[best_stretch[i]] for i in index], table, decay) @ whiten
        x = np.concatenate([phi, np.ones((len(index), 1))], axis=1)

        def loss(w: np.ndarray):
            margin = np.maximum(0, 1 - y * (x @ w))
            active = margin > 0
            value = 0.5 * w[:-1] @ w[:-1] * 0.1 + (amount * margin**2).sum()
            gradient = np.append(0.1 * w[:-1], 0) - 2 * x.T @ (amount * y * margin)
            hessian = np.diag(np.append(np.full(len(w) - 1, 0.1), 1e-6))
            return value, gradient, hessian + 2 * (x[active] * amount[active, None]).T @ x[active]

        solved = newton(loss, np.append(weights, shift))
        weights, shift = solved[:-1], float(solved[-1])
        decision, best_stretch = of_words(folded_decisions(flat, (table @ (whiten @ weights)).astype(np.float32), decay) + shift)
    folded = (table @ (whiten @ weights)).astype(np.float32)
    model = ToxicityModel(folded, shift, 1.0, 0.0, decay, -10.0)
    scores = text_decisions(model, [t for t, _ in rows])
    known = scores > model.floor
    model.floor = float(scores[known].min()) if known.any() else 0.0
    model.slope, model.offset = calibration(np.maximum(scores, model.floor), labels)
    return model


def _rate(word: str, core: list[list[set[str]]], labels: np.ndarray) -> float:
    has = np.array([any(word in s for s in t) for t in core])
    return float(has[labels == 1].mean() - 3 * has[labels == 0].mean())


def text_decisions(model: ToxicityModel, texts: list[str | None]) -> np.ndarray:
    """Highest decision of each text; the reference of :func:`_score`."""
    out = np.full(len(texts), model.floor)
    for i, text in enumerate(texts):
        own = sorted(set(units(text or "")))
        if own:
            out[i] = model.decisions(own).max()
    return out


def plain_spaces(texts: pa.Array) -> pa.Array:
    """The texts with every byte of white space as a space: fitting and scoring then cut words at the same places."""
    data, offsets = text_buffer(texts)
    if len(offsets) < 2:
        return texts.cast(pa.large_string())
    data = data.copy()
    data[(data >= 0x1C) & (data <= 0x1F)] = 0x20
    for lead, tails in _WIDE_SPACES.items():
        at = np.flatnonzero(data == lead[0])
        at = at[at + 1 + len(tails[0]) <= len(data)]
        for tail in tails:
            found = at[np.logical_and.reduce([data[at + 1 + i] == byte for i, byte in enumerate(tail)])]
            for i in range(1 + len(tail)):
                data[found + i] = 0x20
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _score(batches: Iterator[pa.RecordBatch], shared: Broadcast, passed: list[str]) -> Iterator[pa.RecordBatch]:
    model: ToxicityModel = shared.value
    seen = model._seen
    for batch in blocks(batches):
        texts = plain_spaces(batch.column("text"))
        words = split_words(texts)
        best = np.full(batch.num_rows, model.floor)
        if model.constant is None and len(words.start):
            docs = words.documents()
            names, where, back = np.unique(hash_words(words), return_index=True, return_inverse=True)
            if len(seen) > 500_000:
                seen.clear()
            new = [i for i, h in enumerate(names.tolist()) if h not in seen]
            spans = zip(words.start[where[new]].tolist(), words.end[where[new]].tolist())
            spelled = [words.data[a:b].tobytes().decode("utf-8", "replace") for a, b in spans]
            seen.update(zip(names[new].tolist(), model.decisions(spelled).tolist()))
            value = np.array([seen[h] for h in names.tolist()])
            np.maximum.at(best, docs, value[back])
            short = (words.end - words.start) <= 6
            runs = short[:-2] & short[1:-1] & short[2:] & (docs[:-2] == docs[2:])
            for d in np.unique(docs[:-2][runs]).tolist():
                text = texts[d].as_py()
                joined = units(text)[words.bounds[d + 1] - words.bounds[d] :]
                if joined:
                    best[d] = max(best[d], model.decisions(joined).max())
        score = model.probability(best) if model.constant is None else np.full(batch.num_rows, model.constant)
        columns = [*(batch.column(c) for c in passed), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, names=[*passed, "score"])


def score_toxicity(
    docs: DataFrame, labels: DataFrame, held_out: Column, passed: list[str], text: str = "text", rows_per_class: int = 700
) -> DataFrame:
    """``passed`` columns and score of every row of ``docs``, learnt from labels outside ``held_out``."""
    model = fit(training_sample(docs, labels, "toxic", held_out, rows_per_class, [text]))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in passed)
    source = docs.select(*passed, docs[text].alias("text"))
    return source.mapInArrow(lambda x: _score(x, shared, passed), f"{kinds}, score double")
