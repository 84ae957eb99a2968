"""Token counts by the whole-token shortcut, for byte-fallback BPE models of the sentencepiece library.

Two facts are proven from the vocabulary alone, before a text is read:

* **Cuts.** A merged token that spans two neighbouring bytes is a vocabulary string with these two bytes side by side. A
  pair of bytes that is side by side in no vocabulary string is therefore never merged over, and the text can be cut
  there: the merges on the left and on the right do not see each other. Cuts are at first bytes of characters only.
* **Whole tokens.** A vocabulary string that the library encodes as one token behind a guard, a character that is in no
  vocabulary string, is one token wherever two cuts enclose it.

A text is cut into pre-tokens, equal pre-tokens of a batch become one by Arrow's exact dictionary encoding, those that
are proven whole tokens count 1, and only the rest is merged, by the library and each different one once.

The model must leave texts as they are except for spaces, which become ``U+2581``, and one space in front; other models are
refused. Special strings in texts are ordinary text, as in the library.

Defined results: null and empty texts have no bytes and no tokens; repeated rows and null keys are rows like all others; an
empty table gives an empty result; only the columns named are carried through, so others cannot clash. Nothing is
shuffled, and a task holds one piece of a batch, a memory of at most ``MEMORY`` counts, and the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from logweir.llm.words import blocks, text_buffer

#: The character that stands for a space inside a vocabulary.
SPACE = "▁"
#: Different pre-tokens whose merged count a worker remembers; beyond that it forgets all and begins again.
MEMORY = 400_000
#: Longer pre-tokens are merged each time they occur in a new piece of a batch.
LONGEST_KNOWN = 64


@dataclass
class Proof:
    """What is known about a vocabulary before texts are read."""

    processor: SentencePieceProcessor
    joined: np.ndarray
    whole: pa.Array
    guard: str
    guard_tokens: int
    known: dict[bytes, int] = field(default_factory=dict)

    def merged(self, pieces: list[bytes]) -> list[int]:
        """Tokens of each pre-token, by merging."""
        texts = [self.guard + p.decode("utf-8", "surrogatepass") for p in pieces]
        return [len(ids) - self.guard_tokens for ids in self.processor.encode(texts, num_threads=1)]

    def rest(self, pieces: list[bytes]) -> list[int]:
        known = self.known
        if len(known) > MEMORY:
            known.clear()
        new = [p for p in pieces if p not in known]
        found = dict(zip(new, self.merged(new)))
        known.update((p, n) for p, n in found.items() if len(p) <= LONGEST_KNOWN)
        return [found[p] if p in found else known[p] for p in pieces]


def check_plain(processor: SentencePieceProcessor) -> None:
    for text in ("a  b ", " \t\n", "ﬁ①Ａ é", "　x\xa0y", SPACE):
        if processor.normalize(text) != SPACE + text.replace(" ", SPACE):
            raise ValueError("the model changes texts before it cuts them; the shortcut is proven for plain models only")


@lru_cache(maxsize=4)
def prove(model: str) -> Proof:
    """The cuts and whole tokens of the vocabulary in the file ``model``."""
    p = SentencePieceProcessor(model_file=model)
    check_plain(p)
    ids = [i for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))]
    if any(p.is_unused(i) for i in ids):
        raise ValueError("the vocabulary has unused strings, which merge and then fall apart")
    pieces = [p.id_to_piece(i).replace(SPACE, " ").encode("utf-8") for i in ids]
    joined = np.zeros((256, 256), bool)
    for piece in pieces:
        at = np.frombuffer(piece, np.uint8)
        joined[at[:-1], at[1:]] = True
    letters = set("".join(x.decode("utf-8") for x in pieces))
    guard = next(c for c in map(chr, range(1, 0x250)) if c not in letters and c != " ")
    proof = Proof(p, joined, pa.array([], pa.large_binary()), guard, len(p.encode(guard)))
    counts = proof.merged(pieces)
    proof.whole = pa.array([piece for piece, n in zip(pieces, counts) if n == 1], pa.large_binary())
    return proof


def cut(data: np.ndarray, offsets: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in texts that all have at least one byte."""
    start = np.empty(len(data), bool)
    pair = data[:-1].astype(np.uint16) << np.uint16(8) | data[1:]
    start[1:] = ~joined.ravel()[pair] & (data[1:] & 0xC0 != 0x80)
    start[offsets[:-1]] = True
    return np.flatnonzero(start)


def count_column(texts: pa.Array, proof: Proof) -> np.ndarray:
    """Tokens of every text."""
    plain = pc.fill_null(texts.cast(pa.large_string()), "")
    empty = pc.equal(pc.binary_length(plain), 0).to_numpy(zero_copy_only=False)
    front = pa.scalar("", pa.large_string())
    spaced = pc.binary_join_element_wise(front, pc.replace_substring(plain, SPACE, " "), pa.scalar(" ", pa.large_string()))
    data, offsets = text_buffer(spaced)
    if len(data) == 0:
        return np.zeros(len(texts), np.int64)
    starts = cut(data, offsets, proof.joined)
    ends = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
    pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, ends, pa.py_buffer(data)])
    coded = pieces.dictionary_encode()
    whole = pc.is_in(coded.dictionary, value_set=proof.whole).to_numpy(zero_copy_only=False)
    counts = np.ones(len(whole), np.int64)
    counts[~whole] = proof.rest(coded.dictionary.filter(pa.array(~whole)).to_pylist())
    per_piece = counts[coded.indices.to_numpy()]
    return np.where(empty, 0, np.add.reduceat(per_piece, np.searchsorted(starts, offsets[:-1])))


def _count(batches: Iterator[pa.RecordBatch], model: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    proof = prove(model)
    for batch in blocks(batches, "text", 8 << 20):
        texts = batch.column("text")
        size = pc.fill_null(pc.binary_length(texts.cast(pa.large_string())), 0).cast(pa.int64())
        columns = [batch.column(0), size, pa.array(count_column(texts, proof), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def count_tokens(
    docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", limit: int = 4096
) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row; ``model`` is the path of the model file on every machine."""
    names = [key, "n_bytes", "n_tokens"]
    kind = docs.schema[key].dataType.simpleString()
    source = docs.select(docs[key], docs[text].alias("text"))
    counted = source.mapInArrow(lambda x: _count(x, model, names), f"`{key}` {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
