"""BPE encoding by speculation and verification, and decoding.

Longest-match segmentation proposes the tokens of a word. The proposal is what merging gives if each token is the
encoding of its own characters and every adjacent pair is compatible. A pair is incompatible if some node on the right
edge of the left token's merge tree and some node on the left edge of the right token's tree have a merge that comes
before both are used up by their own trees; node tables test all new pairs of a batch at once. Only words with an
incompatible pair are merged exactly, side by side.

The vocabulary file is that of the tokenizers library with lower-casing, byte symbols and a word-end suffix. White space
is never part of a token. All texts of a block are cut into words at once; each different word is encoded once and
remembered, its spellings are put together once a block. Only runs with characters beyond ASCII or special tokens are cut
as texts. Defined results: a null text is empty and has no tokens; repeated rows repeat their result; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from logweir.llm.runs import gather
from logweir.llm.words import blocks, text_buffer

#: Fixed value: what the vocabulary's pre-tokenizer keeps, with white space as its engine knows it.
_WHITE = r"\t-\r \x85\xa0  -     　"
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_WHITE}\p{{L}}\p{{N}}]+|\n")
NEVER = np.iinfo(np.int32).max
#: What sets the last symbol of a word apart from the same symbol inside.
LAST = 0x1000
#: Letters of the longest words that are merged side by side; ``rank * TOGETHER + place`` orders the merges of a word.
TOGETHER = 32
#: The least number that is no merge's place in that order.
NONE = 1 << 30
#: Bytes of text that a task encodes at once.
ENCODED = 1 << 20
#: Different words encoded at once.
WORDS = 8192

_WHITE_BYTE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _WHITE_BYTE
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[0x30:0x3A] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def byte_symbols() -> dict[int, str]:
    """Printable Latin-1 bytes are themselves; the others are the code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Remembered:
    """Values of the keys seen last: those of the last ``size`` and, until as many others have come, of those before."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def values(self, keys: list[bytes], make: Callable[[list[bytes]], list[bytes]]) -> list[bytes]:
        """Values of different keys; ``make`` gives those not remembered."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        found = list(map(new.get, keys))
        absent = [k for k, value in zip(keys, found) if value is None]
        again = list(map(old.get, absent))
        new.update((k, value) for k, value in zip(absent, again) if value is not None)
        unknown = [k for k, value in zip(absent, again) if value is None]
        for at in range(0, len(unknown), WORDS):
            part = unknown[at : at + WORDS]
            new.update(zip(part, make(part)))
        return [value or new[k] for k, value in zip(keys, found)]


@dataclass
class Cut:
    """The different items of texts, the number of the item at each place, and the bounds of each text's places.

    Items are words in lower case and, after them, ``odd`` runs: those with characters beyond ASCII or a special token.
    """

    words: list[bytes]
    odd: list[bytes]
    places: np.ndarray
    bounds: np.ndarray


def _mapped(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(table.tobytes()), np.uint8)


def _values(array: pa.LargeBinaryArray) -> list[bytes]:
    if len(array) == 0:
        return []
    ends = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1].tolist()
    data = array.buffers()[2].to_pybytes()
    return [data[a:b] for a, b in zip(ends, ends[1:])]


def _contractions(text: np.ndarray, begin: np.ndarray, start: np.ndarray) -> None:
    """Joins an apostrophe at a word's start to the letters that ``PIECES`` takes with it, and starts a word behind them."""
    at = np.flatnonzero(text == ord("'"))
    at = at[begin[at] | (_KIND[text[at - 1]] != _OTHER)]
    text, begin = np.append(text, np.zeros(2, np.uint8)), np.append(begin, [True, True])
    at = at[~begin[at + 1]]
    one, two = text[at + 1], text[at + 2]
    short = np.isin(one, list(b"stmd"))
    both = (two == ord("e")) & ((one == ord("r")) | (one == ord("v"))) | (one == ord("l")) & (two == ord("l"))
    long = both & ~begin[at + 2]
    start[at[short | long] + 1] = False
    behind = np.concatenate([at[short] + 2, at[long] + 3])
    start[behind[behind < len(start)]] = True


def cut(column: pa.Array, special: re.Pattern[bytes] | None) -> Cut:
    """Cuts texts into items."""
    data, offsets = text_buffer(column)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    inside = _mapped(data, _KIND) != _WHITE_BYTE
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    strange = data >= 0x80
    for found in special.finditer(memoryview(data)) if special else ():
        strange[found.start() : found.end()] = True
    body, begin = data[inside], first[inside]
    text, kind, start = _mapped(body, _LOWER), _mapped(body, _KIND), begin.copy()
    start[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    _contractions(text, begin, start)
    strange = strange[inside]
    if strange.any():
        runs = np.flatnonzero(begin)
        strange = np.repeat(np.logical_or.reduceat(strange, runs), np.diff(runs, append=len(body)))
        start &= begin | ~strange
        text = np.where(strange, body, text)
    starts = np.flatnonzero(start)
    ends = pa.py_buffer(np.append(starts, len(text)).astype(np.int64))
    coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, ends, pa.py_buffer(text)]).dictionary_encode()
    places = coded.indices.to_numpy()
    odd = np.zeros(len(coded.dictionary), bool)
    odd[places[strange[starts]]] = True
    number = np.empty(len(odd), np.int32)
    number[np.argsort(odd, kind="stable")] = np.arange(len(odd), dtype=np.int32)
    items, words = coded.dictionary.take(pa.array(np.argsort(odd, kind="stable"))), len(odd) - int(odd.sum())
    before = np.append(0, np.cumsum(inside, dtype=np.int32))[offsets]
    return Cut(_values(items.slice(0, words)), _values(items.slice(words)), number[places], np.searchsorted(starts, before))


class Merges:
    """Vocabulary and merges of a file, with the tables of the pair test."""

    def __init__(self, path: str, memory: int = 150_000) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in data["added_tokens"]}
        self.names = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.find_special = re.compile(b"|".join(re.escape(x.encode()) for x in self.special)) if self.special else None
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {(self.ids[a], self.ids[b]): (n, self.ids[a + b]) for n, (a, b) in enumerate(pairs)}
        self.symbols = byte_symbols()
        self.inner = {t: i for t, i in self.ids.items() if not t.endswith(self.suffix)}
        self.final = {t.removesuffix(self.suffix): i for t, i in self.ids.items() if t.endswith(self.suffix)}
        #: Length of the longest inner token for each start of three symbols.
        self.reach: dict[str, int] = {}
        for token in self.inner:
            if len(token) > 2:
                self.reach[token[:3]] = max(len(token), self.reach.get(token[:3], 0))
        self.matcher = self._matcher()
        self._tables(pairs)
        most = max(self.names) + 1
        self.size = np.zeros(most, np.int64)
        for tokens in (self.inner, self.final):
            self.size[list(tokens.values())] = [*map(len, tokens)]
        self.unsound = self._unsound(most)
        self.compatible: dict[int, bool] = {}
        self.words, self.odd_runs = Remembered(memory), Remembered(memory // 2)
        self.decimal = pa.array([b"%d " % i for i in range(most)], pa.large_binary())
        self.name = pa.array([f"{self.names.get(i, '')} ".encode() for i in range(most)], pa.large_binary())

    def _unsound(self, most: int) -> np.ndarray:
        """Whether merging a token's own letters gives anything else."""
        byte = {symbol: b for b, symbol in self.symbols.items()}
        tokens = [(i, t, 0) for t, i in self.inner.items()] + [(i, t, 256) for t, i in self.final.items() if t]
        size = np.array([len(t) for _, t, _ in tokens], np.int64)
        ends = np.cumsum(size)
        codes = np.array([byte[c] for _, t, _ in tokens for c in t], np.int64)
        codes[ends - 1] += [last for _, _, last in tokens]
        made, count = self.exact_many(codes, ends - size, size)
        which = np.array([i for i, _, _ in tokens], np.int64)
        out = np.zeros(most, bool)
        out[which] = (count != 1) | (made[np.cumsum(count) - count] != which)
        return out

    def _tables(self, pairs: list[tuple[str, str]]) -> None:
        """Right and left edges of every token's merge tree, from the token down, with the merge that uses each up."""
        tree = {self.ids[a + b]: (self.ids[a], self.ids[b], n) for n, (a, b) in enumerate(pairs)}
        count = max(self.names) + 1

        def edges(side: int) -> tuple[np.ndarray, np.ndarray]:
            chains = []
            for token in range(count):
                chain, until = [(token, NEVER)], tree.get(token)
                while until:
                    chain.append((until[side], until[2]))
                    until = tree.get(until[side])
                chains.append(chain)
            width = max(map(len, chains))
            nodes, used = np.full((count, width), -1, np.int64), np.full((count, width), -1, np.int64)
            for token, chain in enumerate(chains):
                nodes[token, : len(chain)] = [x for x, _ in chain]
                used[token, : len(chain)] = [x for _, x in chain]
            return nodes, used

        self.right, self.left = edges(1), edges(0)
        codes = np.array([(self.ids[a] << 20) | self.ids[b] for a, b in pairs], np.int64)
        self.merge_rank = np.argsort(codes)
        self.merge_code = codes[self.merge_rank]
        self.merge_made = np.array([self.ids[a + b] for a, b in pairs], np.int64)
        #: Code points and ids of symbols by their bytes, 256 more for the last of a word, and the order of their merges.
        self.symbol = np.array([ord(self.symbols[b]) + last for last in (0, LAST) for b in range(256)], np.uint32)
        self.symbol[ord("\n")] = ord("\n")
        self.letter = np.array([self.ids.get(self.symbols[b] + end, -1) for end in ("", self.suffix) for b in range(256)], np.int64)
        self.letter_order = self._order(self.letter[:, None], self.letter)

    def exact_many(self, codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merging by rank, the leftmost pair first among equals: all ids one after the other, and how many each word has.

        Words of up to ``TOGETHER`` letters are merged side by side, one pair of each a round.
        """
        count, parts = np.zeros(len(first), np.int64), []
        order = np.argsort(size, kind="stable")
        short = order[size[order] <= TOGETHER]
        for at in range(0, len(short), 4096):
            part = short[at : at + 4096]
            ids, count[part] = self._side_by_side(codes, first[part], size[part])
            parts.append((part, ids))
        for i in order[len(short) :].tolist():
            ids = self._exact_long(self._known(self.letter[codes[first[i] : first[i] + size[i]]]).tolist())
            count[i] = len(ids)
            parts.append((np.array([i]), np.array(ids, np.int64)))
        out, begin = np.zeros(int(count.sum()), np.int64), np.cumsum(count) - count
        for part, ids in parts:
            n = count[part]
            out[np.repeat(begin[part] - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, count

    def _known(self, letters: np.ndarray) -> np.ndarray:
        if (letters < 0).any():
            raise KeyError("a symbol has no token")
        return letters

    def _order(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Order of the merge of each pair, at place 0; ``NONE`` if there is none. Negative symbols have none."""
        code = (left << 20) | right
        place = np.minimum(np.searchsorted(self.merge_code, code), len(self.merge_code) - 1)
        there = (self.merge_code[place] == code) & (left >= 0) & (right >= 0)
        return np.where(there, self.merge_rank[place] * TOGETHER, NONE).astype(np.int32)

    def _side_by_side(self, codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A column a word; the last row stands for what is in front of a word and behind it."""
        words, width = len(first), int(size.max())
        row = np.arange(width)[:, None]
        here = row < size
        code = codes[np.minimum(first + row, len(codes) - 1)]
        token = np.full((width + 1, words), -1, np.int64)
        self._known(self.letter[code][here])
        token[:width] = np.where(here, self.letter[code], -1)
        order = np.full((width + 1, words), NONE, np.int32)
        order[: width - 1] = np.where(here[1:], self.letter_order[code[:-1], code[1:]], NONE) + row[:-1]
        after = np.broadcast_to(np.arange(1, width + 2)[:, None], order.shape).copy()
        after[size - 1, np.arange(words)] = width
        before = np.broadcast_to(np.append(width, np.arange(width))[:, None], order.shape).copy()
        flat, flat_order, flat_after, flat_before = (x.ravel() for x in (token, order, after, before))
        while True:
            least = order.min(axis=0)
            go = np.flatnonzero(least < NONE)
            if len(go) == 0:
                break
            rank, at = np.divmod(least[go], TOGETHER)
            i = at * words + go
            j = flat_after[i] * words + go
            made = self.merge_made[rank]
            flat[i], flat[j], flat_order[j] = made, -1, NONE
            behind, front = flat_after[j], flat_before[i]
            flat_after[i], flat_before[behind * words + go] = behind, at
            n = front * words + go
            both = self._order(np.concatenate([flat[n], made]), np.concatenate([made, flat[behind * words + go]]))
            flat_order[n], flat_order[i] = both[: len(go)] + front, both[len(go) :] + at
        left = token[:width].T
        there = left >= 0
        return left[there], there.sum(axis=1)

    def _exact_long(self, letters: list[int]) -> list[int]:
        """The same for a word of any length, with a heap of pairs."""
        count = len(letters)
        token, after, before = list(letters), [*range(1, count + 1)], [*range(-1, count - 1)]
        heap = [(*self.ranks[p], i) for i, p in enumerate(zip(letters, letters[1:])) if p in self.ranks]
        heap = [(rank, i, made) for rank, made, i in heap]
        heapq.heapify(heap)
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = after[i]
            if token[i] < 0 or j >= count or self.ranks.get((token[i], token[j])) != (rank, made):
                continue
            token[i], token[j], after[i] = made, -1, after[j]
            if after[j] < count:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < count and (pair := self.ranks.get((token[a], token[b]))):
                    heapq.heappush(heap, (pair[0], a, pair[1]))
        return [t for t in token if t >= 0]

    def _matcher(self) -> ahocorasick.Automaton | None:
        """Finds the longest token at each place, in compiled code; None if some symbol alone has no token.

        The last symbol of a word is a character of its own kind (``LAST`` higher), as only tokens with the suffix may hold it.
        """
        tokens = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, i in self.inner.items():
            tokens.add_word(token, i)
        for token, i in self.final.items():
            if token:
                tokens.add_word(token[:-1] + chr(ord(token[-1]) + LAST), i)
        tokens.make_automaton()
        alone = set(self.symbols.values())
        return tokens if alone <= self.inner.keys() and alone <= self.final.keys() else None

    def propose(self, text: str, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Longest-match tokens of words of symbols that end at ``ends``, and the number of each one's word."""
        words, size = len(ends), np.diff(ends, prepend=-1) - 1
        if self.matcher is not None:
            found = [i for _, i in self.matcher.iter_long(text)]
            token = np.array(found, np.int64)
            last = np.cumsum(self.size[token])
            if len(last) and last[-1] == size.sum():
                return token, np.repeat(np.arange(words), size)[last - 1]
        begin = (ends - size).tolist()
        proposed = [self._propose_by_lookup(text[a : b - 1] + chr(ord(text[b - 1]) - LAST)) or [] for a, b in zip(begin, ends.tolist())]
        return np.array([i for p in proposed for i in p], np.int64), np.repeat(np.arange(words), [*map(len, proposed)])

    def _propose_by_lookup(self, word: str) -> list[int] | None:
        out, at, size = [], 0, len(word)
        while at < size:
            if (last := self.final.get(word[at:])) is not None:
                out.append(last)
                return out
            reach = self.reach.get(word[at : at + 3], 2)
            for stop in range(min(size - 1, at + reach), at, -1):
                if (token := self.inner.get(word[at:stop])) is not None:
                    out.append(token)
                    at = stop
                    break
            else:
                return None
        return out

    def check_pairs(self, codes: np.ndarray) -> np.ndarray:
        """Whether each pair (left << 20 | right) is compatible."""
        out = np.ones(len(codes), bool)
        for at in range(0, len(codes), 2048):
            part = codes[at : at + 2048]
            a, used_a = (x[part >> 20][:, :, None] for x in self.right)
            b, used_b = (x[part & 0xFFFFF][:, None, :] for x in self.left)
            code = (a << 20) | b
            place = np.minimum(np.searchsorted(self.merge_code, code), len(self.merge_code) - 1)
            merges = (self.merge_code[place] == code) & (a >= 0) & (b >= 0)
            rank = self.merge_rank[place]
            out[at : at + 2048] = ~(merges & (rank < used_a) & (rank <= used_b)).any(axis=(1, 2))
        return out

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of words as little-endian 32-bit numbers."""
        codes = np.frombuffer(b"\n".join([*words, b""]), np.uint8).astype(np.int64)
        ends = np.flatnonzero(codes == ord("\n"))
        size = np.diff(ends, prepend=-1) - 1
        codes[ends - 1] += 256
        text = self.symbol[codes].astype("<u4").tobytes().decode("utf-32-le")
        token, owner = self.propose(text, ends)
        wrong = np.bincount(owner, self.size[token], len(words)) != size
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, back = np.unique((token[inside] << 20) | token[inside + 1], return_inverse=True)
        new = np.array([c for c in pairs.tolist() if c not in self.compatible], np.int64)
        self.compatible.update(zip(new.tolist(), self.check_pairs(new).tolist()))
        fits = np.array([self.compatible[c] for c in pairs.tolist()], bool)
        wrong[owner[inside][~fits[back]]] = True
        wrong[owner[self.unsound[token]]] = True
        if len(self.compatible) > 300_000:
            self.compatible.clear()
        merged, merged_count = self.exact_many(codes, (ends - size)[wrong], size[wrong])
        count = np.bincount(owner, minlength=len(words))
        count[wrong] = merged_count
        ids, exact = np.empty(int(count.sum()), "<i4"), np.repeat(wrong, count)
        ids[exact], ids[~exact] = merged, token[~wrong[owner]]
        data, bounds = ids.tobytes(), [0, *(4 * np.cumsum(count)).tolist()]
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def pieces(self, runs: list[bytes]) -> list[list[bytes | int]]:
        """Words and special ids of runs without ASCII white space."""
        text, words = b"\n".join(runs).decode("utf-8", "surrogatepass"), []
        for n, part in enumerate(self.split_special.split(text) if self.split_special else [text]):
            if n % 2:
                words.append(self.special[part])
            else:
                # each character by itself: only a capital sigma depends on its neighbours
                lower = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                words += [w.encode() for w in PIECES.findall(lower)]
        out: list[list[bytes | int]] = [[]]
        for word in words:
            if word == b"\n":
                out.append([])
            else:
                out[-1].append(word)
        return out

    def encode_odd(self, runs: list[bytes]) -> list[bytes]:
        """The same of runs with characters beyond ASCII or special tokens."""
        parts = self.pieces(runs)
        words = list(dict.fromkeys(w for part in parts for w in part))
        plain = [w for w in words if isinstance(w, bytes)]
        known: dict[bytes | int, bytes] = dict(zip(plain, self.words.values(plain, self.encode_words)))
        known.update((w, w.to_bytes(4, "little")) for w in words if isinstance(w, int))
        return [b"".join([known[w] for w in part]) for part in parts]

    def encode(self, texts: pa.Array) -> Encoded:
        """Ids of all texts; every different word is encoded once."""
        parts = cut(texts, self.find_special)
        found = self.words.values(parts.words, self.encode_words) + self.odd_runs.values(parts.odd, self.encode_odd)
        return Encoded(self, found, parts.places, parts.bounds)

    def encode_runs(self, runs: list[str]) -> list[list[int]]:
        return self.encode(pa.array(runs, pa.string())).ids().to_pylist()


@dataclass
class Encoded:
    """Ids of all texts of a batch: ``found`` are those of each different item, ``bounds`` those of each text in places of items."""

    merges: Merges
    found: list[bytes]
    places: np.ndarray
    bounds: np.ndarray

    def _sizes(self) -> np.ndarray:
        return np.fromiter(map(len, self.found), np.int64, len(self.found)) // 4

    def _put(self, spellings: pa.Array | None = None) -> tuple[memoryview, list[int]]:
        """Ids of all texts, or their spellings, and the bounds of each text."""
        values: list[bytes] | pa.Array = self.found
        if spellings is not None:
            put = spellings.take(pa.array(np.frombuffer(b"".join(self.found), "<i4")))
            ends = np.frombuffer(put.buffers()[1], np.int64)[put.offset : put.offset + len(put) + 1] if len(put) else np.zeros(1, np.int64)
            bounds = pa.py_buffer(ends[np.append(0, np.cumsum(self._sizes()))])
            values = pa.Array.from_buffers(pa.large_binary(), len(self.found), [None, bounds, put.buffers()[2] or pa.py_buffer(b"")])
        data, ends = gather(values, self.places, self.bounds)
        return data, ends.tolist()

    def counts(self) -> np.ndarray:
        return np.diff(np.append(0, np.cumsum(self._sizes()[self.places]))[self.bounds])

    def ids(self) -> pa.ListArray:
        data, ends = self._put()
        return pa.ListArray.from_arrays(pa.array([e // 4 for e in ends], pa.int32()), pa.array(np.frombuffer(data, "<i4", ends[-1] // 4)))

    def _texts(self, spellings: pa.Array) -> list[memoryview]:
        """Every token's spelling ends with a space, the last of which is none of the text's."""
        data, ends = self._put(spellings)
        return [data[a : max(a, b - 1)] for a, b in zip(ends, ends[1:])]

    def decoded(self) -> list[str]:
        return [str(t, "utf-8") for t in self._texts(self.merges.name)]

    def digests(self) -> list[list[str]]:
        """Of the ids in decimal, joined by spaces, and of the decoded texts."""
        return [[hashlib.sha256(t).hexdigest() for t in self._texts(x)] for x in (self.merges.decimal, self.merges.name)]


_merges = lru_cache(maxsize=2)(Merges)


def encode_column(texts: pa.Array, path: str) -> Encoded:
    return _merges(path).encode(texts)


def _encode(batches: Iterator[pa.RecordBatch], path: str, names: list[str], digests: bool) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "text", ENCODED):
        coded = encode_column(batch.column("text"), path)
        if digests:
            columns = [pa.array(x, pa.string()) for x in coded.digests()]
        else:
            columns = [coded.ids(), pa.array(coded.decoded(), pa.string())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(coded.counts()), *columns], names=names)


def encode_decode(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", digests: bool = False
) -> DataFrame:
    """(key, n_tokens, ids, decoded) of every row; ``digests`` gives (ids_sha256, decoded_sha256) instead of the values."""
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"])]
    types = [kind, "bigint", *(["string", "string"] if digests else ["array<int>", "string"])]
    source = docs.select(docs[key], docs[text].alias("text"))
    return source.mapInArrow(
        lambda x: _encode(x, tokenizer, names, digests), ", ".join(f"`{n}` {t}" for n, t in zip(names, types))
    )
