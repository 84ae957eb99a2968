"""Token counts, ranked search and vector codes against brute-force versions on small tables that hold the odd cases."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from test_operators import ITEMS, documents, labels, result, vectors, write

from logweir.llm import lloyd, ranked, wholetoken
from logweir.llm.queries import PIECE_MODEL

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("odd3"), documents(), ITEMS, vectors(), labels())


# ---- token counts ---------------------------------------------------------------------------------------------------


def test_token_counts(spark, folder):
    library = SentencePieceProcessor(model_file=MODEL)
    want = Counter()
    for i, text, *_ in documents():
        n = len(library.encode(text or ""))
        want[(i, len((text or "").encode()), n, n > 4096)] += 1
    assert result(spark, folder, "op11_token_counts") == want
    assert any(over for *_, over in want)


def test_token_counts_of_random_texts():
    pick = random.Random(5)
    letters = "aabcdeeth  \n\t.,▁▁é日<>s/0x1\x00\x01 🙂İß'\"  "
    texts = ["".join(pick.choices(letters, k=pick.randint(0, 40))) for _ in range(5000)]
    texts += ["x" * 20_000, " " * 500, "▁" * 50, "ab" * 5000, "", None, "<s></s><unk><0x41>"]
    proof = wholetoken.prove(PIECE_MODEL)
    want = [len(ids) for ids in proof.processor.encode([t or "" for t in texts])]
    assert wholetoken.count_column(pa.array(texts), proof).tolist() == want


def test_proven_strings_are_one_token_between_any_cuts():
    proof = wholetoken.prove(PIECE_MODEL)
    pick = random.Random(6)
    whole = [w.decode() for w in pick.sample(proof.whole.to_pylist(), 3000)]
    between = proof.guard
    ids = proof.processor.encode(between + between.join(whole) + between)
    one = len(proof.processor.encode(between * 2)) - proof.guard_tokens
    assert len(ids) - proof.guard_tokens == len(whole) + one * len(whole)


def test_a_bounded_memory_gives_the_same_counts(monkeypatch):
    proof = wholetoken.prove(PIECE_MODEL)
    texts = pa.array([t for _, t, *_ in documents()])
    want = wholetoken.count_column(texts, proof).tolist()
    monkeypatch.setattr(wholetoken, "MEMORY", 3)
    for _ in range(2):
        assert wholetoken.count_column(texts, proof).tolist() == want


def test_changing_models_are_refused():
    class Folding:
        def normalize(self, text):
            return wholetoken.SPACE + text.lower()

    with pytest.raises(ValueError, match="plain models"):
        wholetoken.check_plain(Folding())


# ---- ranked search --------------------------------------------------------------------------------------------------


def terms_of(text) -> list[bytes]:
    return [t.lower() for t in re.findall(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").encode())]


def best_documents(rows, items, k=20) -> Counter:
    held = [(i, Counter(terms_of(t)), len(terms_of(t))) for i, t in rows]
    n, total = sum(1 for *_, size in held if size), sum(size for *_, size in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = Counter()
    for item, text in items:
        scored = []
        for i, counts, size in held:
            score = 0
            for t in terms_of(text):
                if tf := counts[t]:
                    m = 100 - 25 + 25 * size * n // total
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored)[:k], 1):
            out[(item, rank, i, -score)] += 1
    return out


def test_ranked_search(spark, folder):
    want = best_documents([(i, t) for i, t, *_ in documents()], ITEMS)
    assert result(spark, folder, "op12_ranked_search") == want
    assert len({item for item, *_ in want}) == 9


@pytest.mark.parametrize("shard, block, first", [(40, 1 << 20, 1), (1, 7, 2), (1 << 22, 30, 64)])
def test_ranked_search_in_small_shards_blocks_and_reads(spark, monkeypatch, shard, block, first):
    """Ties over shards, copies, null and repeated ids, repeated terms, an item that is longer than a block."""
    monkeypatch.setattr(ranked, "FIRST_DEPTH", first)
    pick = random.Random(shard)
    bank = ["the"] * 6 + ["of"] * 3 + [f"w{i}" for i in range(40)] + ["É", "x1Y"]
    rows = [(i, " ".join(pick.choices(bank, k=pick.randint(0, 30)))) for i in range(300)]
    rows += [(400 + i, "the w1 w2 w3") for i in range(60)] + [(None, "w1 w2"), (None, None), (3, "w1 the"), (3, "w1 the")]
    items = [(1, "the THE w1 w2"), (2, "É x1y of of"), (2, "w5"), (None, "w1, w1! w7"), (4, "nothing here"), (5, None), (6, " ".join(bank) * 3)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, score int, item int").repartition(4)
    found = ranked.search(docs, spark.createDataFrame(items, "item_id bigint, text string"), shard=shard, block_terms=block)
    assert Counter(map(tuple, found.collect())) == best_documents(rows, items)


def test_nra_reads_no_more_than_it_needs():
    """One clear winner: lists of 50,000 documents are left after the first reads."""
    size = 50_000
    impact_terms = pa.array([[0, 1] if i == 7 else [i % 2] for i in range(size)], pa.list_(pa.int32()))
    times = pa.array([[900, 900] if i == 7 else [1 + (i < 40)] for i in range(size)], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(size), pa.int64()), pa.array([5] * size, pa.int64()), impact_terms, times], names=["document", "n", "terms", "times"]
    )
    shard = ranked.Shard([batch], ranked.Corpus(size, 5 * size, np.array([5, 7])))
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice) and at.stop is not None:
                read.append(at.stop)
            return super().__getitem__(at)

    shard.impact = shard.impact.view(Watched)
    assert [key for _, key in shard.best([(0, 1), (1, 1)], 1, 1)] == [7]
    assert max(s for s in read if s not in shard.bounds) <= 4 * ranked.FIRST_DEPTH


# ---- vector codes ---------------------------------------------------------------------------------------------------


def lloyd_by_hand(rows, parts=16, entries=64, rounds=2) -> Counter:
    whole = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v) and v and len(v) % parts == 0]
    whole = [(i, [np.float32(x) for x in v], lab) for i, v, lab in whole]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [r for r in whole if len(r[1]) == len(whole[0][1])]
    width = len(whole[0][1]) // parts
    cut = [[tuple(math.floor(256 * float(x)) for x in v[p * width : (p + 1) * width]) for p in range(parts)] for _, v, _ in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def assigned(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), at) for at, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = defaultdict(list)
            for c in cut:
                members[assigned(p, c[p])[1]].append(c[p])
            new.append([tuple(sum(x) // len(members[at]) for x in zip(*members[at])) if members[at] else e for at, e in enumerate(books[p])])
        books = new
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    coded = []
    for (i, _, lab), c in zip(whole, cut):
        near = [assigned(p, c[p]) for p in range(parts)]
        coded.append((i, "".join(f"{at:02x}" for _, at in near), sum(d for d, _ in near), lab))
    per_label = Counter()
    for *_, error, lab in coded:
        per_label[lab] += error
    return Counter((i, code, error, per_label[lab], sha) for i, code, error, lab in coded)


def test_vector_codes(spark, folder):
    assert result(spark, folder, "op13_vector_codes") == lloyd_by_hand(vectors())


def test_vector_codes_with_hot_vectors_few_rows_and_null_labels(spark):
    pick = np.random.default_rng(9)
    hot = pick.normal(size=32).tolist()
    rows = [(i, hot if i % 3 else pick.normal(size=32).tolist(), None if i % 4 == 0 else i % 5) for i in range(150)]
    rows += [(7, [3e38] * 32, 1), (None, [-3e38] * 32, None)]
    kind = "vec_id bigint, embedding array<float>, label int, entry int, c0 int, error int"
    for some in (rows[:150], rows[:9]):
        frame = spark.createDataFrame([(*r, 1, 2, 3) for r in some], kind).repartition(3)
        coded, books = lloyd.compress(frame, resident=16)
        found = lloyd.label_errors(coded)
        got = Counter((r.vec_id, r.code, r.error, r.label_error, lloyd.digest(books)) for r in found.collect())
        assert got == lloyd_by_hand(some)
    coded, _ = lloyd.compress(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], kind))
    assert coded.count() == 152 and coded.where("error < 0").count() == 0


def test_only_movers_are_shuffled(spark, monkeypatch):
    """What is written after the second comparison and dealt anew is just the members whose entry changed."""
    written = []
    inner = lloyd.stage

    def watched(frame):
        out = inner(frame)
        written.append(out)
        return out

    monkeypatch.setattr(lloyd, "stage", watched)
    pick = np.random.default_rng(2)
    rows = [(i, pick.normal(size=16).tolist(), 0) for i in range(500)]
    lloyd.compress(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"))
    first, compared, arrived = written
    assert first.count() == compared.count()
    assert 0 < arrived.count() == compared.where("owner <> entry").count() < first.count() / 2


def test_nearest_is_exact_beyond_doubles():
    pick = np.random.default_rng(4)
    for scale in (300, 2**25):
        parts, entries = pick.integers(-scale, scale, (500, 4)), pick.integers(-scale, scale, (64, 4))
        entries[9] = entries[3]
        entry, distance = lloyd.nearest(parts, entries)
        apart = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (entry == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
