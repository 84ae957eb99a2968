"""Every operator query against a brute-force version on small tables that hold the odd cases, and on empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from statistics import NormalDist

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from logweir.llm import capfilter, simhash, substring, toxicity
from logweir.llm.bpe import Merges
from logweir.llm.decontaminate import decontaminate
from logweir.llm.queries import QUERIES
from logweir.llm.secrets import scan_secrets
from logweir.llm.staging import staged_path
from logweir.llm.tokenfile import EliasFano, encode_texts, fetch_tokens, write_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row int, spans string, score double, word string, n int, `key` int"


def sentences(seed: int, words: int, end: str = ".") -> str:
    pick = random.Random(seed)
    bank = ["the", "of", "and", "thered", "onthe", "ination", "ersh", "wh", "éau", "que", "ingly", "stand"]
    own = [pick.choice(bank) if pick.random() < 0.5 else "".join(pick.sample(["th", "er", "on", "an", "re", "he", "in"], 3)) for _ in range(words)]
    return "".join(w + (f"{end} " if i % 9 == 8 else " ") for i, w in enumerate(own))


ITEMS = [(i, sentences(900 + i, 25)) for i in range(6)] + [(6, "Short item only here"), (7, None), (8, ""), (9, sentences(900, 25)), (10, "one")]


def documents() -> list[tuple]:
    shared = sentences(77, 60)
    rows = [(i, sentences(i, 30 + i)) for i in range(60)]
    rows += [(100 + i, sentences(500, 80) + f" tail{i}") for i in range(12)]
    rows += [(120 + i, f"{sentences(130 + i, 20)}{shared}{sentences(150 + i, 20)}") for i in range(4)]
    rows += [(130, f"{shared} {shared}"), (131, None), (132, ""), (133, " \t\n\x0b "), (134, "word"), (135, sentences(7, 30_000))]
    rows += [(136, sentences(36, 20) + ITEMS[2][1].upper() + sentences(37, 20)), (137, " ".join(ITEMS[3][1].split()[:11]))]
    rows += [(138, "a SHORT,item-only here! b"), (139, "one")]
    rows += [(140 + i, f'x password = "hunter{i}2" y AKIA{"Q7" * 9} z {"0a9f" * 8} k') for i in range(3)]
    rows += [(150, "token=abc API_KEY: abcdef, apikey=>secret 'Secret':'a.b-c_d' AKIA123 deadbeef"), (151, "k Zx9Qw3Er7Ty1Ui5Op2As4D k")]
    rows += [(160, "<|endoftext|>İstanbul ΣΑΣ é 日本語 it's we'll ²½ x y <|startoftext|>ok　 \x1c\x85 🙂🙂"), (161, "x" * 20_000), (None, sentences(3, 50)), (None, None), (5, sentences(5, 35))]
    for i in range(40):
        rows.append((200 + i, sentences(200 + i, 60) + ("you stupid idiot here" if i % 2 else "and of the")))
        rows.append((300 + i, sentences(300 + i, 60) if i % 2 else "thered$$$ onthe### | ersh%%% | " * 12))
    rows.append(rows[0])
    return [(i, t, None if i == 9 else "en", None if i == 8 else f"s{(i or 0) % 5}", None if i == 7 else len(t or ""), 1, "x", 0.5, "w", 2, 3) for i, t in rows]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("odd"), documents(), ITEMS, vectors(), labels())


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), [], [], [], [])


def labels():
    good = [(i, 1, 0) for i in range(60)]
    return good + [(200 + i, 1, i % 2) for i in range(40)] + [(300 + i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (1, None, None), (9999, 0, 1)]


def vectors():
    pick = np.random.default_rng(3)
    rows = [(i, pick.normal(size=16).tolist(), 0) for i in range(200)]
    rows += [(300 + i, (np.array(rows[i % 5][1]) + 0.05 * pick.normal(size=16)).tolist(), 0) for i in range(60)]
    rows += [(400 + i, rows[1][1], 0) for i in range(5)] + [(410, [2 * x for x in rows[2][1]], 0)]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 7]
    return rows + [(500 + i, v, 0) for i, v in enumerate(bad)] + [(None, [0.3] * 16, 1), (0, rows[0][1], 0)]


def write(spark, path, docs, items, embeddings, marks) -> str:
    tables = {
        "documents": (docs, DOCS),
        "benchmark": (items, "item_id bigint, text string"),
        "embeddings": (embeddings, "vec_id bigint, embedding array<float>, label int"),
        "labels": (marks, "doc_id bigint, quality int, toxic int"),
    }
    for name, (rows, kind) in tables.items():
        spark.createDataFrame(rows, kind).repartition(3).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def result(spark, folder, name) -> Counter:
    return Counter(tuple(r) for r in QUERIES[name](spark, folder).collect())


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words_of(text) -> list[str]:
    return [w.decode() for w in (text or "").encode().split()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


def test_secrets(spark, folder):
    keyword = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    want = Counter()
    for i, text, *_ in documents():
        text = text or ""
        spans = [(m.start(), 0, "assign", m.end()) for m in keyword.finditer(text) if len(m[2]) >= 6]
        spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        kinds = Counter(s[2] for s in spans)
        want[(i, kinds["assign"], kinds["access"], kinds["hex"], sha(",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))))] += 1
    rows = QUERIES["op1_secret_scan"](spark, folder).collect()
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in rows) == want
    by_id = {r.doc_id: r for r in rows}
    assert by_id[151].spans == "opaque:2:24" and by_id[151].n_owner_specific == 1
    assert by_id[140].n_example == 2 and by_id[140].n_owner_specific == 1  # two values have three owners, one has one


def test_toxicity(spark, folder):
    rows = QUERIES["op2_toxicity"](spark, folder).collect()
    assert len(rows) == len(documents()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    by_id = {r.doc_id: r for r in rows}
    assert all(r.held_out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [i for i in range(40) if by_id[200 + i].held_out]
    assert held and all(by_id[200 + i].predicted == i % 2 for i in held)


def test_toxicity_tolerates_gaps():
    clean = [(sentences(i, 60), 0) for i in range(80)]
    toxic = [(sentences(1000 + i, 60) + ("you idiot" if i % 2 else "so stupid"), 1) for i in range(60)]
    model = toxicity.fit(clean + toxic)
    tried = ["id.iot", "i d i o t", "idxiot", "stu-pid", "st_up_id"]
    scores = model.probability(toxicity.text_decisions(model, [f"{sentences(50, 30)} {w} {sentences(51, 30)}" for w in tried]))
    assert (scores >= 0.3).all()
    plain = model.probability(toxicity.text_decisions(model, [sentences(3000 + i, 90) for i in range(30)]))
    assert (plain < 0.3).all()


def test_scoring_cuts_words_where_fitting_does(spark):
    """Every kind of white space, runs of single letters over it, and words of several stretches."""
    clean = [(sentences(i, 60), 0) for i in range(80)]
    toxic = [(sentences(1000 + i, 60) + ("you idiot" if i % 2 else "so stupid"), 1) for i in range(60)]
    model = toxicity.fit(clean + toxic)
    spaces = [" ", "\xa0", "\x1c", "\x85", "\u2003", "\u3000", "\u2028", "\u1680", "\u205f", "\t", "\x1f\xa0"]
    texts = [f"{a}the{s}idiot{s}of{s}and{s}" for s in spaces for a in ("", "a b c ", "é\u200b ")]
    texts += [f"x{s}i{s}d{s}i{s}o{s}t{s}y" for s in spaces] + ["", None, "z" * 50 + "idiot", "â\x80 \u2060\ufeff", "idiot" * 12]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    shared = type("Shared", (), {"value": model})
    got = next(iter(toxicity._score(iter([batch]), shared, ["text"]))).column("score").to_numpy()
    want = model.probability(toxicity.text_decisions(model, texts))
    assert np.allclose(got, want)
    assert (want[: 3 * len(spaces)] >= 0.3).all()


def test_copies_spread_by_one_owner_are_examples(spark):
    opaque = "Zx9Qw3Er7Ty1Ui5Op2As4D"
    rows = [(i, f"k {opaque} k", "hot") for i in range(60)] + [(100, "k Qa8Ws2Ed6Rf4Tg1Yh9Uj3K k", "hot")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    found = {r.doc_id: r for r in scan_secrets(docs).collect()}
    assert (found[0].n_example, found[0].n_owner_specific, found[0].spans) == (1, 0, [])
    assert (found[100].n_example, found[100].n_owner_specific, len(found[100].spans)) == (0, 1, 1)


def test_folded_decision_is_the_kernel_expansion():
    codes = [toxicity.stretches(w)[0] for w in ("idiot", "stupid", "thered", "ination", "idxiot")]
    table = toxicity.landmark_table(codes[:3], 0.7)
    weights = np.array([0.5, -1.0, 2.0], np.float32)
    direct = toxicity.kernel_with(codes, table, 0.7) @ weights
    assert np.allclose(direct, toxicity.folded_decisions(codes, table @ weights, 0.7), atol=1e-5)
    assert np.allclose(np.diag(toxicity.kernel_with(codes[:3], table, 0.7)), 1, atol=1e-5)


def test_substring(spark, folder):
    rows = documents()
    seen = Counter()
    for _, text, *_ in rows:
        w = words_of(text)
        seen.update(" ".join(w[i : i + 35]) for i in range(len(w) - 34))
    want = Counter()
    for i, text, *_ in rows:
        w = words_of(text)
        gone = {i + k for i in range(len(w) - 34) if seen[" ".join(w[i : i + 35])] > 1 for k in range(35)}
        want[(i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))] += 1
    assert result(spark, folder, "op3_substring_dedup") == want


def test_substring_with_a_tiny_sketch(spark, folder):
    from logweir.llm.substring import RANGE, remove_repeats

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    small = remove_repeats(docs, depth=1, max_cells=RANGE)
    large = remove_repeats(docs, depth=3)
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.collect()))


def test_substring_in_a_crowded_sketch_of_many_ranges(spark, folder, monkeypatch):
    """Nearly every window shares its cells, so that single windows reach the exact grouping and stay."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    monkeypatch.setattr(substring, "PART", 1 << 7)
    small = substring.remove_repeats(docs, max_cells=1 << 10)
    large = substring.remove_repeats(docs)
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.collect()))


def test_the_sketch_grows_with_the_texts():
    for size in (0, 10**8, 10**10, 10**14):
        assert size // 3 <= 1 << substring.sketch_width(size) <= max(substring.RANGE, size)


@pytest.mark.parametrize("universe", [1, 100, 1 << 24, 1 << 31])
@pytest.mark.parametrize("count", [0, 1, 50, 5000])
def test_packed_places(universe, count):
    places = np.unique(np.random.default_rng(count).integers(0, universe, count))
    assert np.array_equal(substring.unpack(substring.pack(places, universe), len(places), universe), places)


def test_merged_sketches_lose_no_repeated_window():
    pick = np.random.default_rng(5)
    sent = [pick.integers(0, 2**63, 3000, dtype=np.uint64) for _ in range(4)]
    sent[1][:500] = sent[0][:500]
    sent[2][:200] = sent[2][200:400]
    width, part, rows, answers = 14, 1 << 9, [], []
    for number, first in enumerate(sent):
        for row in range(2):
            found, counts = np.unique(substring.cells(first, row, width), return_counts=True)
            for name, a, b in substring._cut(found // part):
                own = substring.pack(found[a:b] - name * part, part)
                rows.append((row, name, number, b - a, own, np.packbits(counts[a:b] > 1).tobytes()))
    for group in {(r[0], r[1]) for r in rows}:
        own = [r for r in rows if (r[0], r[1]) == group]
        answers += substring._merge(substring._table(own, substring.CELLS), part).to_pylist()
    seen = Counter(np.concatenate(sent).tolist())
    for number, first in enumerate(sent):
        mine = pa.Table.from_pylist([r for r in answers if r["block"] == number])
        passes = substring._passing(first, mine, 2, width, part)
        assert all(p for w, p in zip(first.tolist(), passes.tolist()) if seen[w] > 1)
        assert passes.mean() < 0.7


def test_embeddings(spark, folder):
    rows = vectors()
    good = [i for i, (_, v, _) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    arrays = {i: np.array(rows[i][1], np.float32).astype(float) for i in good}
    near = defaultdict(set)
    for a in good:
        for b in good:
            x, y = arrays[a], arrays[b]
            if a != b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                near[a].add(b)
    want = Counter()
    for i, (name, _, _) in enumerate(rows):
        reach, front = {i}, [i]
        while front:
            new = near[front.pop()] - reach
            reach |= new
            front += new
        least = min((rows[j][0] for j in reach if rows[j][0] is not None), default=None)
        want[(name, len(near[i]), least, name == least)] += 1
    assert result(spark, folder, "op4_embedding_near_dedup") == want


def test_list_decoding_is_complete():
    units = capfilter._unit(np.random.default_rng(1).normal(size=(50, 16)))
    first, second = capfilter.codebooks(16, 12, 17)
    scores = (units[:, :8] @ first)[:, :, None] + (units[:, 8:] @ second)[:, None, :]
    want = {(int(r), int(i * 12 + j)) for r, i, j in zip(*np.nonzero(scores >= 1.5))}
    assert set(zip(*(x.tolist() for x in capfilter.list_decode(units, 12, 1.5, 17)))) == want


@pytest.mark.parametrize("passes, bucket", [(24, 64), (4, 128)])
@pytest.mark.parametrize("count", [10_256, 1_000_000])
def test_cap_filters_keep_their_recall(count, passes, bucket):
    """Of fresh random pairs at the threshold, at least 99.5 % share a filter at every number of vectors."""
    share = bucket / count
    alpha, codes = NormalDist().inv_cdf(1 - share), math.ceil(math.sqrt(passes / share))
    a, b = np.random.default_rng(99).standard_normal((2, 600, 64))
    a = capfilter._unit(a)
    b = 0.95 * a + math.sqrt(1 - 0.95**2) * capfilter._unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    sides = [set(zip(*(x.tolist() for x in capfilter.passed_filters(v, codes, alpha, 17, 0.95, 0.999)))) for v in (a, b)]
    found = len({row for row, _ in sides[0] & sides[1]})
    print(count, capfilter.repetitions(64, codes, alpha, 17, 0.95, 0.999), found / 600)
    assert found >= 0.995 * 600


def test_embeddings_near_the_threshold_and_in_cut_filters(spark):
    """Pairs closer to the threshold than codes can tell, and filters of many blocks, against all pairs in doubles."""
    random = np.random.default_rng(3)
    rows = []
    for _ in range(12):
        a, b = random.standard_normal((2, 16))
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [a] + [c * a + np.sqrt(1 - c * c) * b for c in (0.95 - 1e-6, 0.95 + 1e-6, 0.949, 0.951)]
    base = random.standard_normal(16)
    rows += [base + 0.12 * random.standard_normal(16) for _ in range(60)]
    units = capfilter._unit(np.array(rows))
    near = units @ units.T >= 0.95
    np.fill_diagonal(near, False)
    dots = np.abs(units @ units.T - 0.95)
    assert (dots < capfilter.slack(16)).sum() >= 24
    least = np.arange(len(rows))
    for _ in rows:
        least = np.minimum(least, np.where(near, least, len(rows)).min(axis=1))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rows)], "vec_id bigint, embedding array<double>")
    found = capfilter.near_embeddings(frame, block=8, recall=0.999999).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in found} == {
        (i, int(near[i].sum()), int(least[i])) for i in range(len(rows))
    }


def test_language_model(spark, folder):
    rows = documents()
    lines = [[w.encode() for w in []] or [x for x in (t or "").encode().lower().split()] + ["end"] for _, t, *_ in rows]
    train = [zlib.crc32(str("" if i is None else i).encode()) % 5 != 1 for i, *_ in rows]
    single = Counter(w for line, ok in zip(lines, train) if ok for w in line)
    total, types = sum(single.values()), len(single)
    common = {w for w, n in single.items() if n >= 2}
    pairs, triples = Counter(), Counter()
    for line, ok in zip(lines, train):
        full = ["begin", *line]
        if ok:
            pairs.update((a, b) for a, b in zip(full, full[1:]) if {a, b} <= common | {"begin"})
            triples.update(t for t in zip(full, full[1:], full[2:]) if set(t) <= common | {"begin"})
    pairs = {k: n for k, n in pairs.items() if n >= 2}
    triples = {k: n for k, n in triples.items() if n >= 2 and k[:2] in pairs and k[1:] in pairs}
    context = single | {"begin": sum(train)}
    after, after2 = defaultdict(list), defaultdict(list)
    for a, b in pairs:
        after[a].append(b)
    for a, b, c in triples:
        after2[a, b].append(c)

    def p1(w):
        return (single[w] + 0.5) / (total + 0.5 * (types + 1))

    def p2(a, w):
        if (a, w) in pairs:
            return (pairs[a, w] - 0.75) / context[a]
        left = 1 - sum((pairs[a, x] - 0.75) / context[a] for x in after[a])
        return left / (1 - sum(p1(x) for x in after[a])) * p1(w)

    def p3(a, b, w):
        if (a, b) not in pairs:
            return p2(b, w)
        if (a, b, w) in triples:
            return (triples[a, b, w] - 0.75) / pairs[a, b]
        left = 1 - sum((triples[a, b, x] - 0.75) / pairs[a, b] for x in after2[a, b])
        return left / (1 - sum(p2(b, x) for x in after2[a, b])) * p2(b, w)

    want = defaultdict(list)
    for (i, *_), line, ok in zip(rows, lines, train):
        full = ["begin", *line]
        value = math.log10(p2("begin", line[0])) + sum(math.log10(p3(*t)) for t in zip(full, full[1:], full[2:]))
        base = sum(math.log10(p1(w)) for w in line)
        want[i].append((not ok, len(line), sum(single[w] > 0 for w in line), total, base, value))
    got = defaultdict(list)
    for r in QUERIES["op5_lm_scoring"](spark, folder).collect():
        got[r.doc_id].append(tuple(r)[1:])
    assert got.keys() == want.keys()
    assert max(len(line) for line in lines) > 30_000
    for i in want:
        for a, b in zip(sorted(got[i]), sorted(want[i])):
            assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=1e-6), i


def test_automaton_reads_stretches_like_whole_texts(spark, monkeypatch):
    """Long texts are cut into stretches; stretches of one and of three words give the same scores and keep every text apart."""
    from logweir.llm import lm

    random = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in random.zipf(1.4, size) % 50) for size in (0, 1, 2, 3, 700, 40, 257)]
    hashed = lm._hash_line(pa.array(texts))
    words, packed = lm._pack_line(hashed)
    block = {"words": words, "line": packed, "size": len(hashed), "trained": np.packbits(np.ones(7, bool)).tobytes()}
    line = lm.Line(block)
    assert (line.line == hashed).all() and line.counts.tolist() == [0, 1, 2, 3, 700, 40, 257]
    sent = lm._send_grams(0, line, 4, [(1, line.words), (2, line.pairs)])

    def answers(sent: pa.Table, answer) -> list[pa.Table]:
        rows = sent.to_pylist()
        groups = sorted({(r["kind"], r["bucket"]) for r in rows})
        return [answer(pa.Table.from_pylist([r for r in rows if (r["kind"], r["bucket"]) == g], sent.schema), 4) for g in groups]

    found = answers(sent, lm._answer_counts)
    known = lm.Known(block, pa.concat_tables(found), 4)
    found += answers(lm._send_grams(0, line, 4, [(3, known.grams)]), lm._answer_counts)
    known = lm.Known(block, pa.concat_tables(found), 4).with_triples()
    found += answers(lm._send_contexts(known, 0), lm._answer_contexts)
    total = sum(t.column("tokens").to_pylist()[0] for t in found if t.num_rows)
    types = sum(t.column("types").to_pylist()[0] for t in found if t.num_rows)
    mass = total + 0.5 * (types + 1)
    automaton = lm.Known(block, pa.concat_tables(found), 4).with_triples().weigh(mass, 0.75).automaton()
    whole = automaton.read(line)
    for stretch in (1, 3, 10_000):
        monkeypatch.setattr(lm, "STRETCH", stretch)
        assert automaton.read(line) == pytest.approx(whole, abs=1e-9)
    # after any context the probabilities of all words and of one unknown word add up to one
    every = np.arange(len(line.words.keys))
    every = every[line.words.keys != lm.BEGIN]
    for state in random.choice(len(automaton.failure), 60):
        _, gained = automaton.step(np.full(len(every), state), every)
        unknown, at = math.log10(0.5 / mass), state
        while at:
            unknown, at = unknown + automaton.backoff[at], automaton.failure[at]
        assert (10.0**gained).sum() + 10.0**unknown == pytest.approx(1, abs=1e-9)


def test_language_model_keeps_every_repeated_gram(spark):
    """A pair and a triple seen twice stay, however many other tokens the corpus has."""
    from logweir.llm.lm import score

    filler = [(i, " ".join(f"w{(i * 7919 + k * k) % 50_000}" for k in range(5_000))) for i in range(250)]
    rows = spark.createDataFrame([*filler, (900, "zig zag zug"), (901, "zig zag zug")], "doc_id int, text string")
    found, tokens = score(rows, F.lit(True), ["doc_id"])
    assert tokens == 250 * 5_001 + 8
    got = {r.doc_id: r for r in found.where("doc_id >= 900").collect()}
    p1 = (2 - 0.75) / 252
    assert got[900].score == got[901].score == pytest.approx(math.log10(p1) + 3 * math.log10(1.25 / 2), abs=1e-9)


def test_token_files(spark, folder):
    tokenizer = Tokenizer.from_file(PATH)
    rows = sorted(documents(), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(QUERIES["op6_token_files"](spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r[0] for r in rows]
    start, sums = 0, Counter()
    for i, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        sums[(i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sums


def test_token_runs_are_those_of_the_library():
    tokenizer, pick = Tokenizer.from_file(PATH), random.Random(9)
    letters = "aaAbBeEilnorstthxyz019'!?.,;:-$ßéñöİΣ日\u0301\u0307ﬁ² ÀÞÿ×÷ªµº¼|<\x1c\x85\xa0"
    texts = ["".join(pick.choices(letters, k=pick.randint(1, 40))) for _ in range(3000)]
    texts += ["<|ENDOFTEXT|>a. B.", "<|endoftext|>A. b.", "x<|StartOfText|>y,", "İ. I. A.. a.. A'S. 1.", "<|endoftext|>."]
    codes, width = encode_texts(texts, PATH)
    got = [np.frombuffer(x, f"<u{width}").tolist() for x in codes]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("values", [[], [0], [5], [1, 1, 1], [0, 3, 3, 900], list(range(0, 9000, 7)), [2**40, 2**40 + 1]])
def test_elias_fano(values):
    packed = EliasFano.encode(np.array(values, np.int64))
    assert packed.decode().tolist() == values
    assert [packed.select(i) for i in range(len(values))] == values


def test_decontamination(spark, folder):
    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))

    windows = defaultdict(set)
    for item, text in ITEMS:
        w = split(text)
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    sizes = {len(w) for w in windows}
    want = Counter()
    for i, text, *_ in documents():
        w, hit, items = split(text), set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[at : at + n]))) is not None:
                    hit |= set(range(at, at + n))
                    items |= found
        want[(i, len(w), len(hit), len(items), sha(",".join(sorted(map(str, items)))), bool(hit))] += 1
    assert result(spark, folder, "op7_decontamination") == want
    assert sum(k[5] for k in want) >= 4


def test_decontamination_is_native(spark, folder):
    plan = QUERIES["op7_decontamination"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_simhash(spark, folder):
    rows = documents()
    prints = []
    for _, text, *_ in rows:
        w = (text or "").encode().lower().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))] if w else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    want = Counter()
    for i, (name, *_) in enumerate(rows):
        reach, front = {i}, [i]
        while front:
            at = front.pop()
            new = {j for j in range(len(rows)) if j not in reach and (prints[at] ^ prints[j]).bit_count() <= 4}
            reach |= new
            front += new
        least = min((rows[j][0] for j in reach if rows[j][0] is not None), default=None)
        want[(name, f"{prints[i]:016x}", least)] += 1
    assert result(spark, folder, "op8_simhash_near_dedup") == want


def test_golay_keys_lose_no_pair():
    pick = random.Random(5)
    for _ in range(300):
        a = pick.getrandbits(64)
        b = a
        for bit in pick.sample(range(64), pick.randint(0, 4)):
            b ^= 1 << bit
        keys, owners = simhash.keys_of(np.array([a, b], np.uint64).view(np.int64))
        assert set(keys[owners == 0].tolist()) & set(keys[owners == 1].tolist())
    words = np.arange(1 << 23, dtype=np.int32)
    assert (np.bincount(simhash.decode(words)) == 2048).all()


def test_simhash_splits_hot_buckets(spark):
    values = [0b1011 << 20 | i for i in range(64)]
    prints = spark.createDataFrame([(v,) for v in values], "fingerprint bigint")
    edges = {tuple(r) for r in simhash.linked_fingerprints(prints, block=5).collect()}
    reach, front = {values[0]}, [values[0]]
    while front:
        at = front.pop()
        new = {b for a, b in edges if a == at} | {a for a, b in edges if b == at}
        front += new - reach
        reach |= new
    assert reach == set(values) and all((a ^ b).bit_count() <= 4 for a, b in edges)


def test_training_sample_takes_one_row_a_key(spark):
    from logweir.llm.fitting import training_sample

    docs = spark.createDataFrame([(1, f"t{i}") for i in range(50)] + [(2, "b")], "doc_id int, text string")
    marks = spark.createDataFrame([(1, 0), (2, 1)], "doc_id int, toxic int")
    assert training_sample(docs, marks, "toxic", F.lit(False), 5, ["text"]) == [("b", 1), ("t0", 0)]


def test_training_texts_are_read_by_block(monkeypatch):
    from logweir.llm import quality

    rows = [(None if i % 50 == 7 else sentences(i, i % 40 * 10), None if i % 9 == 4 else i, i % 2) for i in range(2000)]
    texts, stated = [r[0] for r in rows], [r[1] for r in rows]
    whole, read = quality.extract, []
    monkeypatch.setattr(quality, "extract", lambda a, b: read.append(sum(len(x or "") for x in a.to_pylist())) or whole(a, b))
    model = quality.fit(rows, epochs=1)
    assert len(read) > 3 and max(read) <= 1 << 18 and sum(read) == sum(len(x or "") for x in texts)
    assert model.constant is None
    want, got = whole(pa.array(texts, pa.string()), pa.array(stated, pa.int64())), quality.extract_rows(texts, stated)
    for name in ("text", "bucket", "value", "dense"):
        assert np.array_equal(getattr(want, name), getattr(got, name)), name


def test_texts_are_encoded_by_small_blocks(monkeypatch):
    from logweir.llm import bpe

    texts = [sentences(i, 400) for i in range(8)] * 150
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    encode, read = bpe.encode_column, []
    monkeypatch.setattr(bpe, "encode_column", lambda a, path: read.append(sum(map(len, a.to_pylist()))) or encode(a, path))
    out = list(bpe._encode(iter([batch]), PATH, ["doc_id", "n_tokens", "ids", "decoded"], False))
    assert sum(len(t) for t in texts) > 2 << 20 and max(read) <= 1 << 20
    ids = [x for block in out for x in block.column(2).to_pylist()]
    tokenizer = Tokenizer.from_file(PATH)
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts[:8]]
    assert ids == want * 150


def test_scoring_sends_a_passed_text_once(spark):
    from logweir.llm import quality

    docs = spark.createDataFrame([(i, sentences(i, 30 + i % 7), 100 + i) for i in range(40)], "doc_id bigint, text string, n_chars bigint")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    scored = quality.score_quality(docs, labels, F.lit(False), docs.columns)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    sent = next(line for line in plan.splitlines() if "Project [" in line)
    assert sent.count("text#") == 1, sent
    apart = quality.score_quality(docs, labels, F.lit(False), ["doc_id"]).collect()
    want = {r.doc_id: r.score for r in apart}
    got = {r.doc_id: r for r in scored.collect()}
    assert len(got) == 40 and all(abs(r.score - want[i]) < 1e-12 and r.text for i, r in got.items())


def test_quality(spark, folder):
    rows = QUERIES["op9_quality"](spark, folder).collect()
    assert len(rows) == len(documents()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    by_id = {r.doc_id: r for r in rows}
    held = [i for i in range(40) if by_id[300 + i].held_out]
    assert held and all(by_id[300 + i].predicted == i % 2 for i in held)


def test_sum_of_squares_identity():
    from logweir.llm.quality import BUCKETS, RANK, Features, QualityModel

    pick = np.random.default_rng(2)
    model = QualityModel(0.3, pick.normal(size=BUCKETS + 3), pick.normal(size=(BUCKETS + 3, RANK)), np.zeros(3), np.ones(3))
    bucket, value, dense = np.array([4, 9, 77]), np.array([0.2, 0.5, 0.1]), np.array([[0.3, -0.2, 1.0]])
    index = np.concatenate([bucket, BUCKETS + np.arange(3)])
    x = np.concatenate([value, dense[0]])
    want = 0.3 + x @ model.weights[index]
    for i in range(6):
        for j in range(i + 1, 6):
            want += model.factors[index[i]] @ model.factors[index[j]] * x[i] * x[j]
    assert model.decisions(Features(np.zeros(3, int), bucket, value, dense))[0] == pytest.approx(want)


def test_select_reads_single_ends_and_stretches():
    pick = random.Random(12)
    for count in (1, 2, 255, 256, 257, 1000, 5000):
        for most in (1, 3, 200, 10**6):
            values = np.cumsum([pick.randint(0, most) for _ in range(count)])
            packed = EliasFano.encode(values)
            assert (packed.decode() == values).all()
            assert all(packed.select(i) == values[i] for i in (0, count - 1, count // 2, min(count - 1, 256)))
            a, b = sorted(pick.choices(range(count + 1), k=2))
            assert (packed.stretch(a, b) == values[a:b]).all()
            assert len(packed.samples) == 4 * -(-count // 256)


def test_documents_are_fetched_by_key(spark, folder):
    location = staged_path(spark)
    write_tokens(spark.read.parquet(f"{folder}/documents.parquet"), location, PATH, size=500)
    tokenizer = Tokenizer.from_file(PATH)
    for keys in ([5, 135, 131], [None], [None, 150], [987654321]):
        want = Counter((i, tuple([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2])) for i, t, *_ in documents() if i in keys)
        assert Counter((r.doc_id, tuple(r.ids)) for r in fetch_tokens(spark, location, keys).collect()) == want


def test_bpe(spark, folder):
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text, *_ in documents():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        want[(i, len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False)))] += 1
    assert result(spark, folder, "op10_bpe") == want


def test_bpe_random_words():
    merges, tokenizer, pick = Merges(PATH), Tokenizer.from_file(PATH), random.Random(8)
    letters = "aaabeeeilnorstthxyz0129'!?.-$ßéñö日́ ﬁ²"
    runs = ["".join(pick.choices(letters, k=pick.randint(1, 14))).replace(" ", "") or "x" for _ in range(4000)]
    runs += ["a" * n for n in range(1, 40)] + ["the" * n for n in range(1, 12)]
    assert merges.encode_runs(runs) == [e.ids for e in tokenizer.encode_batch(runs, add_special_tokens=False)]


def test_bpe_cuts_ascii_texts_without_a_loop_over_runs(monkeypatch):
    seen, pieces = [], Merges.pieces
    monkeypatch.setattr(Merges, "pieces", lambda self, runs: seen.append(runs) or pieces(self, runs))
    pick, tokenizer = random.Random(31), Tokenizer.from_file(PATH)
    bits = ["'", "'s", "'S", "'re", "'LL", "'d", "''", "the", "Ing", "1", "23", "..", "!?", "\x1c", "\x00", "\x7f", "<|", " ", " ", "\n", "\t", "x" * 40]
    texts = [None, "", " \n", *("".join(pick.choices(bits, k=pick.randint(0, 12))) for _ in range(3000))]
    strange = ["te", "<|endof", "text|> a<|endoftext|>'s", "<|EndOfText|>", "ΣΑΣ'S é1 \x85 　日本　", "e\u0301 E\u0301 ﬁ"]
    merges = Merges(PATH)
    for some in (texts, texts + strange, strange * 2, [None], []):
        coded = merges.encode(pa.array(some, pa.string()))
        assert seen == [] or some is not texts
        want = [e.ids for e in tokenizer.encode_batch([t or "" for t in some], add_special_tokens=False)]
        assert coded.ids().to_pylist() == want and coded.counts().tolist() == [len(x) for x in want]
        assert coded.decoded() == [tokenizer.decode(x, skip_special_tokens=False) for x in want]
    assert seen and not any(run.isascii() and b"|" not in run for runs in seen for run in runs)


def test_bpe_remembers_frequent_words(monkeypatch):
    encoded, encode = Counter(), Merges.encode_words
    monkeypatch.setattr(Merges, "encode_words", lambda self, words: encoded.update(words) or encode(self, words))
    merges, tokenizer = Merges(PATH, memory=60), Tokenizer.from_file(PATH)
    for block in range(30):
        text = f"Often, (often) often! {sentences(700 + block, 40)}"
        assert merges.encode_runs([text]) == [tokenizer.encode(text, add_special_tokens=False).ids]
        assert len(merges.words.new) < 60 + 60 and len(merges.words.old) < 60 + 60
    assert encoded[b"often"] == 1 and encoded.total() > 120


def test_pipeline(spark, folder):
    """Each stage against its operator on the stage's own input, and the contents that must go or stay."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    columns = docs.columns
    seen = []
    for _, step in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.stage(step(spark, kept, folder))
        assert kept.columns == columns
        seen.append(Counter((r.doc_id, r.text) for r in kept.collect()))
    assert all(b.total() <= a.total() for a, b in zip(seen, seen[1:]))
    junk = {300 + i for i in range(0, 40, 2)}
    assert not junk & {i for i, _ in seen[0]} and {i for i, _ in seen[0]} >= set(range(40))
    assert len({i for i, _ in seen[1]} & set(range(100, 112))) == 1  # near copies
    assert not {136, 138, 139} & {i for i, _ in seen[2]}
    texts = dict(k for k in seen[3] if k[0] is not None)
    assert all("hunter" not in (t or "") and "AKIAQ7" not in (t or "") for t in texts.values())
    final = corpus_pipeline.run(spark, folder)
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter((i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids)) for (i, t), n in seen[3].items() for _ in range(n))
    assert Counter((r.doc_id, tuple(r.ids)) for r in final.collect()) == want


def test_pipeline_near_copies_by_fingerprint(spark, folder):
    """Of each group of fingerprints linked at four bits the least id stays, and of rows without an id one."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    grouped = defaultdict(list)
    for row in QUERIES["op8_simhash_near_dedup"](spark, folder).collect():
        grouped[row.component_id].append(row.doc_id)
    want = Counter(min(ids, key=lambda i: (i is None, i or 0)) for ids in grouped.values())
    assert Counter(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, folder).collect()) == want
    assert sum(want.values()) < docs.count()


def test_pipeline_keeps_columns_of_any_name(spark, folder):
    names = ["__text", "__row", "row", "key", "row_number", "Score", "hit_key", "found_spans", "spans", "fingerprint", "component_id", "c0", "c1", "place", "words"]
    rows = [(i, t, "en", f"s{i}", len(t), *range(len(names))) for i, t in ((1, sentences(1, 60)), (2, f"{sentences(2, 60)} password = hunter22"), (3, sentences(3, 60)))]
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{n}` int" for n in names)
    docs = spark.createDataFrame(rows, kind)
    columns = docs.columns
    for _, step in corpus_pipeline.STAGES[1:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, folder))
        assert docs.columns == columns
    assert {tuple(r)[5:] for r in docs.collect()} == {tuple(range(len(names)))} and docs.count() == 3
    assert corpus_pipeline.quality(spark, docs, folder).columns == columns


def test_decontamination_counts_rows_of_one_id_apart(spark, folder):
    rows = [(1, ITEMS[2][1]), (1, "clean words"), (None, ITEMS[2][1]), (None, None), (None, "clean")]
    docs = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id bigint, text string, row int, place int")
    benchmark = spark.read.parquet(f"{folder}/benchmark.parquet")
    n = len(ITEMS[2][1].split())
    found = Counter((r.doc_id, r.n_words, r.n_hit, r.contaminated) for r in decontaminate(docs, benchmark).collect())
    assert found == Counter([(1, n, n, True), (1, 2, 0, False), (None, n, n, True), (None, 0, 0, False), (None, 1, 0, False)])


def test_pipeline_decontamination_keeps_clean_rows_of_a_repeated_id(spark, folder):
    rows = [(i, t) for i in (1, None) for t in (ITEMS[2][1], f"clean words {i}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.decontamination(spark, docs, folder).collect()
    assert {tuple(r) for r in kept} == {(1, "clean words 1"), (None, "clean words None")}


def test_pipeline_of_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0
