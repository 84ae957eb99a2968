"""Registered queries of the operators, and the SQL of those that SQL can express.

Each query applies its operator to its whole table; only the digest columns are made here.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm.bpe import encode_decode
from logweir.llm.capfilter import near_embeddings
from logweir.llm.decontaminate import decontaminate
from logweir.llm.lloyd import compress, digest, label_errors
from logweir.llm.lm import held_out, score
from logweir.llm.quality import score_quality
from logweir.llm.ranked import search
from logweir.llm.secrets import KINDS, listed, scan_secrets
from logweir.llm.simhash import near_duplicates
from logweir.llm.staging import stage, staged_path
from logweir.llm.substring import remove_repeats
from logweir.llm.tokenfile import read_tokens, write_tokens
from logweir.llm.toxicity import score_toxicity
from logweir.llm.wholetoken import count_tokens

#: Where the public vocabulary is; the environment may name another copy.
TOKENIZER = os.environ.get("LOGWEIR_TOKENIZER", public_tokenizers.path("word_bpe_49k.json"))
PIECE_MODEL = os.environ.get("LOGWEIR_PIECE_MODEL", public_tokenizers.path("piece_bpe_32k.model"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def count_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("bigint")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.kind != "opaque")
    counts = [count_of(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed("spans").alias("spans"),
        "n_example", "n_owner_specific",
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(F.col("doc_id"), 4, 2)
    found = score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), out, ["doc_id"])
    return found.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embeddings(read(spark, sf_dir, "embeddings"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(F.col("doc_id"), 5, 1)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", out.alias("held_out"))
    found, tokens = score(docs, ~F.col("held_out"), ["doc_id", "held_out"])
    return found.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score",
    )


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = staged_path(spark)
    write_tokens(read(spark, sf_dir, "documents"), location, TOKENIZER)
    return read_tokens(spark, location)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = held_out(F.col("doc_id"), 5, 0)
    found = score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), out, ["doc_id"])
    return found.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read(spark, sf_dir, "documents"), TOKENIZER, digests=True)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"), PIECE_MODEL)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(read(spark, sf_dir, "embeddings"))
    return label_errors(stage(coded)).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_toxicity, op3_substring_dedup, op4_embedding_near_dedup, op5_lm_scoring, op6_token_files,
        op7_decontamination, op8_simhash_near_dedup, op9_quality, op10_bpe, op11_token_counts, op12_ranked_search,
        op13_vector_codes,
    )
}

OP3_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i : i + 34], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35)
), again AS (
  SELECT doc_id, i FROM windows JOIN (SELECT g FROM windows GROUP BY g HAVING count(*) > 1) USING (g)
), gone AS (
  SELECT doc_id, list(DISTINCT p) AS p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM again) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(p), 0)::BIGINT AS n_removed,
  sha256(array_to_string(
    CASE WHEN p IS NULL THEN w ELSE list_filter(w, lambda x, k: NOT list_contains(p, k::BIGINT)) END, ' ')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""

OP4_SQL = r"""
WITH RECURSIVE good AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, m AS component_id, vec_id = m AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON vec_id = a
JOIN (SELECT a AS v, min(b) AS m FROM reach GROUP BY a) ON vec_id = v
"""

OP7_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), items AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + 9], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM bw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM items
), windows AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw JOIN sizes ON len(w) >= n)
), hits AS (SELECT doc_id, i, n, item_id FROM windows JOIN items USING (n, g)
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP12_SQL = r"""
WITH dt AS (
  SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), it AS (
  SELECT item_id, row_number() OVER () AS q,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark
), total AS (SELECT count_if(len(w) > 0) AS n, sum(len(w))::BIGINT AS l FROM dt
), tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM dt) GROUP BY r, t
), df AS (SELECT t, floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, total GROUP BY t, n
), wanted AS (SELECT q, t, count(*) AS times FROM (SELECT q, unnest(w) AS t FROM it) GROUP BY q, t
), docs AS (SELECT doc_id, r, 100 - 25 + ((25 * len(w) * n) // l) AS m FROM dt, total WHERE len(w) > 0
), scored AS (
  SELECT q, r, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM wanted JOIN tf USING (t) JOIN df USING (t) JOIN docs USING (r) GROUP BY q, r
), ranked AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
  FROM scored JOIN docs USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked JOIN it USING (q) WHERE rank <= 20
"""


def _op13_sql() -> str:
    """SQL for vectors of 64 components: 16 parts of x1 to x4."""
    each = lambda form: ", ".join(form.format(i=i) for i in (1, 2, 3, 4))
    apart = " + ".join(f"(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})" for i in (1, 2, 3, 4))
    assign = (
        "SELECT vec_id, p, any_value(label) AS label, {x}, min(d * 64 + e) % 64 AS e, min(d * 64 + e) // 64 AS d FROM "
        "(SELECT a.vec_id, a.label, a.p, a.x1, a.x2, a.x3, a.x4, b.e, {apart} AS d FROM parts a JOIN c{k} b ON a.p = b.p) "
        "GROUP BY vec_id, p"
    )
    update = "SELECT c.p, c.e, {x} FROM c{k} c LEFT JOIN (SELECT p, e, count(*) AS n, {s} FROM a{k} GROUP BY p, e) s ON c.p = s.p AND c.e = s.e"
    steps = []
    for k in (0, 1, 2):
        steps.append(f"a{k} AS MATERIALIZED (" + assign.format(x=each("any_value(x{i}) AS x{i}"), apart=apart, k=k) + ")")
        if k < 2:
            x = each("coalesce(floor(s.s{i} / s.n)::BIGINT, c.x{i}) AS x{i}")
            steps.append(f"c{k + 1} AS MATERIALIZED (" + update.format(x=x, s=each("sum(x{i}) AS s{i}"), k=k) + ")")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, p, {each("v[p * 4 + {i}] AS x{i}")} FROM kept, (SELECT unnest(range(16)) AS p)
), c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, {each("x{i}")} FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64)
), {", ".join(steps)}, coded AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM a2 GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(concat_ws(',', x1, x2, x3, x4), ',' ORDER BY p, e)) FROM c2) AS codebooks_sha256
FROM coded
"""


ORACLE_SQL = {
    "op3_substring_dedup": OP3_SQL,
    "op4_embedding_near_dedup": OP4_SQL,
    "op7_decontamination": OP7_SQL,
    "op12_ranked_search": OP12_SQL,
    "op13_vector_codes": _op13_sql(),
}
