"""From raw documents to token ids in five stages, each of which reads what the one before it wrote.

1. quality: documents that the factorisation machine scores below 0.3 go.
2. near_dedup: of each group that SimHash fingerprints of four-word shingles link at four or fewer differing bits the row
   with the smallest ``doc_id`` stays, nulls last.
3. decontamination: documents with a benchmark passage go.
4. secrets: every reported secret is replaced by ``[SECRET]``; ``n_chars`` of changed texts is set anew.
5. bpe: ids and decoded text of every document left.

Defined results: rows are told apart by their place, so repeated and null ``doc_id`` are rows like all others; null texts are
empty; an empty table gives an empty result; further columns, whatever their names, are carried through stages 1 to 4.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.llm.bpe import encode_decode
from logweir.llm.decontaminate import without_contamination
from logweir.llm.lm import held_out
from logweir.llm.quality import score_quality
from logweir.llm.queries import TOKENIZER, read
from logweir.llm.secrets import redact, scan_secrets
from logweir.llm.simhash import near_duplicates
from logweir.llm.staging import release, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = f"_{name}"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out, score = held_out(F.col("doc_id"), 5, 0), free(docs, "score")
    scored = score_quality(docs, read(spark, sf_dir, "labels"), out, docs.columns, name=score)
    return scored.where(F.col(score) >= 0.3).drop(score)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a row number that stays the same however often they are read, and its column's name."""
    row = free(docs, "row_number")
    return stage(docs.withColumn(row, F.monotonically_increasing_id())), row


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = numbered(docs)
    groups = near_duplicates(rows.select(row, "text"), key=row).select(row, "component_id")
    release(spark)  # the rounds behind the groups are staged; their plans and shuffle files need not outlive them
    first = F.struct(F.col("doc_id").isNull(), "doc_id", row)
    members = groups.join(rows.select(row, "doc_id"), row)
    kept = members.groupBy("component_id").agg(F.min(first).alias("first")).select(F.col(f"first.{row}").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = numbered(docs)
    return without_contamination(rows, read(spark, sf_dir, "benchmark"), key=row).drop(row)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, row = numbered(docs)
    found = scan_secrets(rows, key=row, repository="doc_id", owner="source").where(F.size("spans") > 0)
    name = free(rows, "found_spans")
    joined = rows.join(found.select(row, F.col("spans").alias(name)), row, "left")
    spans, text = F.col(name), F.col("text")
    changed = F.when(spans.isNull(), text).otherwise(redact(text, spans))
    length = F.when(spans.isNull(), F.col("n_chars")).otherwise(F.length(changed).cast("bigint"))
    return joined.withColumns({"text": changed, "n_chars": length}).select(*docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_decode(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("bpe", bpe),
]

#: The first stage is a trained model, so no SQL gives these rows; the tests hold each stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
