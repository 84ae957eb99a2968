"""Secret scan with corpus-wide ownership frequency.

Every text gives candidates: the three base patterns, and opaque words, which mix cases and digits like a credential.
The hash of each candidate's value is counted by distinct repositories and owners. A value of many owners is a copied
example; one that few owners have is specific to them and looks live. Base matches are always reported; opaque words
only if they are owner-specific.

Spans are code points, end exclusive. Matches of a pattern do not overlap, the leftmost one wins; a match that fails its
length is dropped and its text is not searched again. Defined results: a null text is empty; a null repository or owner
is a value of its own; a repeated row gets the same spans again; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.staging import stage
from logweir.llm.words import blocks

#: Fixed values of the contract: patterns, least lengths and order of the base kinds.
ASSIGN = re.compile(
    r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
    r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "opaque")
#: Words that may be credentials without a name beside them.
OPAQUE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")

SPANS = "array<struct<kind:string,start:int,end:int,value:string>>"


def entropy(text: str) -> float:
    """Bits a character."""
    return -sum(n / len(text) * math.log2(n / len(text)) for n in Counter(text).values())


def looks_opaque(word: str, bits: float) -> bool:
    mixed = re.search("[0-9]", word) and re.search("[a-z]", word) and re.search("[A-Z]", word)
    return bool(mixed) and entropy(word) >= bits


def candidates(text: str | None, bits: float = 3.5) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of all candidates, by start and then kind."""
    if not text:
        return []
    found = [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [("hex", *m.span(), m[0]) for m in HEX.finditer(text)]
    taken = [(a, b) for _, a, b, _ in found]
    for m in OPAQUE.finditer(text):
        if looks_opaque(m[0], bits) and all(m.end() <= a or b <= m.start() for a, b in taken):
            found.append(("opaque", *m.span(), m[0]))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _scan(batches: Iterator[pa.RecordBatch], bits: float, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches):
        spans = [
            [
                {"kind": k, "start": a, "end": b, "value": xxhash.xxh3_128_hexdigest(value.encode())}
                for k, a, b, value in candidates(x.as_py(), bits)
            ]
            for x in batch.column("text")
        ]
        columns = [batch.column(c) for c in ("key", "repository", "owner")]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], names=["key", "repository", "owner", "spans"])


def ownership(values: DataFrame) -> DataFrame:
    """(value, repositories, owners): how many distinct ones have each value. Partial counts leave each task only."""
    owners = values.select("value", "owner").distinct().groupBy("value").agg(F.count("*").alias("owners"))
    homes = values.select("value", "repository").distinct().groupBy("value").agg(F.count("*").alias("repositories"))
    return owners.join(homes, "value")


def scan_secrets(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    repository: str = "doc_id",
    owner: str = "source",
    example_owners: int = 3,
    example_repositories: int = 50,
    bits: float = 3.5,
) -> DataFrame:
    """(key, spans, n_example, n_owner_specific) of every row.

    ``spans`` is an array of (start, order, kind, end, owners, repositories), sorted. A value is an example if at least
    ``example_owners`` owners have it, or one owner spreads it over ``example_repositories`` repositories or more, as a hot source
    does with a line of its template; the two counts are of the reported base spans and all candidates.
    """
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])
    types = {c: docs.schema[n].dataType.simpleString() for c, n in (("key", key), ("repository", repository), ("owner", owner))}
    source = docs.select(
        F.col(key).alias("key"), F.col(repository).alias("repository"), F.col(owner).alias("owner"), F.col(text).alias("text")
    )
    kind = ", ".join(f"{c} {t}" for c, t in types.items())
    found = stage(
        source.mapInArrow(lambda x: _scan(x, bits, pa.list_(span)), f"{kind}, spans {SPANS}").withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    each = found.select("row", "repository", "owner", F.explode("spans").alias("span"))
    counts = ownership(each.select(F.col("span.value").alias("value"), "repository", "owner"))
    judged = each.select("row", "span", F.col("span.value").alias("value")).join(counts, "value")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("span.kind")).alias("order")
    example = (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories)
    kept = F.struct("span.start", order, "span.kind", "span.end", "owners", "repositories")
    spans = judged.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when((F.col("span.kind") != "opaque") | ~example, kept))).alias("spans"),
        F.count(F.when(example, 1)).alias("n_example"),
        F.count(F.when(~example, 1)).alias("n_owner_specific"),
    )
    empty = F.array().cast(spans.schema["spans"].dataType)
    return found.join(spans.withColumnRenamed("spans", "judged"), "row", "left").select(
        F.col("key").alias(key),
        F.coalesce("judged", empty).alias("spans"),
        F.coalesce("n_example", F.lit(0)).alias("n_example"),
        F.coalesce("n_owner_specific", F.lit(0)).alias("n_owner_specific"),
    )


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch that spans cover replaced by ``mark``."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("end"))
    done = F.aggregate(
        spans,
        state,
        lambda s, x: F.when(
            x.start >= s.end,
            F.struct(
                F.concat(s.out, F.substring(text, s.end + 1, x.start - s.end), F.lit(mark)).alias("out"), x.end.alias("end")
            ),
        ).otherwise(F.struct(s.out.alias("out"), F.greatest(s.end, x.end).alias("end"))),
    )
    rest = F.substring(text, done.end + 1, F.length(text))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(done.out, rest))
