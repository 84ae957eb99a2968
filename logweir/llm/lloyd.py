"""Product codes of vectors, with codebooks trained by member-resident Lloyd rounds.

Every component x becomes the whole number floor(256 x) and every vector is cut into equal consecutive *parts*. Each part
position has a codebook, which starts as the parts of the vectors with the smallest keys.

The parts are *members* of the entry they are nearest to. They reside in the partitions of a written table dealt by (position,
entry, salt), and a round is

1. **update**: the owners add up the members that reside with them; only one sum for each entry and partition is shuffled, and
   the new codebooks, entries x components numbers, are all that the driver gets;
2. **migrate**: every member is compared with the new codebook of its position where it resides; members that keep their
   entry stay in place, and only those whose entry changes are shuffled, to the partition of their new owner.

After the last update the codes are assigned to the vectors themselves in one pass without a shuffle; they need all parts of a
row together, and the codebooks are small.

Equal parts of one batch become one member with a number of copies before the first shuffle, and the salt spreads an entry
over as many owners as all parts of a position need at ``resident`` parts an owner, so that an entry that holds a third of all
parts is no large group.

Defined results: vectors that are null or hold null or non-finite components are dropped, and so are vectors that do not have
the number of components of the first vector (by key, null last) whose number is a positive multiple of ``parts``; rows of
equal or null keys are rows like all others; fewer vectors than entries give fewer entries; no vectors give an empty result.
Whole numbers beyond 2**25 either way count as that, so that squared distances are exact in 64 bits.
Only the columns named are read, so others cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.llm.staging import stage

LARGEST = 2**25
#: Vectors compared with a codebook at once.
ROWS = 8192

Codebooks = np.ndarray  # position x entry x component


def usable(vector: str) -> Column:
    value = F.col(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(value.isNotNull() & finite, F.lit(False))


def whole_numbers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(256 * values.astype(np.float64)), -LARGEST, LARGEST).astype(np.int64)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every part, the first of equally near ones, and the squared distance."""
    width = parts.shape[1]
    largest = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * width * largest * largest < 2**52:  # then doubles are exact, and much faster to multiply
        parts, entries = parts.astype(np.float64), entries.astype(np.float64)
    found, distance = [], []
    own = (entries * entries).sum(axis=1)
    for at in range(0, len(parts), ROWS):
        some = parts[at : at + ROWS]
        apart = own - 2 * (some @ entries.T)
        entry = apart.argmin(axis=1)
        found.append(entry)
        distance.append((apart[np.arange(len(some)), entry] + (some * some).sum(axis=1)).astype(np.int64))
    return np.concatenate(found or [np.zeros(0, np.int64)]), np.concatenate(distance or [np.zeros(0, np.int64)])


def cut_parts(column: pa.Array, parts: int) -> np.ndarray:
    """rows x parts x width whole numbers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return whole_numbers(flat).reshape(len(column), parts, -1)


def _members(batches: Iterator[pa.RecordBatch], books: Codebooks, salts: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    """One member for every different part of a batch, where it has to reside first."""
    place = TaskContext.get().partitionId()
    for number, batch in enumerate(batches):
        if not batch.num_rows:
            continue
        cut = cut_parts(batch.column(0), len(books))
        for position, entries in enumerate(books):
            parts, copies = np.unique(cut[:, position], axis=0, return_counts=True)
            entry, _ = nearest(parts, entries)
            salt = (np.arange(len(parts)) + place + number) % salts
            columns = [np.full(len(parts), position), entry, salt, copies, *parts.T]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)


def _reassigned(batches: Iterator[pa.RecordBatch], books: Codebooks, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Every resident member with the entry it belongs to now and, as ``owner``, the entry where it resides."""
    for batch in batches:
        column = {name: batch.column(name).to_numpy() for name in batch.schema.names}
        parts = np.stack([column[name] for name in names[4:]], axis=1)
        entry = column["entry"].copy()
        for position, entries in enumerate(books):
            mine = column["position"] == position
            entry[mine] = nearest(parts[mine], entries)[0]
        columns = {**column, "owner": column["entry"], "entry": entry}
        yield pa.RecordBatch.from_arrays([pa.array(columns[n]) for n in [*names, "owner"]], names=[*names, "owner"])


def updated(books: Codebooks, members: DataFrame, names: list[str]) -> Codebooks:
    """New codebooks: componentwise floor(sum / count) of the residents of each entry; entries without any stay."""
    sums = [F.sum(F.col(name) * F.col("copies")).alias(name) for name in names[4:]]
    totals = members.groupBy("position", "entry").agg(F.sum("copies").alias("copies"), *sums)
    books = books.copy()
    for position, entry, copies, *components in totals.collect():
        books[position, entry] = np.array(components, np.int64) // copies
    return books


def train(vectors: DataFrame, books: Codebooks, count: int, rounds: int, resident: int) -> Codebooks:
    """Codebooks after some rounds over ``vectors`` (one column, all of equal length)."""
    parts, _, width = books.shape
    names = ["position", "entry", "salt", "copies", *(f"c{i}" for i in range(width))]
    kind = ", ".join(f"{name} bigint" for name in names)
    salts = max(8, math.ceil(count / resident))
    deal = max(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(parts * count / resident))
    home = ["position", "entry", "salt"]
    members = None
    for _ in range(rounds):
        if members is None:
            first = vectors.mapInArrow(lambda x, b=books: _members(x, b, salts, names), kind)
            members = stage(first.repartition(deal, *home))
        else:
            compared = stage(members.mapInArrow(lambda x, b=books: _reassigned(x, b, names), f"{kind}, owner bigint"))
            arrived = stage(compared.where("owner <> entry").select(*names).repartition(deal, *home))
            members = compared.where("owner = entry").select(*names).unionByName(arrived)
        books = updated(books, members, names)
    return books


def _encoded(batches: Iterator[pa.RecordBatch], books: Codebooks, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cut = cut_parts(batch.column(0), len(books))
        codes = np.zeros((len(cut), len(books)), np.uint8 if books.shape[1] <= 256 else ">u2")
        error = np.zeros(len(cut), np.int64)
        for position, entries in enumerate(books):
            codes[:, position], distance = nearest(cut[:, position], entries)
            error += distance
        text = pa.array([row.tobytes().hex() for row in codes], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], text, pa.array(error)], names=names)


def digest(books: Codebooks) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    resident: int = 1 << 20,
) -> tuple[DataFrame, Codebooks]:
    """(key, label, code, error) of every vector that is not dropped, and the codebooks."""
    whole = vectors.where(usable(vector) & (F.size(vector) > 0) & (F.size(vector) % parts == 0))
    first = [F.asc_nulls_last(key), F.asc(vector)]
    start = whole.orderBy(*first).select(F.size(vector)).first()
    fields = {name: vectors.schema[name].dataType.simpleString() for name in (key, label)}
    kind = ", ".join([*(f"`{name}` {type_}" for name, type_ in fields.items()), "code string", "error bigint"])
    if start is None:
        return vectors.sparkSession.createDataFrame([], kind), np.zeros((parts, 0, 0), np.int64)
    same = whole.where(F.size(vector) == start[0])
    chosen = np.array([row[0] for row in same.orderBy(*first).limit(entries).select(vector).collect()])
    books = whole_numbers(chosen).reshape(len(chosen), parts, -1).transpose(1, 0, 2)
    books = train(same.select(vector), books, same.count(), rounds, resident)
    names = [key, label, "code", "error"]
    return same.select(vector, key, label).mapInArrow(lambda x: _encoded(x, books, names), kind), books


def label_errors(coded: DataFrame, label: str = "label") -> DataFrame:
    """Adds ``label_error``, the errors added up over equal labels, nulls together.

    The sums, one row a label, are joined back; Spark picks the join by their size and splits a label that holds many rows.
    """
    sums = coded.groupBy(F.col(label).alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col(label).eqNullSafe(F.col("of"))).drop("of")
