"""Near-duplicate embeddings by spherical-cap filters of a structured random product code.

The coordinates are two halves. Each half has a codebook of random Gaussian directions, and every pair of codewords is
one filter direction, so 2 c stored codewords give c * c filters. A vector passes all filters on which its unit vector
scores at least ``alpha``; list decoding finds them from the sorted scores of the halves, in time of the output.

A filter receives a vector as a code: its unit vector with 16 bits a component. Codes and codewords are multiples of
small powers of two, so all their sums and products are exact in doubles, and each task finds the same filters for the
same code. The code's dot product differs from the cosine by at most ``slack``: pairs farther than that from the
threshold are decided at once, the few others are joined to their vectors and decided in double precision. A pair is
counted in the first filter that both pass.

``alpha`` and the number of filters follow from the number of different vectors: each filter should pass about
``bucket`` vectors and each vector about ``passes`` filters of a codebook, at every size. Filters share codewords, so one
codebook finds a smaller part of the pairs the more vectors there are; therefore several independent ones are used. Their
number follows from the part of random pairs at the threshold that one misses at this size and dimension, so that all
together find ``recall`` of them; many small ones need fewer filters a vector than few large ones. Filters of more than
``block`` vectors are counted first and cut into pairs of blocks. Equal vectors are one node with a multiplicity. Pairs can
be missed (the tests measure how many); no pair below the threshold is ever linked.

Defined results: a null or zero vector, or one with null or non-finite components, has no links and is its own
component; vectors of different lengths never link; every row of a repeated ``vec_id`` counts as a vector; a null
``vec_id`` is never the name of a component unless all members are null; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.llm.buckets import runs, spanning
from logweir.llm.components import components
from logweir.llm.staging import stage


#: Steps of a codeword's and a code's component in a unit; bytes of codes that a task compares.
STEPS, CODE_STEPS = 1 << 16, 1 << 15
TASK_BYTES = 64 << 20
#: Columns of the table of shared filters that are looked at together.
SHARED = 4096


@lru_cache(maxsize=64)
def codebooks(dimension: int, codes: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng([seed, dimension, codes])
    directions = np.rint(random.standard_normal((dimension, codes)) * STEPS) / STEPS
    return directions[: dimension // 2], directions[dimension // 2 :]


def list_decode(units: np.ndarray, codes: int, alpha: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all filters that each unit vector passes."""
    first, second = codebooks(units.shape[1], codes, seed)
    a, b = units[:, : len(first)] @ first, units[:, len(first) :] @ second
    order = np.argsort(-b, axis=1)
    b = np.take_along_axis(b, order, axis=1)
    row, i = np.nonzero(a + b[:, :1] >= alpha)
    rows, filters = [], []
    for depth in range(codes):  # each turn only goes on with prefixes that still pass
        keep = a[row, i] + b[row, depth] >= alpha
        row, i = row[keep], i[keep]
        if len(row) == 0:
            break
        rows.append(row)
        filters.append(i * codes + order[row, depth])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(filters).astype(np.int64)


@lru_cache(maxsize=64)
def repetitions(dimension: int, codes: int, alpha: float, seed: int, cosine: float, recall: float, pairs: int = 1000) -> int:
    """Number of codebooks that together find ``recall`` of random pairs at ``cosine``, by the part that the first misses."""
    if dimension < 2 or cosine >= 1:
        return 1
    a, b = np.random.default_rng([seed, dimension]).standard_normal((2, pairs, dimension))
    a = _unit(a)
    b = _unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    a, b = encode(a), encode(cosine * a + math.sqrt(1 - cosine * cosine) * b)
    missed = 0
    for at in range(0, pairs, 100):
        (row, own), (row_b, own_b) = (list_decode(x[at : at + 100], codes, alpha, seed) for x in (decode(a), decode(b)))
        both = np.intersect1d(row * codes * codes + own, row_b * codes * codes + own_b)
        missed += 100 - len(np.unique(both // (codes * codes)))
    return max(1, math.ceil(math.log(1 - recall) / math.log((missed + 1) / (pairs + 2))))


def passed_filters(
    units: np.ndarray, codes: int, alpha: float, seed: int, cosine: float, recall: float
) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter) of all filters that each unit vector passes, numbered through all codebooks."""
    count = repetitions(units.shape[1], codes, alpha, seed, cosine, recall)
    found = [list_decode(units, codes, alpha, seed + i) for i in range(count)]
    return np.concatenate([r for r, _ in found]), np.concatenate([f + i * codes * codes for i, (_, f) in enumerate(found)])


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def encode(units: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(units * CODE_STEPS), 1 - CODE_STEPS, CODE_STEPS - 1).astype("<i2")


def decode(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) / CODE_STEPS


def slack(dimension: int) -> float:
    """How far the dot product of two codes may lie from the cosine: half a step a component, one step where it is cut."""
    error = (0.5 * math.sqrt(dimension) + 1) / CODE_STEPS
    return 2 * error + error * error + 1e-12


def _filtered(batches: Iterator[pa.RecordBatch], find) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, codes, row, bucket) of vectors of one length; input sorted by dimension, which is part of the bucket."""
    for piece in runs(batches, ["dimension"]):
        sizes = piece.column("dimension").to_numpy()
        for size in np.unique(sizes).tolist():
            own = piece.filter(pa.array(sizes == size))
            for begin in range(0, own.num_rows, 1024):
                part = own.slice(begin, 1024)
                codes = encode(_unit(matrix(part.column("embedding"))))
                row, bucket = find(decode(codes))
                yield part, codes, row, bucket | size << 40


def _count(batches: Iterator[pa.RecordBatch], find) -> Iterator[pa.RecordBatch]:
    """(bucket, rows)"""
    for _, _, _, bucket in _filtered(batches, find):
        names, counts = np.unique(bucket, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts)], names=["bucket", "rows"])


def _emit(batches: Iterator[pa.RecordBatch], find) -> Iterator[pa.RecordBatch]:
    """(bucket, node, copies, code) for each filter that a vector passes."""
    for part, codes, row, bucket in _filtered(batches, find):
        flat = pa.FixedSizeBinaryArray.from_buffers(
            pa.binary(codes.shape[1] * 2), len(codes), [None, pa.py_buffer(codes.tobytes())]
        ).cast(pa.binary())
        rows = pa.table([part.column("node"), part.column("copies"), flat], names=["node", "copies", "code"])
        taken = rows.take(pa.array(row)).add_column(0, "bucket", pa.array(bucket))
        yield from taken.combine_chunks().to_batches(max_chunksize=10_000)


def _apart(near: np.ndarray, bucket: int, row: np.ndarray, passed: np.ndarray) -> np.ndarray:
    """The pairs of ``near`` that share no filter before this one."""
    earlier = passed < bucket
    row, passed = row[earlier], passed[earlier]
    names, column, members = np.unique(passed, return_inverse=True, return_counts=True)
    rank = np.cumsum(members > 1) - 1  # a filter of one member is shared with nobody
    shared = members[column] > 1
    row, column = row[shared], rank[column[shared]]
    for begin in range(0, int((members > 1).sum()), SHARED):
        part = (column >= begin) & (column < begin + SHARED)
        table = np.zeros((len(near), SHARED), np.float32)
        table[row[part], column[part] - begin] = 1
        near = near & (table @ table.T == 0)
    return near


def _compare(batches: Iterator[pa.RecordBatch], find, cosine: float) -> Iterator[pa.RecordBatch]:
    """Of each group: links (a = node, b = -1, links), spanning edges (a, b, 0) and undecided pairs (a, b, -1)."""
    keys = ["bucket", "left", "right"]
    for piece in runs(batches, keys):
        values = [piece.column(k).to_numpy() for k in keys]
        change = np.any([v[1:] != v[:-1] for v in values], axis=0)
        begin = np.concatenate([[0], np.flatnonzero(change) + 1])
        a, b, links = [], [], []
        for at, stop in zip(begin, [*begin[1:], piece.num_rows]):
            if stop - at < 2:
                continue
            group = piece.slice(at, stop - at)
            size = int(values[0][at]) >> 40
            codes = np.frombuffer(b"".join(group.column("code").to_pylist()), "<i2").reshape(-1, size)
            units = decode(codes)
            node, copies, own = (group.column(c).to_numpy() for c in ("node", "copies", "own"))
            dots = units @ units.T
            near = dots >= cosine - slack(size)
            np.fill_diagonal(near, False)
            if values[1][at] != values[2][at]:
                near &= own[:, None] != own[None, :]
            some = np.flatnonzero(near.any(axis=1))
            if len(some) == 0:
                continue
            node, copies = node[some], copies[some]
            near, dots = near[np.ix_(some, some)], dots[np.ix_(some, some)]
            near = _apart(near, int(values[0][at]) & (1 << 40) - 1, *find(units[some]))
            sure = near & (dots >= cosine + slack(size))
            counts = sure @ copies
            hit = np.flatnonzero(counts)
            edges = np.array(spanning(sure), np.int64).reshape(-1, 2)
            open_a, open_b = np.nonzero(np.triu(near & ~sure))
            a += [node[hit], node[edges[:, 0]], node[open_a]]
            b += [np.full(len(hit), -1), node[edges[:, 1]], node[open_b]]
            links += [counts[hit], np.zeros(len(edges), np.int64), np.full(len(open_a), -1)]
        if a:
            columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in (a, b, links)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "links"])


def _decide(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """The pairs of vectors that reach the threshold in double precision; input sorted by dimension."""
    for piece in runs(batches, ["dimension"]):
        sizes = piece.column("dimension").to_numpy()
        for size in np.unique(sizes):
            own = piece.filter(pa.array(sizes == size))
            for begin in range(0, own.num_rows, 4096):
                part = own.slice(begin, 4096)
                x, y = (_unit(matrix(part.column(c))) for c in ("embedding_a", "embedding_b"))
                linked = pa.array((x * y).sum(axis=1) >= cosine)
                yield from part.filter(linked).select(["a", "b", "copies_a", "copies_b"]).combine_chunks().to_batches()


def near_embeddings(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    cosine: float = 0.95,
    passes: float = 4,
    bucket: float = 128,
    block: int = 1024,
    seed: int = 17,
    recall: float = 0.999,
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    value = F.col(vector)
    usable = (F.size(value) > 0) & F.forall(
        value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ) & F.exists(value, lambda x: x != 0)
    marked = vectors.select(
        F.col(key), F.when(usable, F.transform(value, lambda x: x.cast("double"))).alias("embedding")
    )
    different = marked.where("embedding is not null").groupBy("embedding")
    nodes = stage(
        different.agg(F.count("*").alias("copies"), F.min(key).alias("least")).withColumn(
            "node", F.monotonically_increasing_id()
        )
    )
    count, components_in_all = nodes.agg(F.count("*"), F.coalesce(F.sum(F.size("embedding")), F.lit(0))).first()
    share = min(0.25, bucket / max(count, 1))
    alpha = NormalDist().inv_cdf(1 - share)
    codes = math.ceil(math.sqrt(passes / share))

    def find(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return passed_filters(units, codes, alpha, seed, cosine, recall)

    sized = nodes.select(F.size("embedding").alias("dimension"), "node", "copies", "embedding").sortWithinPartitions("dimension")
    counted = sized.mapInArrow(lambda x: _count(x, find), "bucket bigint, rows bigint")
    large = stage(counted.groupBy("bucket").agg(F.sum("rows").alias("rows")).where(F.col("rows") > block))
    passing = sized.mapInArrow(lambda x: _emit(x, find), "bucket bigint, node bigint, copies bigint, code binary")
    blocks = F.coalesce(F.ceil(F.col("rows") / F.lit(block)).cast("int"), F.lit(1))
    cut = passing.join(large, "bucket", "left").withColumn("blocks", blocks)
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = cut.select(
        "bucket", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"),
        "own", "node", "copies", "code",
    )
    order = ["bucket", "left", "right"]
    # about 35 filters a vector, each with 2 bytes a component and 80 bytes besides
    tasks = -(-35 * (2 * components_in_all + 80 * count) // TASK_BYTES)
    tasks = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), tasks)
    found = stage(
        groups.repartition(tasks, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(lambda x: _compare(x, find, cosine), "a bigint, b bigint, links bigint")
    )

    def ends(name: str) -> DataFrame:
        return nodes.select(
            F.col("node").alias(name), F.col("copies").alias(f"copies_{name}"), F.col("embedding").alias(f"embedding_{name}")
        )

    undecided = found.where("links < 0").select("a", "b").join(ends("a"), "a").join(ends("b"), "b")
    decided = stage(
        undecided.withColumn("dimension", F.size("embedding_a"))
        .sortWithinPartitions("dimension")
        .mapInArrow(lambda x: _decide(x, cosine), "a bigint, b bigint, copies_a bigint, copies_b bigint")
    )
    links = (
        found.where("b < 0").select("a", "links")
        .unionByName(decided.select("a", F.col("copies_b").alias("links")))
        .unionByName(decided.select(F.col("b").alias("a"), F.col("copies_a").alias("links")))
        .groupBy("a").agg(F.sum("links").alias("links"))
    )
    root = components(found.where("b >= 0 and links = 0").select("a", "b").unionByName(decided.select("a", "b")))
    rooted = nodes.join(root, nodes.node == root.node, "left").select(
        nodes.node, "least", "copies", "embedding", F.coalesce("root", nodes.node).alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").join(links, F.col("node") == F.col("a"), "left")
    per_vector = named.select("embedding", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    joined = marked.join(per_vector, "embedding", "left")
    return joined.select(
        key,
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col(key)).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
