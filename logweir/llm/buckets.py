"""Similarity join inside buckets of any size.

Rows that share a bucket are compared; a bucket larger than a block is cut into blocks, and each pair of blocks is a
group of its own, so no task holds more than two blocks of a bucket. Only counts and spanning edges leave a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def block_pairs(rows: DataFrame, bucket: str, identity: str, block: int) -> DataFrame:
    """Adds ``left`` and ``right`` (a pair of blocks) and ``own``, the row's block; a row goes to every pair that holds it.

    Only buckets of more than ``block`` rows are cut; their names are few, so the join with them is cheap.
    """
    sizes = rows.groupBy(bucket).agg(F.count("*").alias("rows")).where(F.col("rows") > block)
    blocks = F.coalesce(F.ceil(F.col("rows") / F.lit(block)).cast("int"), F.lit(1))
    cut = rows.join(sizes, bucket, "left").withColumn("blocks", blocks)
    own = F.pmod(F.xxhash64(identity), F.col("blocks")).cast("int")
    cut = cut.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return cut.select(
        *rows.columns, F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right"), "own"
    )


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Pieces of sorted input such that rows of equal keys are never in two pieces."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        change = np.zeros(batch.num_rows, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            change[1:] |= values[1:] != values[:-1]
            if held:
                change[0] |= held[-1].column(key)[-1].as_py() != values[0]
        cuts = np.flatnonzero(change)
        if len(cuts) == 0:
            held.append(batch)
            continue
        cut = int(cuts[-1])
        if held or cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)] if cut else held)
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a forest with the components of a symmetric matrix of links."""
    left = np.ones(len(linked), bool)
    edges = []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root] = False
        front = [root]
        while front:
            node = front.pop()
            new = np.flatnonzero(linked[node] & left)
            left[new] = False
            edges += [(node, int(x)) for x in new]
            front += new.tolist()
    return edges
