"""The sorted batch, from which all outputs of a batch are written: the source is read and parsed once.

* ``staged`` (default) writes it once into the shared folder, partitioned by outcome and event. The rebalance hint lets
  adaptive execution split a hot event into many evenly sized files and put small events together. Each output then
  reads its own directories. Nothing depends on executor memory, and the folder is emptied when the batch ends, well or not.
* ``cached`` persists it and filters it once per output. It saves one write for small batches with a handful of outputs.

Counts come from the sorted batch too. On staged files they are read from the files' row counts; unlike metrics observed
during the write they are not counted twice when a lost executor repeats tasks ahead of a shuffle.
"""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.config import IngestConfig
from logweir.functions.records import QUARANTINED, ROUTED, UNROUTED
from logweir.plans.batch import Batch, BatchReport, rejected, write_side
from logweir.sinks.workdir import empty_folder, shared_folder

# Row groups small enough that also a single file of a hot event is read by several tasks.
STAGE_OPTIONS = {"partitionOverwriteMode": "static", "parquet.block.size": str(16 * 1024 * 1024)}

#: 0 for the first row of a record, more where textual routing sends a record to several tables.
COPY = "copy"


@contextmanager
def sorted_batch(tagged: DataFrame, batch: Batch, config: IngestConfig):
    """The tagged batch, computed once, for as long as the block runs."""
    if config.fanout == "cached":
        tagged = tagged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            yield tagged
        finally:
            tagged.unpersist()
        return
    path = f"{shared_folder(tagged.sparkSession)}/logweir/{batch.source_id}/tagged"
    try:
        yield stage_tagged(tagged, path)
    finally:
        empty_folder(tagged.sparkSession, path)


def stage_tagged(tagged: DataFrame, path: str) -> DataFrame:
    """Write the tagged batch partitioned by target; each batch of a stream replaces the one before it."""
    balanced = tagged.hint("rebalance", "outcome", "event")
    balanced.write.mode("overwrite").options(**STAGE_OPTIONS).partitionBy("outcome", "event").parquet(path)
    return tagged.sparkSession.read.schema(tagged.schema).parquet(path)


@dataclass(frozen=True)
class Counts:
    """Rows of every event and records of every outcome."""

    rows: dict[str, int]
    total: int
    unrouted: int
    quarantined: int


def count(tagged: DataFrame) -> Counts:
    """At most one row per catalog event and outcome is brought here."""
    first = F.count_if(F.col(COPY) == 0) if COPY in tagged.columns else F.count(F.lit(1))
    found = tagged.groupBy("outcome", "event").agg(F.count(F.lit(1)).alias("n"), first.alias("records")).collect()
    outcome = {name: sum(r.records for r in found if r.outcome == name) for name in (ROUTED, UNROUTED, QUARANTINED)}
    rows = {r.event: r.n for r in found if r.outcome == ROUTED}
    return Counts(rows, sum(outcome.values()), outcome[UNROUTED], outcome[QUARANTINED])


def side_outputs(batch: Batch, tagged: DataFrame, report: BatchReport, reasons: dict[str, str], config: IngestConfig) -> None:
    """Records of no event, and records that cannot be read or that reached no table, with ``reasons`` by event."""
    if config.unrouted_location and report.unrouted:
        write_side(tagged.where(F.col("outcome") == UNROUTED).select("value"), config.unrouted_location, batch)
    if not config.quarantine_location:
        return
    bad = tagged.where(F.col("outcome") == QUARANTINED).select("value", "reason")
    if reasons:
        bad = bad.unionByName(rejected(tagged.where(F.col("outcome") == ROUTED), reasons))
    elif not report.quarantined:
        return
    write_side(bad, config.quarantine_location, batch)
