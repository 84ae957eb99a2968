"""Exactly-once appends to targets that can only append and read: warehouse connectors, JDBC, anything Spark can load.

An append has two steps, and a ledger next to the checkpoint says how far each ``(table, source id, batch id)`` has come:

1. **prepare**: the typed rows are written once to a staging table, each with the name of its batch and its row number,
   and the ledger says ``prepared``. Until then nothing has reached the target, and a repeat simply begins anew.
2. **commit**: the staged rows are appended to the target, marks included, and the ledger says ``committed``.

A repeat of a prepared batch takes the rows from the staging table, not from the source, looks up which row numbers of
this batch the target has, and appends the others: whether the first run died before, within or after the append makes
no difference. A repeat of a committed batch does nothing.

A streaming query repeats its last batch only. So ledger and staging keep the last two batches of a source, in two slots that
are overwritten in turn, and need no clean-up; a batch older than its slot is refused, because its rows cannot be told
from new ones any more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.sinks.tables import ConnectorSink, identifier

#: Columns that the target has besides those of the catalog.
BATCH_MARK = "logweir_batch"
ROW_MARK = "logweir_row"
MARKS = (BATCH_MARK, ROW_MARK)

PREPARED = "prepared"
COMMITTED = "committed"

SLOTS = 2

_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "TABLE_OR_VIEW_NOT_FOUND")


def load_if_there(read) -> DataFrame | None:
    """The frame ``read`` gives, or None if there is nothing to read yet; all other errors are errors."""
    try:
        return read()
    except AnalysisException as err:
        if (err.getCondition() or "").split(".")[0] not in _ABSENT:
            raise
        return None


@dataclass(frozen=True)
class Slots:
    """Small notes on the last two batches of one source, under ``root``."""

    spark: SparkSession
    root: str

    def path(self, kind: str, batch_id: int) -> str:
        return f"{self.root}/{kind}/slot={batch_id % SLOTS}"

    def get(self, kind: str, batch_id: int) -> str | None:
        """The note on a batch, or None; refuses a batch whose slot belongs to a later one."""
        ddl = "batch_id bigint, note string"
        frame = load_if_there(lambda: self.spark.read.schema(ddl).json(self.path(kind, batch_id)))
        for row in frame.collect() if frame is not None else []:
            if row.batch_id == batch_id:
                return row.note
            if row.batch_id > batch_id:
                raise ValueError(f"batch {batch_id} is older than batch {row.batch_id}, which {self.root} has on record")
        return None

    def put(self, kind: str, batch_id: int, note: str = "") -> None:
        one = self.spark.createDataFrame([(batch_id, note)], "batch_id bigint, note string").coalesce(1)
        one.write.mode("overwrite").json(self.path(kind, batch_id))


@dataclass(frozen=True)
class LedgerSink:
    """Appends each batch to ``target`` exactly once; ``root`` is a folder that all executors share."""

    target: ConnectorSink
    root: str

    def append(self, df: DataFrame, table: str, source_id: str, batch_id: int) -> None:
        spark = df.sparkSession
        ledger = Slots(spark, f"{self.root}/{identifier(table)}/source_id={source_id}")
        if ledger.get(COMMITTED, batch_id) is not None:
            return
        rows, mark = ledger.path("rows", batch_id), f"{source_id}/{batch_id}"
        if ledger.get(PREPARED, batch_id) is None:
            marks = {BATCH_MARK: F.lit(mark), ROW_MARK: F.monotonically_increasing_id()}
            df.withColumns(marks).write.mode("overwrite").parquet(rows)
            ledger.put(PREPARED, batch_id)
            waiting = spark.read.parquet(rows)
        else:
            waiting = self._missing(spark.read.parquet(rows), table, mark)
        self.target.append(waiting, table, source_id, batch_id)
        ledger.put(COMMITTED, batch_id)

    def _missing(self, staged: DataFrame, table: str, mark: str) -> DataFrame:
        there = load_if_there(lambda: self.target.load(staged.sparkSession, table))
        if there is None:
            return staged
        return staged.join(there.where(F.col(BATCH_MARK) == mark).select(ROW_MARK), ROW_MARK, "left_anti").select(staged.columns)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return self.target.load(spark, table).drop(*MARKS)
