"""What both batch plans share: statuses, side outputs and the rule for failed tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.config import IngestConfig
from logweir.operators import status
from logweir.operators.projection import preview_text
from logweir.operators.schema import schema_json


@dataclass(frozen=True)
class Batch:
    """A bounded slice of the stream and its identity."""

    df: DataFrame
    batch_id: int
    source_id: str = "batch"


@dataclass(frozen=True)
class TableStatus:
    table_name: str
    status: str
    exception: str | None = None
    row_count: int = 0

    @property
    def failed(self) -> bool:
        return self.status == status.ERROR


@dataclass(frozen=True)
class BatchReport:
    """Per-table statuses plus the totals.

    ``total`` counts records. ``routed`` counts rows of tables: under textual routing a record can have several, otherwise
    ``total = routed + unrouted + quarantined``.
    """

    batch_id: int
    tables: tuple[TableStatus, ...] = ()
    total: int = 0
    routed: int = 0
    unrouted: int = 0
    quarantined: int = 0

    @property
    def failed(self) -> list[TableStatus]:
        return [table for table in self.tables if table.failed]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(t.table_name, t.status, t.exception, t.row_count, self.batch_id) for t in self.tables]
        return status.status_frame(spark, rows)


class BatchFailed(RuntimeError):
    """At least one table of the batch was not written; the stream stops and repeats the batch."""

    def __init__(self, report: BatchReport):
        self.report = report
        names = ", ".join(f"{t.table_name}: {t.exception}" for t in report.failed)
        super().__init__(f"batch {report.batch_id} failed for {names}")


def write_side(df: DataFrame, location: str, batch: Batch) -> None:
    """Append to a side output, again one directory per batch so that a repeated batch replaces itself."""
    df.write.mode("overwrite").parquet(f"{location}/source_id={batch.source_id}/batch_id={batch.batch_id}")


def finish(batch: Batch, report: BatchReport, config: IngestConfig) -> BatchReport:
    """Record the statuses, then fail the batch if a table failed and the policy says so."""
    if config.status_location:
        write_side(report.frame(batch.df.sparkSession).drop("batch_id").coalesce(1), config.status_location, batch)
    if report.failed and config.on_error == "fail":
        raise BatchFailed(report)
    return report


def rejected(df: DataFrame, reasons: Mapping[str, str]) -> DataFrame:
    """Raw records of events that reached no table, with the reason of their event. Expects ``value, event``.

    The reasons are a table, so that the plan does not grow with the number of events.
    """
    table = df.sparkSession.createDataFrame(list(reasons.items()), "failed string, why string")
    return df.select("value", "event").join(table, F.col("event") == F.col("failed")).select("value", F.col("why").alias("reason"))


def preview(df: DataFrame, title: str, config: IngestConfig, log) -> None:
    """First rows, schema tree and schema as JSON text, if the job is asked to show them."""
    if config.preview:
        log(f"{title}:\n{preview_text(df)}\n{schema_json(df)}")
