"""Streaming jobs: source → ``foreachBatch`` → batch plan, with the checkpoint as the source of truth.

The streaming plan itself is stateless. A batch that fails raises, the query stops without committing it, and the
restart runs it again under the same batch id; the session is left running.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from logweir.config import IngestConfig
from logweir.operators.projection import FieldSpec
from logweir.plans.batch import Batch, BatchReport
from logweir.plans.router import route_batch
from logweir.plans.single_table import single_table_batch
from logweir.sinks.tables import TableSink
from logweir.sources.catalog import EventCatalog
from logweir.sources.refresh import VersionedCatalog, catalog_for
from logweir.sources.stream import read_stream

Report = Callable[[BatchReport], None]


def run_router(
    spark: SparkSession,
    config: IngestConfig,
    catalog: EventCatalog | VersionedCatalog,
    sink: TableSink,
    on_report: Report | None = None,
    stream: DataFrame | None = None,
) -> StreamingQuery:
    """Start the job that writes one table per event. A versioned catalog is asked at the beginning of every batch."""
    return _start(
        read_stream(spark, config) if stream is None else stream,
        config,
        lambda batch: route_batch(batch, catalog_for(catalog, batch.source_id, batch.batch_id), sink, config),
        on_report,
    )


def run_single_table(
    spark: SparkSession,
    config: IngestConfig,
    names: Sequence[str] | VersionedCatalog,
    fields: Sequence[FieldSpec],
    sink: TableSink,
    on_report: Report | None = None,
    stream: DataFrame | None = None,
) -> StreamingQuery:
    """Start the job that writes many events into one table. A versioned catalog gives names and fields for every batch."""

    def process(batch: Batch) -> BatchReport:
        if not isinstance(names, VersionedCatalog):
            return single_table_batch(batch, names, fields, sink, config)
        catalog = names.for_batch(batch.source_id, batch.batch_id)
        return single_table_batch(batch, catalog.event_names, catalog.shared, sink, config)

    return _start(read_stream(spark, config) if stream is None else stream, config, process, on_report)


def _start(
    stream: DataFrame, config: IngestConfig, process: Callable[[Batch], BatchReport], on_report: Report | None
) -> StreamingQuery:
    def each_batch(df: DataFrame, batch_id: int) -> None:
        report = process(Batch(df, batch_id, source_id(df)))
        if on_report:
            on_report(report)

    trigger = {"availableNow": True} if config.available_now else {"processingTime": config.trigger_interval}
    return (
        stream.writeStream.outputMode("append")
        .trigger(**trigger)
        .option("checkpointLocation", config.checkpoint_location)
        .foreachBatch(each_batch)
        .start()
    )


def source_id(df: DataFrame) -> str:
    """The id a streaming query keeps across restarts from the same checkpoint."""
    found = df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("no streaming query id: batches of two checkpoints would overwrite each other")
    return found
