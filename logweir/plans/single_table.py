"""Single-table plan: a list of events that share one field list goes into one configured table.

All events have the same columns, so one parse per record gives the route, the verdict and the typed row. Without other
outputs the batch is read once, nothing is cached or shuffled, and the counts are observed while the table is written.
With other outputs the batch is sorted first (``sorting``), so that each of them reads its own records and the source is
still read and parsed once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from logweir.config import IngestConfig
from logweir.functions import records
from logweir.operators import routing, schema, status
from logweir.operators.history import SchemaHistory
from logweir.operators.projection import FieldSpec, project_parsed, record_schema
from logweir.plans.batch import Batch, BatchReport, TableStatus, finish, preview
from logweir.plans.sorting import count, side_outputs, sorted_batch
from logweir.sinks.tables import TableSink, identifier

OUTCOMES = (records.ROUTED, records.UNROUTED, records.QUARANTINED)


def single_table_batch(
    batch: Batch,
    names: Sequence[str],
    fields: Sequence[FieldSpec],
    sink: TableSink,
    config: IngestConfig,
    log=print,
) -> BatchReport:
    table = identifier(config.target_table or "")
    if batch.df.isEmpty():
        return finish(batch, BatchReport(batch.batch_id, (TableStatus(table, status.NO_DATA),)), config)
    if not fields:
        return finish(batch, BatchReport(batch.batch_id, (TableStatus(table, status.NO_FIELDS),)), config)
    preview(batch.df, "source", config, log)
    one_document = config.trailing_text == "quarantine"
    ready = routing.sort_out(batch.df.select("value"), names, config.routing_mode, record_schema(fields), one_document)

    def write(routed: DataFrame, present: set[str] | None) -> str | None:
        """The error, if the table could not be written."""
        try:
            preview(routed.select("record.*"), f"records of {table}", config, log)
            typed = project_parsed(routed, fields, config.cast_rules, present)
            preview(typed, f"table {table}", config, log)
            sink.append(typed, table, batch.source_id, batch.batch_id)
        except Exception as err:
            return str(err)
        return None

    report = _sorted(batch, table, ready, write, config) if _has_other_outputs(config) else _direct(batch, table, ready, write)
    return finish(batch, report, config)


def _has_other_outputs(config: IngestConfig) -> bool:
    more = config.unrouted_location or config.quarantine_location or config.schema_location
    return bool(more) or config.missing_outer == "drop"


def _direct(batch: Batch, table: str, ready: DataFrame, write) -> BatchReport:
    """No shuffle lies between the source and the table, so every task's counts are taken once."""
    seen = Observation()
    watched = ready.observe(seen, *[F.count_if(F.col("outcome") == name).alias(name) for name in OUTCOMES])
    error = write(watched.where(F.col("outcome") == records.ROUTED), None)
    if error is not None:
        return BatchReport(batch.batch_id, (TableStatus(table, status.ERROR, error),))
    counts = seen.get
    state = status.FINISHED if counts[records.ROUTED] else status.NO_DATA
    done = TableStatus(table, state, row_count=counts[records.ROUTED])
    return BatchReport(batch.batch_id, (done,), sum(counts.values()), **counts)


def _sorted(batch: Batch, table: str, ready: DataFrame, write, config: IngestConfig) -> BatchReport:
    outcome = F.col("outcome")
    kept = ready.select(
        F.when(outcome == records.ROUTED, F.col("record")).alias("record"),
        F.when(_text_is_needed(config), F.col("value")).alias("value"),
        "reason",
        "outcome",
        F.when(outcome == records.ROUTED, F.lit(table)).alias("event"),
        F.when(outcome == records.ROUTED, F.col("event")).alias("name"),
    )
    with sorted_batch(kept, batch, config) as tagged:
        counts = count(tagged)
        routed = tagged.where(outcome == records.ROUTED)
        rows = counts.rows.get(table, 0)
        error = write(routed, _present(routed, config))
        if config.schema_location:
            history = SchemaHistory(batch.df.sparkSession, config.schema_location)
            named = routed.select(F.coalesce("name", F.lit(table)).alias("event"), "value")
            history.record(named, batch.source_id, batch.batch_id)
        state = status.ERROR if error is not None else status.FINISHED if rows else status.NO_DATA
        done = TableStatus(table, state, error, rows)
        report = BatchReport(batch.batch_id, (done,), counts.total, rows, counts.unrouted, counts.quarantined)
        reasons = {table: f"write failed: {error}"} if error is not None and config.on_error == "quarantine" else {}
        side_outputs(batch, tagged, report, reasons, config)
    return report


def _text_is_needed(config: IngestConfig):
    outcome = F.col("outcome")
    needed = F.lit(config.on_error == "quarantine" or config.missing_outer == "drop" or bool(config.schema_location))
    needed = needed & (outcome == records.ROUTED)
    if config.unrouted_location:
        needed = needed | (outcome == records.UNROUTED)
    if config.quarantine_location:
        needed = needed | (outcome == records.QUARANTINED)
    return needed


def _present(routed: DataFrame, config: IngestConfig) -> set[str] | None:
    if config.missing_outer == "null":
        return None
    found = schema.collect_schemas(routed.select("value", F.lit("*").alias("event")))
    return set(found["*"].names) if found else set()
