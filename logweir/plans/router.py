"""Router plan: one target table per event name.

The batch is sorted once (``sorting``), and then every target reads only its own records, however many targets there are.
What is kept of a routed record is its parsed fields, so that the targets only cast. A catalog whose keys collide, or are
wanted as texts by one event and as exact values by another, keeps the record text instead and every target parses its own
records.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.config import IngestConfig
from logweir.functions.records import EVENT_KEY, QUARANTINED, ROUTED, UNROUTED
from logweir.operators import routing, schema, status
from logweir.operators.catalog import OUTER, PROPERTY
from logweir.operators.history import SchemaHistory
from logweir.operators.projection import exact_places, project, project_parsed, record_schema
from logweir.plans.batch import Batch, BatchReport, TableStatus, finish, preview
from logweir.plans.sorting import COPY, count, side_outputs, sorted_batch
from logweir.sinks.tables import TableSink
from logweir.sources.catalog import EventCatalog


def route_batch(
    batch: Batch, catalog: EventCatalog, sink: TableSink, config: IngestConfig, log=print
) -> BatchReport:
    if batch.df.isEmpty():
        return finish(batch, BatchReport(batch.batch_id), config)
    preview(batch.df, "source", config, log)
    with sorted_batch(tag_batch(batch.df, catalog, config), batch, config) as tagged:
        counts = count(tagged)
        rows = counts.rows
        routed = tagged.where(F.col("outcome") == ROUTED)
        present = _present(routed, config)
        if config.schema_location:
            history = SchemaHistory(batch.df.sparkSession, config.schema_location)
            history.record(routed.select("event", "value"), batch.source_id, batch.batch_id)

        def write(event: str) -> TableStatus:
            fields = catalog.fields[event]
            if not fields:
                return TableStatus(event, status.NO_FIELDS, row_count=rows.get(event, 0))
            if event not in rows:
                return TableStatus(event, status.NO_DATA)
            try:
                mine = routed.where(F.col("event") == event)
                if "record" in mine.columns:
                    preview(mine.select("record.*"), f"records of {event}", config, log)
                read = project_parsed if "record" in mine.columns else project
                typed = read(mine, fields, config.cast_rules, present and present.get(event, ()))
                preview(typed, f"table {event}", config, log)
                sink.append(typed, event, batch.source_id, batch.batch_id)
            except Exception as err:
                return TableStatus(event, status.ERROR, str(err), rows[event])
            return TableStatus(event, status.FINISHED, row_count=rows[event])

        tables = _concurrently(write, catalog.event_names, batch.df.sparkSession, config.max_concurrent_writes)
        report = BatchReport(
            batch.batch_id, tuple(tables), counts.total, sum(rows.values()), counts.unrouted, counts.quarantined
        )
        side_outputs(batch, tagged, report, _reasons(report, config), config)
    return finish(batch, report, config)


def parsed_schema(catalog: EventCatalog, config: IngestConfig) -> T.StructType | None:
    """The parse schema that serves all events at once, or None if each target has to parse for itself."""
    fields = [f for declared in catalog.fields.values() for f in declared]
    outer = {f.key for f in fields if f.scope == OUTER} | {EVENT_KEY}
    properties = {f.key for f in fields if f.scope == PROPERTY}
    collide = any(len({key.lower() for key in keys}) < len(keys) for keys in (outer, properties))
    exact = exact_places(fields)
    differ = any(exact_places(declared) != exact & {f.place for f in declared} for declared in catalog.fields.values())
    if collide or differ or config.missing_outer == "drop":
        return None
    return record_schema(fields)


def tag_batch(df: DataFrame, catalog: EventCatalog, config: IngestConfig) -> DataFrame:
    """``record?, value, reason, outcome, event``; the event is set for routed records only, so it is a catalog name.

    Texts and fields that no output asks for are not carried along.
    """
    names = catalog.event_names
    parsed = parsed_schema(catalog, config)
    mode = "each" if config.routing_mode == "regex" else config.routing_mode
    tagged = routing.sort_out(df.select("value"), names, mode, parsed, config.trailing_text == "quarantine")
    routed = F.col("outcome") == ROUTED
    events = [F.when(routed, F.col("event")).alias("event")]
    if config.routing_mode == "regex":
        events = [F.posexplode_outer(F.when(routed, routing.text_events(names))).alias(COPY, "event")]
    sorted_out = tagged.select(
        *([] if parsed is None else [F.when(routed, F.col("record")).alias("record")]),
        F.col("value"),
        "reason",
        "outcome",
        *events,
    )
    needed = F.when(_text_is_needed(parsed, catalog, config), F.col("value"))
    if config.routing_mode == "regex":
        sorted_out = sorted_out.withColumn(COPY, F.coalesce(COPY, F.lit(0)))
    return sorted_out.withColumn("value", needed)


def _text_is_needed(parsed: T.StructType | None, catalog: EventCatalog, config: IngestConfig) -> Column:
    """Whether the raw text of a sorted record goes to a table, to the quarantine or to the unrouted output."""
    outcome = F.col("outcome")
    needed = F.lit(False)
    if parsed is None or config.on_error == "quarantine" or config.schema_location:
        needed = needed | (outcome == ROUTED)
    if config.unrouted_location:
        needed = needed | (outcome == UNROUTED)
    if config.quarantine_location:
        bare = [name for name, fields in catalog.fields.items() if not fields]
        needed = needed | (outcome == QUARANTINED) | F.coalesce(F.col("event").isin(bare), F.lit(False))
    return needed


def _present(routed: DataFrame, config: IngestConfig) -> dict[str, set[str]] | None:
    if config.missing_outer == "null":
        return None
    return {event: set(found.names) for event, found in schema.collect_schemas(routed).items()}


def _concurrently(write, events, spark, max_workers: int) -> list[TableStatus]:
    """All tables run to their end, also when one fails; job properties of the stream reach the worker threads."""

    def in_session(event: str) -> TableStatus:
        spark.createDataFrame([], "x int")  # makes the session this thread's active one: Python data sources are looked up there
        return write(event)

    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        return list(pool.map(inheritable_thread_target(spark)(in_session), events))


def _reasons(report: BatchReport, config: IngestConfig) -> dict[str, str]:
    """Why records of an event reached no table."""
    reasons = {t.table_name: "event has no fields" for t in report.tables if t.status == status.NO_FIELDS and t.row_count}
    if config.on_error == "quarantine":
        reasons |= {t.table_name: f"write failed: {t.exception}" for t in report.failed}
    return reasons
