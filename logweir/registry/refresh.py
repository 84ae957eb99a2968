"""Streams whose catalog changes while they run."""

from dataclasses import replace

from pyspark.sql import functions as F

from logweir.operators.projection import table_schema
from logweir.registry import register
from logweir.registry.inputs import FIELDS, SEEN, TYPED_SQL, records, route_catalog
from logweir.registry.sinks import all_tables
from logweir.registry.streams import _files_config
from logweir.sinks.tables import ParquetSink
from logweir.sinks.workdir import new_folder
from logweir.sources.catalog import EventCatalog
from logweir.sources.refresh import VersionedCatalog
from logweir.streaming.runner import run_router, run_single_table

MIDDLE = "2024-01-16 00:00:00"
FILES = 4


def _two_batches(spark, sf_dir, folder):
    """The records in two sets of files, earlier and later ones, one set a batch."""
    middle = F.lit(MIDDLE).cast("timestamp_ntz")
    for part in (F.col("ts") < middle, F.col("ts") >= middle):
        rows = records(spark, sf_dir).where(part).select("event_id", "value")
        rows.repartition(FILES).write.mode("append").parquet(f"{folder}/input")
    return _files_config(folder, per_trigger=FILES)


def _without(catalog, event):
    return EventCatalog({name: fields for name, fields in catalog.fields.items() if name != event})


@register(
    f"""select event_type as table_name, event_id, ts, asn, value, k from ({TYPED_SQL})
    where not (event_type = 'purchase' and ts < timestamp '{MIDDLE}')"""
)
def stream_catalog_refresh(spark, sf_dir):
    """An event is added between two batches of a running stream: its table begins with the second one."""
    folder = new_folder(spark, "catalog-refresh")
    sink, settings, full = ParquetSink(folder), _two_batches(spark, sf_dir, folder), route_catalog(spark)
    now = {"catalog": _without(full, "purchase")}
    catalog = VersionedCatalog(spark, lambda: now["catalog"], f"{folder}/catalog")

    def after(report):
        now["catalog"] = full

    run_router(spark, settings, catalog, sink, on_report=after).awaitTermination()
    return all_tables(spark, sink)


class Interrupted(RuntimeError):
    """Stands for a lost driver after the second batch has been written and before it is committed."""


@register(
    f"""select event_type as table_name, event_id, ts, asn, value,
      case when event_type = 'view' and ts >= timestamp '{MIDDLE}' then null else k end as k
    from ({TYPED_SQL}) where event_type <> 'purchase'"""
)
def stream_catalog_replay(spark, sf_dir):
    """The second batch dies with its own catalog version; by the restart the catalog is another one once more.

    The repeated batch keeps its version: ``view`` without its last field, and no table for ``purchase``.
    """
    folder = new_folder(spark, "catalog-replay")
    sink, settings, full = ParquetSink(folder), _two_batches(spark, sf_dir, folder), route_catalog(spark)
    first = _without(full, "purchase")
    second = EventCatalog({**first.fields, "view": tuple(f for f in first.fields["view"] if f.name != "k")})
    now = {"catalog": first}

    def versioned():
        return VersionedCatalog(spark, lambda: now["catalog"], f"{folder}/catalog")

    def die_in_the_second(report):
        now["catalog"] = second
        if report.batch_id == 1:
            raise Interrupted(f"after batch {report.batch_id}")

    try:
        run_router(spark, settings, versioned(), sink, on_report=die_in_the_second).awaitTermination()
    except Exception as err:
        if "Interrupted" not in str(err):
            raise
    now["catalog"] = full
    run_router(spark, settings, versioned(), sink).awaitTermination()
    return all_tables(spark, sink, [name for name in SEEN if name != "purchase"])


@register(
    f"""select event_id, ts, asn, value, case when ts < timestamp '{MIDDLE}' then null else k end as k
    from ({TYPED_SQL}) where event_type in ('click', 'view') or (event_type = 'signup' and ts >= timestamp '{MIDDLE}')"""
)
def stream_shared_refresh(spark, sf_dir):
    """The single-table job: the second version has one event and one field more."""
    folder = new_folder(spark, "shared-refresh")
    sink, settings = ParquetSink(folder), replace(_two_batches(spark, sf_dir, folder), target_table="app_events")
    now = {"catalog": EventCatalog(dict.fromkeys(("click", "view"), FIELDS[:-1]), shared=FIELDS[:-1])}
    catalog = VersionedCatalog(spark, lambda: now["catalog"], f"{folder}/catalog")

    def after(report):
        now["catalog"] = EventCatalog(dict.fromkeys(("click", "view", "signup"), FIELDS), shared=FIELDS)

    run_single_table(spark, settings, catalog, (), sink, on_report=after).awaitTermination()
    return sink.read(spark, "app_events", table_schema(FIELDS))
