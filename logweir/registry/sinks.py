"""Fan-out, single table, append and staging: written to the shared folder, then read back."""

import uuid

from pyspark.sql import functions as F

from logweir.config import IngestConfig
from logweir.operators import projection, routing
from logweir.plans.batch import Batch
from logweir.plans.router import route_batch
from logweir.plans.single_table import single_table_batch
from logweir.registry import register
from logweir.registry.inputs import FIELDS, SEEN, TYPED_SQL, nested, records, route_catalog, table
from logweir.registry.projections import EXACT, EXACT_SQL, exact_records
from logweir.registry.routes import SET
from logweir.sinks.staging import read_staged, stage
from logweir.sinks.tables import ParquetSink, StagedSink
from logweir.sinks.workdir import new_folder
from logweir.sources.catalog import EventCatalog


def quiet(_):
    """The registered queries have no log."""


def config(folder, **settings):
    return IngestConfig(checkpoint_location=f"{folder}/checkpoint", **settings)


def all_tables(spark, sink, names=SEEN):
    """Every target table as one frame."""
    schema = projection.table_schema(FIELDS)
    tables = [sink.read(spark, name, schema).withColumn("table_name", F.lit(name)) for name in names]
    union = tables[0]
    for other in tables[1:]:
        union = union.unionByName(other)
    return union


def _fan_out(spark, df, sink, folder, **settings):
    batch = Batch(df.select("value"), 0, uuid.uuid4().hex)
    return route_batch(batch, route_catalog(spark), sink, config(folder, **settings), quiet)


TABLES_SQL = f"select event_type as table_name, event_id, ts, asn, value, k from ({TYPED_SQL})"


@register("select event_type as table_name, count(*) as row_count from events group by event_type")
def fanout_counts(spark, sf_dir):
    folder = new_folder(spark, "fanout-counts")
    sink = ParquetSink(folder)
    _fan_out(spark, records(spark, sf_dir), sink, folder)
    return all_tables(spark, sink).groupBy("table_name").agg(F.count(F.lit(1)).alias("row_count"))


@register(TABLES_SQL)
def fanout_union(spark, sf_dir):
    folder = new_folder(spark, "fanout-union")
    sink = ParquetSink(folder)
    _fan_out(spark, records(spark, sf_dir), sink, folder)
    return all_tables(spark, sink)


@register(TABLES_SQL)
def fanout_cached(spark, sf_dir):
    folder = new_folder(spark, "fanout-cached")
    sink = ParquetSink(folder)
    _fan_out(spark, records(spark, sf_dir), sink, folder, fanout="cached")
    return all_tables(spark, sink)


@register(
    f"""select event_type as table_name, event_id, ts, asn, value, k from ({TYPED_SQL})
    union all select 'purchase', event_id, ts, asn, value, k from ({TYPED_SQL})
      where value < 50 and event_type <> 'purchase'
    union all select 'view', event_id, ts, asn, value, k from ({TYPED_SQL})
      where value >= 50 and event_type <> 'view'"""
)
def fanout_regex_compat(spark, sf_dir):
    """Textual routing sends a record to every table whose pattern it contains."""
    folder = new_folder(spark, "fanout-regex")
    sink = ParquetSink(folder)
    _fan_out(spark, nested(spark, sf_dir), sink, folder, routing_mode="regex")
    return all_tables(spark, sink)


@register(TABLES_SQL)
def fanout_staged_csv(spark, sf_dir):
    folder = new_folder(spark, "fanout-csv")
    sink = StagedSink(ParquetSink(folder), f"{folder}/staging", "CSV GZIP")
    _fan_out(spark, records(spark, sf_dir), sink, folder)
    return all_tables(spark, sink)


def _single_table(spark, df, **settings):
    folder = new_folder(spark, "single-table")
    sink = ParquetSink(folder)
    one = config(folder, target_table="app_events", **settings)
    single_table_batch(Batch(df.select("value"), 0), SET, FIELDS, sink, one, quiet)
    return sink.read(spark, "app_events", projection.table_schema(FIELDS))


@register(f"select event_id, ts, asn, value, k from ({TYPED_SQL}) where event_type in ('click', 'view', 'signup')")
def single_table(spark, sf_dir):
    return _single_table(spark, records(spark, sf_dir))


@register(
    f"""select event_id, ts, asn, value, k from ({TYPED_SQL})
    where value >= 50 or event_type in ('click', 'view', 'signup')"""
)
def single_table_regex_compat(spark, sf_dir):
    return _single_table(spark, nested(spark, sf_dir), routing_mode="regex")


@register(f"select event_id, ts, asn, value, k from ({TYPED_SQL}) where event_type in ('click', 'view')")
def sink_append(spark, sf_dir):
    folder = new_folder(spark, "append")
    sink = ParquetSink(folder)
    rows = records(spark, sf_dir)
    for batch_id, event in enumerate(("click", "view")):
        sink.append(projection.project(routing.route(rows, event), FIELDS), "app_events", "append", batch_id)
    return sink.read(spark, "app_events", projection.table_schema(FIELDS))


def _round_trip(spark, df, staging_format):
    folder = new_folder(spark, "staging")
    stage(df, folder, staging_format)
    return read_staged(spark, folder, df.schema, staging_format)


STAGED_SQL = f"select event_id, ts, asn, value, k from ({TYPED_SQL})"
DOCUMENTS_SQL = "select doc_id, text, lang, source, n_chars from documents"


@register(STAGED_SQL)
def stage_json_roundtrip(spark, sf_dir):
    return _round_trip(spark, projection.project(records(spark, sf_dir), FIELDS), "JSON GZIP")


@register(STAGED_SQL)
def stage_csv_roundtrip(spark, sf_dir):
    return _round_trip(spark, projection.project(records(spark, sf_dir), FIELDS), "CSV GZIP")


@register(DOCUMENTS_SQL)
def stage_json_texts(spark, sf_dir):
    return _round_trip(spark, table(spark, sf_dir, "documents"), "JSON")


@register(DOCUMENTS_SQL)
def stage_csv_texts(spark, sf_dir):
    return _round_trip(spark, table(spark, sf_dir, "documents"), "CSV")


@register(f"select event_type as table_name, event_id, amount, extra from (select * from ({EXACT_SQL}) join events using (event_id))")
def fanout_exact_values(spark, sf_dir):
    """Long numbers and semi-structured values through the whole router: sorted batch, tables, and back."""
    folder = new_folder(spark, "fanout-exact")
    sink, fields = ParquetSink(folder), projection.fields_from_specs(EXACT)
    catalog = EventCatalog(dict.fromkeys(SEEN, fields))
    batch = Batch(exact_records(spark, sf_dir), 0, uuid.uuid4().hex)
    route_batch(batch, catalog, sink, config(folder), quiet)
    tables = [sink.read(spark, name).withColumn("table_name", F.lit(name)) for name in SEEN]
    union = tables[0]
    for other in tables[1:]:
        union = union.unionByName(other)
    return union.select("table_name", "event_id", "amount", F.to_json("extra").alias("extra"))
