"""Both jobs started from a properties file, over files only, as the command line does it."""

from pyspark.sql import functions as F

from logweir import job
from logweir.config import load_properties
from logweir.operators import projection
from logweir.registry import register
from logweir.registry.inputs import FIELDS, TYPED_SQL, landing_area, route_fields, routes
from logweir.registry.sinks import TABLES_SQL, all_tables
from logweir.sinks.tables import ParquetSink
from logweir.sinks.workdir import new_folder

# Made-up values of the keys that every properties file has.
COMMON = {
    "checkpoint_interval": "30 seconds", "kafka_broker": "broker:9092", "topic": "app_log", "startingOffsets": "earliest",
    "max_offsets_per_trigger": "1000000", "consumer_group": "group", "thread_max_workers": "5", "disable_msg": "true",
    "redshift_schema": "public", "available_now": "true",
}


def _run(spark, sf_dir, name, **own):
    """The folder under which a job of these properties has written its tables."""
    folder = new_folder(spark, f"job-{name}")
    landing, schema = landing_area(spark, sf_dir)
    events, fields = routes(spark), route_fields(spark)
    catalog = {
        "event_list": events,
        "event_field_list": fields,
        "realtime_events_event_list": events,
        "realtime_events_event_field_list": fields.where("event_id = 1").drop("event_id"),
    }
    for table, df in catalog.items():
        df.write.parquet(f"{folder}/catalog/{table}")
    properties = {
        **COMMON, "checkpoint_location": f"{folder}/checkpoint", "stream_format": "parquet", "stream_path": landing,
        "stream_schema": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema), "catalog_format": "parquet",
        "catalog_root": f"{folder}/catalog", "table_root": folder, **own,
    }
    lines = spark.createDataFrame([(f"{key} = {text}",) for key, text in properties.items()], "value string")
    lines.coalesce(1).write.text(f"{folder}/properties")
    job.start(spark, name, load_properties(spark, f"{folder}/properties")).awaitTermination()
    return folder


@register(f"{TABLES_SQL} where event_type in ('click', 'view', 'signup', 'purchase')")
def job_router(spark, sf_dir):
    folder = _run(spark, sf_dir, "router", metadata_event_type="0,1")
    return all_tables(spark, ParquetSink(folder), ["click", "view", "signup", "purchase"])


@register(
    """select 'finished' as table_status, event_type as table_name, count(*) as row_count
    from events where event_type in ('signup', 'purchase') group by event_type"""
)
def job_router_statuses(spark, sf_dir):
    """What a staged job leaves as its statuses."""
    target = new_folder(spark, "job-status")
    _run(
        spark, sf_dir, "router", metadata_event_type="1", status_location=f"{target}/status", staging_root=f"{target}/staging",
        fanout="cached",
    )
    statuses = spark.read.parquet(f"{target}/status").where("status = 'finished'")
    return statuses.groupBy(F.col("status").alias("table_status"), "table_name").agg(F.sum("row_count").alias("row_count"))


@register(f"select event_id, ts, asn, value, k from ({TYPED_SQL}) where event_type in ('click', 'view')")
def job_single_table(spark, sf_dir):
    folder = _run(spark, sf_dir, "single", metadata_event_type="0", target_table="app_events", trailing_text="quarantine")
    return ParquetSink(folder).read(spark, "app_events", projection.table_schema(FIELDS))
