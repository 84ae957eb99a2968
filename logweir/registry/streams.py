"""Streaming jobs driven to their end over files, then read back."""

from dataclasses import replace

from pyspark.sql import functions as F

from logweir.operators import projection
from logweir.registry import register
from logweir.registry.inputs import FIELDS, TYPED_SQL, landing_area, records, route_catalog
from logweir.registry.routes import SET
from logweir.registry.sinks import TABLES_SQL, all_tables, config
from logweir.sinks.tables import ParquetSink
from logweir.sinks.workdir import new_folder
from logweir.streaming.runner import run_router, run_single_table

STREAM_DDL = "event_id bigint, value string"
ROWS_PER_FILE = 1_000_000


def _landing_stream(spark, sf_dir):
    """The landing area as a file stream."""
    folder, schema = landing_area(spark, sf_dir)
    return spark.readStream.schema(schema).parquet(folder).select("value")


def _files_config(folder, per_trigger=None, **settings):
    options = {} if per_trigger is None else {"maxFilesPerTrigger": str(per_trigger)}
    return config(
        folder,
        available_now=True,
        stream_format="parquet",
        stream_path=f"{folder}/input",
        stream_schema=STREAM_DDL,
        stream_options=options,
        **settings,
    )


def _write_files(df, folder, files):
    df.select("event_id", "value").repartition(files).write.mode("append").parquet(f"{folder}/input")


@register(TABLES_SQL)
def stream_append(spark, sf_dir):
    folder = new_folder(spark, "stream-append")
    sink = ParquetSink(folder)
    job = run_router(
        spark, config(folder, available_now=True), route_catalog(spark), sink, stream=_landing_stream(spark, sf_dir)
    )
    job.awaitTermination()
    return all_tables(spark, sink)


@register(f"select event_id, ts, asn, value, k from ({TYPED_SQL}) where event_type in ('click', 'view', 'signup')")
def stream_single_table(spark, sf_dir):
    folder = new_folder(spark, "stream-single")
    sink = ParquetSink(folder)
    settings = config(folder, available_now=True, target_table="app_events")
    job = run_single_table(spark, settings, SET, FIELDS, sink, stream=_landing_stream(spark, sf_dir))
    job.awaitTermination()
    return sink.read(spark, "app_events", projection.table_schema(FIELDS))


@register("select cast(4 as bigint) as batches, count(*) as row_count, true as within_limit from events")
def stream_rate_limit(spark, sf_dir):
    """Four equal slices of the input files, one slice per trigger, whatever the number of files."""
    folder = new_folder(spark, "stream-rate")
    rows = records(spark, sf_dir)
    slices = 4
    per_trigger = max(1, -(-rows.count() // (slices * ROWS_PER_FILE)))
    _write_files(rows, folder, slices * per_trigger)
    status = f"{folder}/status"
    settings = _files_config(folder, per_trigger, status_location=status)
    run_router(spark, settings, route_catalog(spark), ParquetSink(folder)).awaitTermination()
    per_batch = spark.read.parquet(status).groupBy("batch_id").agg(F.sum("row_count").alias("n"))
    return per_batch.agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("n").alias("row_count"),
        (F.max("n") <= 2 * per_trigger * ROWS_PER_FILE).alias("within_limit"),
    )


@register(TABLES_SQL)
def stream_restart(spark, sf_dir):
    """Stop after the first part of the input, add the second part, go on from the same checkpoint."""
    folder = new_folder(spark, "stream-restart")
    sink, settings, catalog = ParquetSink(folder), _files_config(folder), route_catalog(spark)
    rows = records(spark, sf_dir)
    middle = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    for part in (F.col("ts") < middle, F.col("ts") >= middle):
        rows.where(part).select("event_id", "value").write.mode("append").parquet(f"{folder}/input")
        run_router(spark, settings, catalog, sink).awaitTermination()
    return all_tables(spark, sink)


class Interrupted(RuntimeError):
    """Stands for a lost driver: the tables are written, the batch is not committed."""


@register(TABLES_SQL)
def stream_replay(spark, sf_dir):
    """The first run dies after writing and before committing; the restart repeats that batch."""
    folder = new_folder(spark, "stream-replay")
    sink, settings, catalog = ParquetSink(folder), _files_config(folder), route_catalog(spark)
    records(spark, sf_dir).select("event_id", "value").write.parquet(f"{folder}/input")

    def die(report):
        raise Interrupted(f"after batch {report.batch_id}")

    first = run_router(spark, settings, catalog, sink, on_report=die)
    try:
        first.awaitTermination()
    except Exception as err:
        if "Interrupted" not in str(err):
            raise
    run_router(spark, settings, catalog, sink).awaitTermination()
    return all_tables(spark, sink)


START = "2024-01-15 00:00:00"


@register(f"{TABLES_SQL} where ts >= timestamp '{START}'")
def stream_from_timestamp(spark, sf_dir):
    """A file stream that begins at a record time, by the job's own setting."""
    folder = new_folder(spark, "stream-start")
    records(spark, sf_dir).select("event_id", "ts", "value").write.parquet(f"{folder}/input")
    milliseconds = 1_705_276_800_000  # START in UTC
    settings = replace(
        _files_config(folder), stream_schema="event_id bigint, ts timestamp_ntz, value string",
        starting_offsets=str(milliseconds), record_time="cast(ts as timestamp)",
    )
    sink = ParquetSink(folder)
    run_router(spark, settings, route_catalog(spark), sink).awaitTermination()
    return all_tables(spark, sink)
