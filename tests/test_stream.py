"""Streaming jobs on file sources, and the job configuration."""

import time

import pytest
from pyspark.sql.streaming import StreamingQuery

from logweir import job
from logweir.config import IngestConfig, load_properties, redacted
from logweir.operators.projection import fields_from_specs
from logweir.sinks.tables import ParquetSink, warehouse_options
from logweir.sinks.workdir import shared_folder
from logweir.sources.catalog import EventCatalog, mysql_options
from logweir.sources.stream import stream_options
from logweir.streaming.progress import ProgressListener
from logweir.streaming.runner import run_router, run_single_table

SPECS = fields_from_specs(["asn:int", "k:int"])
CATALOG = EventCatalog({"click": SPECS, "view": SPECS})


def value(event, asn):
    return f'{{"event":"{event}","asn":{asn},"properties_raw":{{"k":{asn}}}}}'


def settings(folder, **more):
    return IngestConfig(
        checkpoint_location=f"{folder}/checkpoint",
        available_now=True,
        stream_format="json",
        stream_path=f"{folder}/in",
        stream_schema="value string",
        stream_options={"maxFilesPerTrigger": "1"},
        **more,
    )


def feed(spark, folder, *values):
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode("append").json(f"{folder}/in")


def finish(query: StreamingQuery):
    query.awaitTermination()


def asns(spark, folder, table):
    return sorted(r.asn for r in ParquetSink(folder).read(spark, table).collect())


def test_batches_restart_and_new_input(spark, folder):
    reports = []
    for part in (1, 2, 3):
        feed(spark, folder, value("click", part), value("view", part))
        finish(run_router(spark, settings(folder), CATALOG, ParquetSink(folder), reports.append))
    assert [r.batch_id for r in reports] == [0, 1, 2]
    assert asns(spark, folder, "click") == [1, 2, 3]
    finish(run_router(spark, settings(folder), CATALOG, ParquetSink(folder), reports.append))
    assert len(reports) == 3


def test_one_file_per_trigger(spark, folder):
    for part in range(3):
        feed(spark, folder, value("click", part))
    reports = []
    finish(run_router(spark, settings(folder), CATALOG, ParquetSink(folder), reports.append))
    assert [r.total for r in reports] == [1, 1, 1]


class Flaky:
    """Writes the first table, then fails, as often as told."""

    def __init__(self, inner, failures):
        self.inner, self.failures = inner, failures

    def append(self, df, table, source_id, batch_id):
        if table == "view" and self.failures:
            self.failures -= 1
            raise OSError("connection lost")
        self.inner.append(df, table, source_id, batch_id)


def test_failed_batch_is_repeated_without_doubling(spark, folder):
    feed(spark, folder, value("click", 1), value("view", 1))
    sink = Flaky(ParquetSink(folder), failures=1)
    with pytest.raises(Exception, match="connection lost"):
        finish(run_router(spark, settings(folder), CATALOG, sink))
    assert asns(spark, folder, "click") == [1]
    finish(run_router(spark, settings(folder), CATALOG, sink))
    assert asns(spark, folder, "click") == [1] and asns(spark, folder, "view") == [1]


def test_progress_is_reported(spark, folder):
    feed(spark, folder, value("click", 1), value("view", 2))
    seen = []
    listener = ProgressListener(seen.append)
    spark.streams.addListener(listener)
    try:
        finish(run_router(spark, settings(folder), CATALOG, ParquetSink(folder)))
        for _ in range(100):
            if seen:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert [(p.batch_id, p.end_offsets != ()) for p in seen] == [(0, True)]
    assert seen[0].input_rows >= 2


def test_new_checkpoint_appends_again(spark, folder):
    feed(spark, folder, value("click", 1))
    finish(run_router(spark, settings(folder), CATALOG, ParquetSink(folder)))
    again = IngestConfig(
        checkpoint_location=f"{folder}/checkpoint-2", available_now=True, stream_format="json",
        stream_path=f"{folder}/in", stream_schema="value string",
    )
    finish(run_router(spark, again, CATALOG, ParquetSink(folder)))
    assert asns(spark, folder, "click") == [1, 1]


def test_single_table_stream(spark, folder):
    feed(spark, folder, value("click", 1), value("view", 2), value("else", 3))
    config = settings(folder, target_table="app_events")
    finish(run_single_table(spark, config, ["click", "view"], SPECS, ParquetSink(folder)))
    assert asns(spark, folder, "app_events") == [1, 2]


# Made-up values for the keys of a job properties file.
PROPERTIES = """
# comment
aws_region = eu-test-1
s3_endpoint = s3.test
checkpoint_location = /tmp/cp
checkpoint_interval = 30 seconds
kafka_broker = broker:9092
topic = "app_events"
startingOffsets = earliest
thread_max_workers = 4
disable_msg = true
max_offsets_per_trigger = 1000
consumer_group = group
tempformat = CSV GZIP
redshift_secret_id =
redshift_host = warehouse.test
redshift_port = 5439
redshift_username = user
redshift_password = pass=word
redshift_database = dev
redshift_schema = public
redshift_tmpdir = s3://bucket/tmp
redshift_iam_role = role
metadata_host = meta.test
metadata_port = 3306
metadata_username = user
metadata_password = secret
metadata_database = meta
metadata_event_type = 0,2
target_table = "all_events"
"""


@pytest.fixture
def properties(spark, folder):
    with open(f"{folder}/job.properties", "w") as out:
        out.write(PROPERTIES)
    return load_properties(spark, f"{folder}/job.properties")


def test_properties(properties):
    config = IngestConfig.from_properties(properties)
    assert (config.topic, config.target_table, config.staging_format) == ("app_events", "all_events", "CSV GZIP")
    assert (config.max_concurrent_writes, config.preview, config.event_types) == (4, False, "0,2")
    assert properties["redshift_password"] == "pass=word"
    shown = str(redacted(properties))
    assert "pass=word" not in shown and "secret" not in shown.replace("redshift_secret_id", "")
    assert mysql_options(properties)["url"] == "jdbc:mysql://meta.test:3306/meta"
    options = warehouse_options(properties)
    assert options["tempformat"] == "CSV GZIP" and "TRUNCATECOLUMNS" in options["extracopyoptions"]


def _job(spark, folder, properties, **more):
    """The properties of a job that works on files only."""
    feed(spark, folder, value("click", 1), value("view", 2), value("else", 3))
    schema = "id int, event_id int, field_name string, data_type string, json_field_name string"
    fields = [(1, 1, "asn", "int", None), (2, 1, "k", "int", None), (3, 2, "asn", "int", None)]
    tables = {
        "event_list": spark.createDataFrame([(1, "click", 0), (2, "view", 2), (3, "x", 1)], "id int, event_name string, event_type int"),
        "event_field_list": spark.createDataFrame(fields, schema),
    }
    tables["realtime_events_event_list"] = tables["event_list"]
    tables["realtime_events_event_field_list"] = tables["event_field_list"].where("event_id = 1").drop("event_id")
    for name, df in tables.items():
        df.write.parquet(f"{folder}/catalog/{name}")
    path = f"{folder}/files.properties"
    own = {
        "checkpoint_location": f"{folder}/checkpoint", "stream_format": "json", "stream_path": f"{folder}/in",
        "stream_schema": "value string", "available_now": "true", "catalog_format": "parquet",
        "catalog_root": f"{folder}/catalog", "table_root": folder, **more,
    }
    with open(path, "w") as out:
        out.writelines(f"{key} = {text}\n" for key, text in {**properties, **own}.items())
    return path


def test_router_job_from_the_command_line(spark, folder, properties, capsys):
    job.main(["router", "eu-test-1", _job(spark, folder, properties)])
    assert asns(spark, folder, "click") == [1] and asns(spark, folder, "view") == [2]
    assert "pass=word" not in capsys.readouterr().out


def test_single_table_job_from_the_command_line(spark, folder, properties):
    job.main(["single", "eu-test-1", _job(spark, folder, properties, staging_root=f"{folder}/staging")])
    assert asns(spark, folder, "all_events") == [1, 2]


def test_command_line_needs_three_arguments():
    for argv in ([], ["router"], ["other", "a", "b"]):
        with pytest.raises(SystemExit):
            job.main(argv)


def test_message_source_options(properties):
    options = stream_options(IngestConfig.from_properties(properties))
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "app_events",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
        "kafka.consumer.commit.groupid": "group",
    }
    more = stream_options(IngestConfig.from_properties({**properties, "stream.minPartitions": "64"}))
    assert more["minPartitions"] == "64"
    at_time = stream_options(IngestConfig.from_properties({**properties, "startingOffsets": "1704067200000"}))
    assert at_time["startingTimestamp"] == "1704067200000" and "startingOffsets" not in at_time


@pytest.mark.parametrize("bad", [{"fanout": "x"}, {"on_error": "x"}, {"staging_format": "XML"}, {"on_error": "quarantine"}])
def test_bad_settings_are_refused(bad):
    with pytest.raises(ValueError):
        IngestConfig(checkpoint_location="/tmp/cp", **bad)


def test_shared_folder_is_stable(spark):
    assert shared_folder(spark) == shared_folder(spark)


def test_job_looks_at_the_catalog_again(spark, folder, properties):
    """The properties alone make a stream that takes up an event added between two runs and keeps versions."""
    path = _job(spark, folder, properties, catalog_refresh_seconds="0")
    job.main(["router", "eu-test-1", path])
    more = spark.createDataFrame([(4, "else", 0)], "id int, event_name string, event_type int")
    more.write.mode("append").parquet(f"{folder}/catalog/event_list")
    field = [(9, 4, "asn", "int", None)]
    fields = spark.createDataFrame(field, "id int, event_id int, field_name string, data_type string, json_field_name string")
    fields.write.mode("append").parquet(f"{folder}/catalog/event_field_list")
    feed(spark, folder, value("else", 7), value("click", 8))
    job.main(["router", "eu-test-1", path])
    assert asns(spark, folder, "else") == [7] and asns(spark, folder, "click") == [1, 8]
    versions = spark.read.json(f"{folder}/checkpoint-catalog/versions/*")
    assert versions.select("event").distinct().count() == 3


def test_start_position_and_cap_of_file_sources(spark, folder):
    from dataclasses import replace

    from logweir.sources.stream import admission, read_stream

    base = settings(folder)
    assert admission(base) is None and admission(replace(base, starting_offsets="earliest")) is None
    with pytest.raises(ValueError, match="latest"):
        admission(replace(base, starting_offsets="latest"))
    with pytest.raises(ValueError, match="record_time"):
        admission(replace(base, stream_format="rate", starting_offsets="1"))
    with pytest.warns(UserWarning, match="record_bytes"):
        stream_options(replace(base, stream_options={}, max_offsets_per_trigger=10))
    capped = stream_options(replace(base, stream_options={}, max_offsets_per_trigger=10, record_bytes=100))
    assert capped == {"maxBytesPerTrigger": "1000"}
    feed(spark, folder, value("click", 1))
    assert read_stream(spark, replace(base, starting_offsets="1")).columns == ["value"]


def test_files_before_the_start_are_not_admitted(spark, folder):
    from dataclasses import replace

    feed(spark, folder, value("click", 1))
    time.sleep(1.1)
    start = int(time.time() * 1000)
    time.sleep(1.1)
    feed(spark, folder, value("click", 2))
    config = replace(settings(folder), starting_offsets=str(start))
    finish(run_router(spark, config, CATALOG, ParquetSink(folder)))
    assert asns(spark, folder, "click") == [2]


def test_row_budget_by_bytes(spark, folder):
    from dataclasses import replace

    for part in range(4):
        feed(spark, folder, *[value("click", 10 * part + i) for i in range(5)])
    reports = []
    config = replace(settings(folder), stream_options={}, max_offsets_per_trigger=10, record_bytes=80)
    finish(run_router(spark, config, CATALOG, ParquetSink(folder), reports.append))
    assert sum(r.total for r in reports) == 20 and max(r.total for r in reports) <= 10 and len(reports) >= 2
