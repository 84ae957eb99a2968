"""Batch plans: totals, statuses, failure policies, side outputs and repeated batches."""

import uuid

import pytest
from pyspark.sql import functions as F

from logweir.config import IngestConfig
from logweir.operators import status
from logweir.operators.projection import CastRules, fields_from_specs
from logweir.plans import router, sorting
from logweir.plans.batch import Batch, BatchFailed
from logweir.plans.router import route_batch
from logweir.plans.single_table import single_table_batch
from logweir.registry.inputs import SEEN, damaged, records, route_catalog
from logweir.sinks.tables import ConnectorSink, MetastoreSink, ParquetSink, StagedSink, identifier, qualified
from logweir.sources.catalog import EventCatalog

SF_DIR = "/root/testdata/sf0.001"

VALUES = (
    '{"event":"click","asn":"1","properties_raw":{"k":"a"}}',
    '{"event":"click","asn":"2","properties_raw":{"k":"b"}}',
    '{"event":"view","asn":"3","properties_raw":{"k":"c"}}',
    '{"event":"nobody","asn":"4"}',
    '{"event":"click", broken',
    None,
    "[1]",
    '{"event":"ghost"}',
)
SPECS = fields_from_specs(["asn:int", "k:varchar(8)"])
CATALOG = EventCatalog({"click": SPECS, "ghost": (), "refund": SPECS, "view": SPECS})


def quiet(_):
    pass


def config(folder, **settings):
    return IngestConfig(checkpoint_location=f"{folder}/checkpoint", **settings)


def batch(df, batch_id=0):
    return Batch(df, batch_id, uuid.uuid4().hex)


def run(df, folder, catalog=CATALOG, sink=None, **settings):
    return route_batch(batch(df), catalog, sink or ParquetSink(folder), config(folder, **settings), quiet)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


class FailsFor:
    """A sink that refuses one table."""

    def __init__(self, inner, table):
        self.inner, self.table, self.done = inner, table, []

    def append(self, df, table, source_id, batch_id):
        if table == self.table:
            raise OSError("no space in warehouse")
        self.inner.append(df, table, source_id, batch_id)
        self.done.append(table)


@pytest.mark.parametrize("fanout", ["staged", "cached"])
def test_router_writes_each_table_and_reports_every_event(spark, texts, folder, fanout):
    report = run(texts(*VALUES), folder, fanout=fanout)
    states = {t.table_name: (t.status, t.row_count) for t in report.tables}
    assert states == {
        "click": (status.FINISHED, 2), "view": (status.FINISHED, 1), "refund": (status.NO_DATA, 0),
        "ghost": (status.NO_FIELDS, 1),
    }
    sink = ParquetSink(folder)
    assert rows(sink.read(spark, "click")) == [(1, "a"), (2, "b")]
    assert rows(sink.read(spark, "view")) == [(3, "c")]
    assert (report.total, report.routed, report.unrouted, report.quarantined) == (8, 4, 2, 2)


@pytest.mark.parametrize("make", [records, damaged])
def test_outcomes_add_up_to_the_input(spark, folder, make):
    df = make(spark, SF_DIR).select("value")
    report = route_batch(batch(df), route_catalog(spark), ParquetSink(folder), config(folder), quiet)
    assert report.total == report.routed + report.unrouted + report.quarantined == df.count()


def test_text_layout_gives_the_same_tables(spark, folder, monkeypatch):
    df = records(spark, SF_DIR).select("value")
    parsed, text = ParquetSink(f"{folder}/a"), ParquetSink(f"{folder}/b")
    route_batch(batch(df), route_catalog(spark), parsed, config(folder), quiet)
    monkeypatch.setattr(router, "parsed_schema", lambda catalog, config: None)
    assert router.parsed_schema(route_catalog(spark), config(folder)) is None
    route_batch(batch(df), route_catalog(spark), text, config(folder), quiet)
    for name in SEEN:
        assert rows(parsed.read(spark, name)) == rows(text.read(spark, name))


def test_keys_that_differ_in_case_use_the_text_layout(spark, texts, folder):
    catalog = EventCatalog({"a": fields_from_specs(["asn:int", "k:int"]), "b": fields_from_specs(["asn:int", "K:int"])})
    df = texts('{"event":"a","asn":1,"properties_raw":{"k":1}}', '{"event":"b","asn":2,"properties_raw":{"K":2}}')
    run(df, folder, catalog)
    sink = ParquetSink(folder)
    assert rows(sink.read(spark, "a")) == [(1, 1)] and rows(sink.read(spark, "b")) == [(2, 2)]


@pytest.mark.parametrize("mode", ["exact", "regex"])
def test_records_with_text_after_them_are_quarantined_on_request(spark, texts, folder, mode):
    two = VALUES[0] + VALUES[2]  # textual routing finds two tables in it
    strict = config(folder, routing_mode=mode, trailing_text="quarantine", quarantine_location=f"{folder}/bad")
    sink = ParquetSink(folder)
    report = route_batch(Batch(texts(*VALUES[:3], two), 0), CATALOG, sink, strict, quiet)
    assert (report.total, report.routed, report.unrouted, report.quarantined) == (4, 3, 0, 1)
    bad = spark.read.parquet(f"{folder}/bad").select("value", "reason").collect()
    assert [tuple(r) for r in bad] == [(two, "text after the record")]
    single = config(folder, target_table="all", trailing_text="quarantine", routing_mode=mode)
    report = single_table_batch(Batch(texts(*VALUES[:3], two), 0), ["click", "view"], SPECS, sink, single, quiet)
    assert (report.routed, report.quarantined) == (3, 1)


def test_missing_outer_fields_are_null_or_dropped(spark, texts, folder):
    catalog = EventCatalog({"click": fields_from_specs(["session:varchar", "asn:int", "k:varchar(8)"])})
    run(texts(VALUES[0]), f"{folder}/null", catalog)
    run(texts(VALUES[0]), f"{folder}/drop", catalog, missing_outer="drop")
    assert ParquetSink(f"{folder}/null").read(spark, "click").columns == ["session", "asn", "k"]
    assert ParquetSink(f"{folder}/drop").read(spark, "click").columns == ["asn", "k"]


def test_a_failed_table_fails_the_batch_after_the_others_ended(spark, texts, folder):
    sink = FailsFor(ParquetSink(folder), "click")
    with pytest.raises(BatchFailed, match="no space in warehouse") as failure:
        run(texts(*VALUES), folder, sink=sink, status_location=f"{folder}/status")
    assert sink.done == ["view"]
    assert [t.table_name for t in failure.value.report.failed] == ["click"]
    saved = spark.read.parquet(f"{folder}/status")
    assert saved.where("status = 'error'").first().exception == "no space in warehouse"
    assert spark.range(1).count() == 1


@pytest.mark.parametrize("fanout", ["staged", "cached"])
def test_a_failed_table_can_be_quarantined(spark, texts, folder, fanout):
    sink = FailsFor(ParquetSink(folder), "click")
    report = run(
        texts(*VALUES), folder, sink=sink, fanout=fanout, on_error="quarantine", quarantine_location=f"{folder}/bad"
    )
    assert len(report.failed) == 1
    kept = rows(spark.read.parquet(f"{folder}/bad").select(F.coalesce("value", F.lit("-")), "reason"))
    assert kept == sorted(
        [
            (VALUES[0], "write failed: no space in warehouse"),
            (VALUES[1], "write failed: no space in warehouse"),
            (VALUES[4], "malformed json"),
            (VALUES[7], "event has no fields"),
            ("-", "null value"),
        ]
    )


def test_side_outputs_only_when_asked_for(spark, texts, folder):
    run(texts(*VALUES), folder, quarantine_location=f"{folder}/bad", unrouted_location=f"{folder}/rest")
    assert spark.read.parquet(f"{folder}/bad").count() == 3
    assert rows(spark.read.parquet(f"{folder}/rest").select("value")) == sorted([(VALUES[3],), (VALUES[6],)])


def test_repeating_a_batch_replaces_it(spark, texts, folder):
    sink, settings = ParquetSink(folder), config(folder)
    for batch_id, value in ((0, VALUES[0]), (1, VALUES[1]), (0, VALUES[0])):
        route_batch(Batch(texts(value), batch_id, "one"), CATALOG, sink, settings, quiet)
    assert rows(sink.read(spark, "click")) == [(1, "a"), (2, "b")]
    route_batch(Batch(texts(VALUES[0]), 0, "another-checkpoint"), CATALOG, sink, settings, quiet)
    assert sink.read(spark, "click").count() == 3


def test_empty_batch_does_nothing(texts, folder):
    report = run(texts("x").limit(0), folder)
    assert report.tables == () and report.total == 0


def test_textual_routing_feeds_every_matching_table(spark, texts, folder):
    both = '{"p":{"event":"view"},"event":"click","asn":5}'
    run(texts(both), folder, routing_mode="regex")
    sink = ParquetSink(folder)
    assert rows(sink.read(spark, "click")) == rows(sink.read(spark, "view")) == [(5, None)]


def single(df, folder, sink=None, names=("click", "view"), **settings):
    settings = config(folder, target_table='"app_events"', **settings)
    return single_table_batch(batch(df), names, SPECS, sink or ParquetSink(folder), settings, quiet)


def test_single_table(spark, texts, folder):
    report = single(texts(*VALUES), folder, quarantine_location=f"{folder}/bad", unrouted_location=f"{folder}/rest")
    assert rows(ParquetSink(folder).read(spark, "app_events")) == [(1, "a"), (2, "b"), (3, "c")]
    assert (report.total, report.routed, report.unrouted, report.quarantined) == (8, 3, 3, 2)
    assert spark.read.parquet(f"{folder}/bad").count() == 2
    assert spark.read.parquet(f"{folder}/rest").count() == 3
    assert [(t.table_name, t.status) for t in report.tables] == [("app_events", status.FINISHED)]


def test_single_table_does_not_lose_a_failed_batch(spark, texts, folder):
    sink = FailsFor(ParquetSink(folder), "app_events")
    with pytest.raises(BatchFailed):
        single(texts(*VALUES), folder, sink)
    report = single(texts(*VALUES), folder, sink, on_error="quarantine", quarantine_location=f"{folder}/bad")
    assert report.routed == 3 and report.total == 8
    assert spark.read.parquet(f"{folder}/bad").count() == 5


def test_single_table_without_data_or_fields(texts, folder):
    assert single(texts(*VALUES), folder, names=("refund",)).tables[0].status == status.NO_DATA
    assert single(texts("x").limit(0), folder).tables[0].status == status.NO_DATA
    settings = config(folder, target_table="t")
    report = single_table_batch(batch(texts(*VALUES)), ["click"], (), ParquetSink(folder), settings, quiet)
    assert report.tables[0].status == status.NO_FIELDS


def test_single_table_drops_absent_outer_fields_on_request(spark, texts, folder):
    specs = fields_from_specs(["session:varchar", "asn:int", "k:varchar(8)"])
    settings = config(folder, target_table="t", missing_outer="drop")
    single_table_batch(batch(texts(*VALUES)), ["click"], specs, ParquetSink(folder), settings, quiet)
    assert ParquetSink(folder).read(spark, "t").columns == ["asn", "k"]


def test_preview_is_logged_on_request(texts, folder):
    lines = []
    route_batch(batch(texts(*VALUES)), CATALOG, ParquetSink(folder), config(folder, preview=True), lines.append)
    settings = config(folder, target_table="t", preview=True)
    single_table_batch(batch(texts(*VALUES)), ["click"], SPECS, ParquetSink(folder), settings, lines.append)
    tables = [line for line in lines if line.startswith("table ")]
    assert len(tables) == 3 and all("asn: integer" in line and '"name":"asn"' in line for line in tables)
    assert [line.split(":")[0] for line in lines if line.startswith("source")] == ["source", "source"]
    assert sum(line.startswith("records of ") for line in lines) == 3


@pytest.mark.parametrize("staging_format", ["CSV", "CSV GZIP", "JSON", "JSON GZIP"])
def test_staged_sink_is_exact(spark, folder, staging_format):
    df = spark.sql(
        """select * from values (1, '', timestamp_ntz'2024-01-01 00:00:00.123456', 1.5D, 'a,"b"\n c '),
        (2, null, null, null, ' x'), (3, '"', timestamp_ntz'1999-12-31 23:59:59', -0.1D, '\r\n\\\\N'),
        (4, '\\\\', null, 1e300, '\t') as t(i, s, ts, d, note)"""
    )
    sink = StagedSink(ParquetSink(folder), f"{folder}/staging", staging_format)
    for batch_id in (0, 1, 1):
        sink.append(df, "t", "s", batch_id)
    want = sorted(map(str, df.collect() * 2))
    assert sorted(map(str, sink.read(spark, "t").collect())) == want


def test_hot_event_is_split_and_small_events_are_not(spark, folder):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400k")
    try:
        hot = spark.range(20_000, numPartitions=8).select(
            F.concat(F.lit('{"event":"'), F.when(F.col("id") % 10 < 7, "click").otherwise("view"),
                     F.lit('","asn":'), F.col("id"), F.lit(',"properties_raw":{"k":"'), F.sha2(F.col("id").cast("string"), 256),
                     F.lit('"}}')).alias("value")
        )
        tagged = router.tag_batch(hot, CATALOG, config(folder))
        staged = sorting.stage_tagged(tagged, f"{folder}/tagged")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    placed = staged.withColumn("file", F.input_file_name())
    files = placed.groupBy("event").agg(F.countDistinct("file").alias("n"), F.count("*").alias("rows"))
    got = {r.event: (r.n, r.rows) for r in files.collect()}
    assert got["click"][1] == 14_000 and got["view"][1] == 6_000
    assert got["click"][0] > got["view"][0] >= 1


def test_target_reads_only_its_partition_and_fields(spark, folder):
    staged = sorting.stage_tagged(
        router.tag_batch(records(spark, SF_DIR), route_catalog(spark), config(folder)), f"{folder}/tagged"
    )
    mine = staged.where((F.col("outcome") == "routed") & (F.col("event") == "click")).select("record.asn")
    plan = mine._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(outcome" in plan and "ReadSchema: struct<record:struct<asn:string>>" in plan


def test_metastore_tables_repeat_batches_without_doubling(spark, texts, folder):
    sink = MetastoreSink("default", folder)
    table = f"t{uuid.uuid4().hex}"
    for batch_id, value in ((0, "a"), (1, "b"), (0, "a"), (1, "c")):
        sink.append(texts(value), table, "s", batch_id)
    assert rows(sink.read(spark, table)) == [("a",), ("c",)]
    spark.sql(f"drop table default.{table}")


def test_connector_options_and_names():
    sink = ConnectorSink("jdbc", "public", {"url": "jdbc:x"})
    assert sink.table_options('"app_events"') == {"url": "jdbc:x", "dbtable": "public.app_events"}
    assert "jdbc:x" not in repr(sink)
    assert qualified("public", "t") == "public.t"
    for bad in ("a.b", "t; drop table x", "", "../x", 'a"b'):
        with pytest.raises(ValueError):
            identifier(bad)


def test_connector_appends(spark, texts, folder):
    df = texts("a", "b")
    sink = ConnectorSink("parquet", "public", table_option="path")
    relocated = type("Relocated", (ConnectorSink,), {"table_options": lambda self, table: {"path": f"{folder}/{table}"}})
    for batch_id in (0, 1):
        relocated(sink.format, sink.schema).append(df, "t", "s", batch_id)
    assert spark.read.parquet(f"{folder}/t").count() == 4


def test_rules_reach_the_tables(spark, texts, folder):
    df = texts('{"event":"click","asn":"7.9","properties_raw":{"k":"123456789"}}')
    run(df, folder, cast_rules=CastRules(cast_mode="legacy"))
    assert rows(ParquetSink(folder).read(spark, "click")) == [(7, "12345678")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_source_is_read_and_parsed_once(spark, folder, monkeypatch):
    """Tables, counts, side outputs and statuses all come from one sorted batch."""
    sorted_frames = []
    inner = sorting.stage_tagged

    def watched(tagged, path):
        sorted_frames.append(plan_of(tagged))
        return inner(tagged, path)

    monkeypatch.setattr(sorting, "stage_tagged", watched)
    everything = {"quarantine_location": f"{folder}/bad", "unrouted_location": f"{folder}/rest", "schema_location": f"{folder}/schemas"}
    source = records(spark, SF_DIR).select("value")
    for mode in ("exact", "regex"):
        run(source, f"{folder}/{mode}", route_catalog(spark), routing_mode=mode, **everything)
    single(source, folder, **everything)
    assert len(sorted_frames) == 3
    for plan in sorted_frames:
        assert plan.count("from_json") == 1 and plan.count("FileScan") == 1


def test_counting_routes_parses_each_record_once(spark):
    from logweir.operators import routing
    from logweir.registry.inputs import routes

    counted = status.route_counts(routing.tag(records(spark, SF_DIR)), routes(spark))
    assert plan_of(counted).count("from_json") == 1


def test_total_counts_records_under_textual_routing(spark, texts, folder):
    both = '{"p":{"event":"view"},"event":"click","asn":5}'
    report = run(texts(both, both, VALUES[2], VALUES[3], VALUES[4]), folder, routing_mode="regex")
    assert (report.total, report.routed, report.unrouted, report.quarantined) == (5, 6, 1, 0)
    assert {t.table_name: t.row_count for t in report.tables} == {"click": 3, "view": 3, "ghost": 0, "refund": 0}


@pytest.mark.parametrize("policy", ["fail", "quarantine"])
def test_no_record_text_stays_in_the_shared_folder(spark, texts, folder, policy):
    one = batch(texts(*VALUES))
    settings = config(folder, on_error=policy, quarantine_location=f"{folder}/bad")
    sink = StagedSink(FailsFor(ParquetSink(folder), "view"), f"{folder}/staging", "JSON")
    try:
        route_batch(one, CATALOG, sink, settings, quiet)
    except BatchFailed:
        assert policy == "fail"
    for left in (f"{sorting.shared_folder(spark)}/logweir/{one.source_id}/tagged", f"{folder}/staging/click", f"{folder}/staging/view"):
        assert spark.read.option("recursiveFileLookup", True).parquet(left).count() == 0


def test_schema_history_of_both_jobs(spark, texts, folder):
    from logweir.operators.history import SchemaHistory

    for batch_id, more in enumerate(('"x":1', '"X":1.5')):
        values = [f'{{"event":"click","asn":1,{more}}}', f'{{"event":"view","asn":2,{more}}}', VALUES[3], VALUES[4]]
        one = Batch(texts(*values), batch_id, "s")
        route_batch(one, CATALOG, ParquetSink(folder), config(folder, schema_location=f"{folder}/router"), quiet)
        settings = config(folder, schema_location=f"{folder}/single", target_table="t")
        single_table_batch(one, ["click"], SPECS, ParquetSink(folder), settings, quiet)
    seen = {
        job: {(r.event, r.path, r.type, tuple(r.spellings)) for r in SchemaHistory(spark, f"{folder}/{job}").schemas("s").collect()}
        for job in ("router", "single")
    }
    click = {("click", "asn", "bigint", ("asn",)), ("click", "event", "string", ("event",)), ("click", "x", "decimal(20,1)", ("X", "x"))}
    assert seen["single"] == click
    assert seen["router"] == click | {("view", *rest) for _, *rest in click}


def test_many_failed_tables_make_a_short_plan(spark, texts):
    from logweir.plans.batch import rejected

    bad = texts("a", "b").withColumn("event", F.col("value"))
    some = rejected(bad, {f"e{i}": "x" for i in range(2000)} | {"b": "why"})
    assert rows(some) == [("b", "why")]
    assert len(plan_of(some)) < 3000
