"""Catalog rules on literal rows: merging, splitting, missing parts and size bounds."""

import pytest
from pyspark.sql import functions as F

from logweir.operators import bounds, catalog
from logweir.sources.catalog import load_catalog, load_shared_catalog, read_table

EVENTS = [(1, "click", 0), (2, "view", 1), (7, "ghost", 1), (8, "click", 0), (9, "other", 2)]
FIELDS = [
    (11, 1, "id", "bigint", None),
    (12, 1, "my_asn", "int", None),
    (13, 1, "asn", "int", None),
    (14, 1, "k", "varchar(8)", "key"),
    (81, 8, "K", "int", None),
    (82, 8, "extra", "double", None),
    (21, 2, "id", "bigint", None),
]


@pytest.fixture
def events(spark):
    return spark.createDataFrame(EVENTS, "id int, event_name string, event_type int")


@pytest.fixture
def fields(spark):
    return spark.createDataFrame(
        FIELDS, "id int, event_id int, field_name string, data_type string, json_field_name string"
    )


def test_left_join_keeps_bare_events(events, fields):
    rows = catalog.join_fields(events, fields).collect()
    assert len(rows) == len(FIELDS) + 2
    assert {r.event_name for r in rows if r.field_id is None} == {"ghost", "other"}


def test_join_is_the_same_without_broadcast(spark, events, fields):
    broadcast = sorted(map(str, catalog.join_fields(events, fields).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, catalog.join_fields(events, fields).collect())) == broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_events_without_a_name_are_left_out(spark, events, fields):
    nameless = events.unionByName(spark.createDataFrame([(77, None, 1)], events.schema))
    more = fields.unionByName(fields.limit(1).withColumn("event_id", F.lit(77).cast(fields.schema["event_id"].dataType)))
    assert load_catalog(nameless, more, "0,1").fields == load_catalog(events, fields, "0,1").fields
    assert None not in {r.event_name for r in catalog.field_lists(catalog.join_fields(nameless, more)).collect()}


def test_same_name_under_two_ids_merges_and_keeps_the_first(events, fields):
    loaded = load_catalog(events, fields, "0,1")
    assert list(loaded.fields) == ["click", "ghost", "view"]
    assert [(f.name, f.type_text, f.scope) for f in loaded.fields["click"]] == [
        ("id", "bigint", "outer"), ("my_asn", "int", "outer"), ("asn", "int", "outer"),
        ("k", "varchar(8)", "property"), ("extra", "double", "property"),
    ]
    assert loaded.fields["ghost"] == ()
    assert [f.scope for f in loaded.fields["view"]] == ["outer"]
    assert len(loaded.warnings) == 1 and "view" in loaded.warnings[0]


def test_field_lists_are_in_id_order(events, fields):
    rows = {r.event_name: r.specs for r in catalog.field_lists(catalog.join_fields(events, fields)).collect()}
    assert rows == {"click": ["id:bigint", "my_asn:int", "asn:int", "k:varchar(8)", "extra:double"], "view": ["id:bigint"]}


def test_json_field_name_is_optional(events, fields):
    assert {f.key for f in load_catalog(events, fields).fields["click"]} >= {"k"}
    renamed = load_catalog(events, fields, use_json_field_name=True).fields["click"]
    assert [f.key for f in renamed if f.name == "k"] == ["key"]


def test_shared_catalog(events, fields):
    one = fields.where("event_id = 1").drop("event_id")
    loaded, specs = load_shared_catalog(events, one, "1,2")
    assert loaded.event_names == ["view", "ghost", "other"]
    assert [f.name for f in specs] == ["id", "my_asn", "asn", "k"]
    assert [f.scope for f in specs] == ["outer", "outer", "outer", "property"]


def test_unknown_types_and_missing_types_are_refused(spark, events):
    schema = "id int, event_id int, field_name string, data_type string, json_field_name string"
    for bad in ("nonsense", None):
        with pytest.raises(ValueError):
            load_catalog(events, spark.createDataFrame([(1, 1, "a", bad, None)], schema))


def test_metadata_is_refused_not_cut(spark):
    assert len(bounds.collect_metadata(spark.range(5), "rows", max_rows=5)) == 5
    with pytest.raises(ValueError):
        bounds.collect_metadata(spark.range(6), "rows", max_rows=5)
    spark.conf.set(bounds.BOUND_SETTING, "6")
    try:
        assert len(bounds.collect_metadata(spark.range(6), "rows", max_rows=5)) == 6
    finally:
        spark.conf.unset(bounds.BOUND_SETTING)


def test_catalog_tables_from_files(spark, events, folder):
    events.write.parquet(f"{folder}/event_list")
    assert read_table(spark, "event_list", "parquet", {"root": folder}).count() == len(EVENTS)


def test_the_first_declaration_wins_also_among_equal_ids(spark):
    """Ties on the id go by name, then type, NULL first, then source key; nothing is sorted to find out."""
    from logweir.operators.catalog import declared_fields

    rows = [
        ("e", 2, "K", "int", None), ("e", 2, "k", "int", None), ("e", 1, "asn", "int", "b"), ("e", 1, "asn", None, "a"),
        ("e", 1, "asn", None, None), ("e", 3, "ASN", "bigint", None), ("e", None, None, None, None), (None, 1, "x", "int", None),
        ("f", 9, "x", "int", None), ("f", 9, "a", "int", None), ("f", 10, "asn", "int", None), ("f", 11, "z", "int", None),
    ]
    joined = spark.createDataFrame(rows, "event_name string, field_id long, field_name string, data_type string, json_field_name string")
    got = {r.event_name: [(e.field_id, e.field_name, e.data_type, e.json_field_name) for e in r.entries] for r in declared_fields(joined).collect()}
    assert got == {
        "e": [(1, "asn", None, None), (2, "K", "int", None)],
        "f": [(9, "a", "int", None), (9, "x", "int", None), (10, "asn", "int", None), (11, "z", "int", None)],
    }
    plan = declared_fields(joined)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Window" not in plan
