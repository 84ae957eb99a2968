"""Schema history: evidence, types and their merges."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from logweir.operators.history import SchemaHistory, case_variants, evidence, merged, schema_table
from logweir.operators.schema import observed_paths


def tagged(texts, *values):
    return texts(*values).withColumn("event", F.lit("e"))


def types(frame) -> dict:
    return {r.path: r.type for r in frame.collect()}


VALUES = {
    "null": (["null"], "null"),
    "whole": (["1", "-20"], "bigint"),
    "long": (["1", "12345678901234567890"], "decimal(20,0)"),
    "cents": (["1.25", "3.5"], "decimal(3,2)"),
    "whole_and_cents": (["1", "0.125"], "decimal(22,3)"),
    "wide": (["12345678901234567890123456789012345678", "0.5"], "double"),
    "double": (["1e300", "1"], "double"),
    "flag": (["true", "null"], "boolean"),
    "flag_and_number": (["true", "1"], "string"),
    "text": (['"x"', "1", "1.5", "true"], "string"),
    "object": (['{"y":1}', "null"], "struct"),
    "list": (["[1]", "[]"], "array"),
    "object_and_list": (["{}", "[1]"], "variant"),
    "object_and_text": (["{}", '"x"'], "variant"),
}


@pytest.mark.parametrize("name", sorted(VALUES))
def test_types(texts, name):
    values, want = VALUES[name]
    rows = evidence(tagged(texts, *[f'{{"k":{v}}}' for v in values]), 0)
    assert types(schema_table(rows))["k"] == want
    for order in itertools.permutations(values):
        one_by_one = [evidence(tagged(texts, f'{{"k":{v}}}'), i) for i, v in enumerate(order[:3])]
        if len(order) > 3:
            break
        whole = one_by_one[0]
        for other in one_by_one[1:]:
            whole = whole.unionByName(other)
        assert types(schema_table(merged(whole)))["k"] == want


def test_paths_of_both_levels_and_odd_records(texts):
    found = observed_paths(tagged(texts, '{"a":null,"b":{"c":[1],"d":{"e":1}}}', "[1]", "broken", None, "{}", '"x"'))
    kinds = found.select("path", F.schema_of_variant("doc").alias("kind")).collect()
    assert {(r.path, r.kind) for r in kinds} == {
        ("a", "VOID"), ("b", "OBJECT<c: ARRAY<BIGINT>, d: OBJECT<e: BIGINT>>"), ("b.c", "ARRAY<BIGINT>"), ("b.d", "OBJECT<e: BIGINT>"),
    }


def test_spellings_are_one_key(texts):
    rows = schema_table(evidence(tagged(texts, '{"User":1,"user":"x"}', '{"USER":2,"other":1}'), 0))
    assert [(r.path, r.spellings, r.type, r.rows) for r in case_variants(rows).collect()] == [
        ("user", ["USER", "User", "user"], "string", 3)
    ]


def test_history_counts_each_batch_once_in_bounded_space(spark, texts, folder):
    history, pick = SchemaHistory(spark, folder), random.Random(1)
    want = 0
    for batch_id in range(5):
        n = pick.randint(1, 4)
        want += n
        for _ in range(pick.randint(1, 3)):
            history.record(tagged(texts, *['{"k":1}'] * n), "s", batch_id)
    row = history.schemas("s").first()
    assert (row.rows, row.first_batch, row.last_batch) == (want, 0, 4)
    assert len(history._states("s")) == 2
    assert history.schemas("other") is None


def test_batch_ids_may_have_gaps(spark, texts, folder):
    history = SchemaHistory(spark, folder)
    for batch_id in (0, 2, 2, 4, 7, 7):
        history.record(tagged(texts, '{"k":1}'), "s", batch_id)
    assert history.schemas("s").first().rows == 4


def test_types_never_narrow(spark, texts, folder):
    history = SchemaHistory(spark, folder)
    seen = [types(history.record(tagged(texts, f'{{"k":{v}}}'), "s", i))["k"] for i, v in enumerate(["null", "1", "0.5", "2", "1e9", "true", "3"])]
    assert seen == ["null", "bigint", "decimal(20,1)", "decimal(20,1)", "double", "string", "string"]


def test_events_are_apart_and_empty_batches_are_fine(spark, texts, folder):
    history = SchemaHistory(spark, folder)
    empty = tagged(texts, "x").limit(0)
    assert history.record(empty, "s", 0).count() == 0
    two = texts('{"k":1}', '{"k":"x"}').withColumn("event", F.get_json_object("value", "$.k"))
    history.record(two, "s", 1)
    history.record(empty, "s", 2)
    assert sorted((r.event, r.type) for r in history.schemas("s").collect()) == [("1", "bigint"), ("x", "string")]


def test_values_are_counted_by_plain_keys_before_all_else(texts):
    """One value costs one count; sets, flags and patterns are left to the few rows of event, path and kind."""
    rows = evidence(tagged(texts, '{"k":{"x":1}}', '{"K":{"y":"z"}}', '{"k":[{"x":1}]}', '{"k":1.5}', '{"k":null}'), 0)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    aggregates = [line.strip(" +-:") for line in plan.splitlines() if "Aggregate(" in line]
    lowest = aggregates[-1]
    assert lowest.startswith("HashAggregate(") and "kind" in lowest and "functions=[partial_count(1)]" in lowest
    row = rows.where("path = 'k'").first()
    assert (row.rows, row.spellings, row.struct, row.array, row.exact, row.digits, row.scale, row.other) == (
        5, ["K", "k"], True, True, True, 1, 1, False
    )


def test_a_file_of_one_row_group_is_parsed_by_many_tasks(spark, folder):
    from logweir.registry.history import batches

    rows = [(f"2024-01-{day:02d} 10:00:00", "click", 1.5, '{"k": 1}') for day in range(1, 31)]
    events = spark.createDataFrame(rows, "ts string, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{folder}/events.parquet")
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert many > 1
    assert [part.rdd.getNumPartitions() for part in batches(spark, folder)] == [many, many]
    assert [part.count() for part in batches(spark, folder)] == [15, 15]
