"""Values that a cast, a sink or schema discovery must not change."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from logweir.functions.coercion import auto_timestamp, integral
from logweir.operators.schema import infer_schemas
from logweir.sinks.tables import MetastoreSink, ParquetSink
from logweir.streaming.runner import source_id


@pytest.mark.parametrize(
    ("text", "strict", "legacy"),
    [
        ("3", 3, 3), ("3.0", 3, 3), ("3e0", 3, 3), ("1.5e1", 15, 15), ("12.7", None, 12), ("2.99999999999", None, 2),
        ("3.00000000001", None, 3), ("-0.5", None, 0), ("-3.", -3, -3), (".0", 0, 0), (".", None, None), ("x", None, None),
        ("9223372036854775807", 2**63 - 1, 2**63 - 1), ("9223372036854775807.0", 2**63 - 1, 2**63 - 1),
        ("99999999999999999999", None, None), ("", None, None), (None, None, None),
    ],
)
def test_integral(texts, text, strict, legacy):
    row = texts(text).select(integral(F.col("value"), "bigint").alias("a"), integral(F.col("value"), "bigint", "legacy").alias("b")).first()
    assert tuple(row) == (strict, legacy)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("2024", datetime(2024, 1, 1)), ("20240102", datetime(2024, 1, 2)), ("12345", datetime(1970, 1, 1, 3, 25, 45)),
        ("-86400", datetime(1969, 12, 31)), ("1700000000.5", datetime(2023, 11, 14, 22, 13, 20, 500000)),
        ("99999999", datetime(1973, 3, 3, 9, 46, 39)), ("2024-05-06 07:08:09", datetime(2024, 5, 6, 7, 8, 9)),
        ("9999999999999", None), ("5 march 2024", datetime(2024, 3, 5)),
    ],
)
def test_plain_numbers_as_times(texts, text, want):
    assert texts(text).select(auto_timestamp(F.col("value"), "timestamp_ntz").alias("t")).first().t == want


def test_reading_sees_the_columns_of_every_batch(spark, folder):
    sink = ParquetSink(folder)
    sink.append(spark.sql("select 1 a"), "t", "s", 0)
    sink.append(spark.sql("select 2 a, 7 b"), "t", "s", 1)
    assert {(r.a, r.b) for r in sink.read(spark, "t").collect()} == {(1, None), (2, 7)}


def test_columns_are_matched_by_name(spark, folder):
    sink = MetastoreSink(root=folder)
    spark.sql("drop table if exists default.by_name")
    sink.append(spark.sql("select 1 a, 2 b"), "by_name", "s", 0)
    sink.append(spark.sql("select 20 b, 10 a"), "by_name", "s", 1)
    sink.append(spark.sql("select 30 b"), "by_name", "s", 2)
    assert {(r.a, r.b) for r in sink.read(spark, "by_name").collect()} == {(1, 2), (10, 20), (None, 30)}
    with pytest.raises(ValueError):
        sink.append(spark.sql("select 1 c"), "by_name", "s", 3)
    spark.sql("drop table default.by_name")


def test_a_batch_without_query_id_is_refused(spark):
    with pytest.raises(ValueError):
        source_id(spark.range(1))


def test_keys_named_like_types_keep_their_names(texts):
    frame = texts('{"VOID":1,"OBJECT":{"x":null}}').withColumn("event", F.lit("e"))
    ddl = infer_schemas(frame).first().schema_ddl
    assert "VOID: BIGINT" in ddl and "OBJECT: STRUCT<" in ddl and "x: STRING" in ddl
