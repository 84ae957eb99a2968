"""The metadata catalog: which events exist, and which fields each one has, in which order and of which type.

Input frames (any source):

* events  ``id, event_name, event_type``
* fields  ``id, event_id, field_name, data_type, json_field_name`` (``event_id`` is absent in the shared list)

All operators here stay distributed and aggregate before they shuffle, so one event that owns a large share of
the field rows does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweir.functions import specs

DELIMITER = "asn"

OUTER = "outer"
PROPERTY = "property"


def join_fields(events: DataFrame, fields: DataFrame) -> DataFrame:
    """Events left-joined to their fields, one row per field; events without fields keep one row of NULLs."""
    e = events.select(F.col("id").alias("event_id"), "event_name", "event_type")
    f = fields.select(
        F.col("id").alias("field_id"),
        F.col("event_id").alias("of_event"),
        "field_name",
        "data_type",
        "json_field_name",
    )
    columns = ["event_id", "event_name", "event_type", "field_id", "field_name", "data_type", "json_field_name"]
    return e.join(f, F.col("of_event") == F.col("event_id"), "left").select(*columns)


def events_without_fields(events: DataFrame, fields: DataFrame) -> DataFrame:
    owners = fields.select(F.col("event_id").alias("id")).distinct()
    return events.join(owners, "id", "left_anti")


def with_specs(joined: DataFrame) -> DataFrame:
    """Add ``spec`` (``name:type``) and its parsed halves."""
    return (
        joined.withColumn("spec", specs.field_spec("field_name", "data_type"))
        .withColumn("spec_name", specs.spec_name(F.col("spec")))
        .withColumn("spec_type", specs.spec_type(F.col("spec")))
        .withColumn("spark_type", specs.spark_type_name(F.col("spec_type")))
    )


def filter_types(events: DataFrame, event_types: str | Sequence[int]) -> DataFrame:
    """Keep the named events whose type is in the configured list, e.g. ``"0,1"``."""
    wanted = specs.int_list(event_types) if isinstance(event_types, str) else list(event_types)
    return events.where(F.col("event_type").isin(wanted) & F.col("event_name").isNotNull())


_ENTRY = ("field_id", "field_key", "field_name", "data_type", "json_field_name")


def declared_fields(joined: DataFrame) -> DataFrame:
    """``event_name, entries``: the fields of every event name in order, each with its first declaration.

    Two ids with the same name merge. Field names that differ only in case would collide as columns, so they count as
    the same field. Equal declarations are first reduced to their least id, a number, in a hash aggregate on both
    sides of the shuffle; what is left of an event is as large as a table is wide, and is sorted out in its array.
    """
    texts = ["field_name", "data_type", "json_field_name"]
    least = (
        joined.where(F.col("field_name").isNotNull() & F.col("event_name").isNotNull())
        .groupBy("event_name", *texts)
        .agg(F.min("field_id").alias("field_id"))
        .withColumn("field_key", F.lower("field_name"))
    )
    by_key = F.struct("field_key", *[name for name in _ENTRY if name != "field_key"])
    grouped = least.groupBy("event_name").agg(F.array_sort(F.collect_list(by_key)).alias("all"))
    first = F.filter("all", lambda entry, at: (at == 0) | (F.get("all", at - 1)["field_key"] != entry["field_key"]))
    in_order = F.transform(first, lambda entry: F.struct(*[entry[name].alias(name) for name in _ENTRY]))
    return grouped.select("event_name", F.array_sort(in_order).alias("entries"))


def field_lists(joined: DataFrame) -> DataFrame:
    """Ordered ``specs`` array per event name."""
    spec = F.transform("entries", lambda e: specs.field_spec(e["field_name"], e["data_type"]))
    return declared_fields(joined).select("event_name", spec.alias("specs"))


def split_at_delimiter(joined: DataFrame, delimiter: str = DELIMITER) -> DataFrame:
    """Mark each field ``outer`` (up to and including the delimiter field) or ``property`` (after it).

    The delimiter is matched by exact name. An event without one has outer fields only and ``has_delimiter`` false.
    """
    keys = F.transform("entries", lambda e: e["field_key"])
    listed = declared_fields(joined).withColumn("end", F.array_position(keys, delimiter.lower()))
    rows = listed.select("event_name", "end", F.posexplode("entries").alias("at", "entry"))
    has_delimiter = F.col("end") > 0
    return rows.select(
        "event_name", "entry.field_id", "entry.field_name", "entry.data_type", "entry.json_field_name",
        F.when(has_delimiter & (F.col("at") >= F.col("end")), F.lit(PROPERTY)).otherwise(F.lit(OUTER)).alias("scope"),
        has_delimiter.alias("has_delimiter"),
    )


def shared_fields(fields: DataFrame) -> DataFrame:
    """The single ordered field list that all events of the one-table job share."""
    return fields.select(
        "id", specs.field_spec("field_name", "data_type").alias("spec"), "json_field_name"
    ).orderBy("id", "spec")


def shared_events(events: DataFrame, event_types: str | Sequence[int]) -> DataFrame:
    return filter_types(events, event_types).select("id", "event_name", "event_type").orderBy("id")
