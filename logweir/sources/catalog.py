"""The catalog as the streaming jobs use it: loaded once, checked for size, validated, and then plain metadata."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweir.functions.records import PROPERTIES_KEY
from logweir.functions.specs import declared_type
from logweir.operators import catalog as ops
from logweir.operators.bounds import collect_metadata
from logweir.operators.projection import FieldSpec

# Names of the catalog tables in the metadata database.
ROUTER_TABLES = ("event_list", "event_field_list")
SINGLE_TABLES = ("realtime_events_event_list", "realtime_events_event_field_list")


@dataclass(frozen=True)
class EventCatalog:
    """Event name → ordered fields; an event may have none. ``shared`` is the one list of the single-table job."""

    fields: Mapping[str, tuple[FieldSpec, ...]]
    warnings: tuple[str, ...] = field(default=())
    shared: tuple[FieldSpec, ...] = field(default=())

    @property
    def event_names(self) -> list[str]:
        return list(self.fields)


def read_table(spark: SparkSession, table: str, fmt: str, options: Mapping[str, str]) -> DataFrame:
    """A catalog table over JDBC (``fmt="jdbc"``), from files, or from a metastore (``fmt="table"``)."""
    if fmt == "table":
        return spark.read.table(table)
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**options).option("dbtable", table).load()
    return spark.read.format(fmt).options(**options).load(f"{options['root']}/{table}")


def mysql_options(properties: Mapping[str, str]) -> dict[str, str]:
    """Reader options for the metadata database named in the job properties."""
    p = properties
    return {
        "url": f"jdbc:mysql://{p['metadata_host']}:{p['metadata_port']}/{p['metadata_database']}",
        "user": p["metadata_username"],
        "password": p["metadata_password"],
    }


def load_catalog(
    events: DataFrame,
    fields: DataFrame,
    event_types: str = "0,1,2",
    delimiter: str = ops.DELIMITER,
    use_json_field_name: bool = False,
) -> EventCatalog:
    """Per-event field lists: join, type filter, merge of equal names and the outer/property split run in Spark."""
    wanted = ops.filter_types(events, event_types)
    names = wanted.select("event_name").distinct().orderBy("event_name")
    split = ops.split_at_delimiter(ops.join_fields(wanted, fields), delimiter)
    declared = {row.event_name: [] for row in collect_metadata(names, "the event list")}
    warnings = []
    for row in collect_metadata(split.orderBy("event_name", "field_id", "field_name"), "the field list"):
        if not declared[row.event_name] and not row.has_delimiter:
            warnings.append(f"event {row.event_name!r} has no {delimiter!r} field; all its fields are outer fields")
        declared[row.event_name].append(_field(row, use_json_field_name))
    return EventCatalog({name: tuple(specs) for name, specs in declared.items()}, tuple(warnings))


def load_shared_catalog(
    events: DataFrame,
    fields: DataFrame,
    event_types: str = "0,1,2",
    delimiter: str = ops.DELIMITER,
    use_json_field_name: bool = False,
) -> tuple[EventCatalog, tuple[FieldSpec, ...]]:
    """The one-table job's catalog: the event names in id order, and the one field list they all share."""
    names = collect_metadata(ops.shared_events(events, event_types), "the event list")
    one_event = fields.select(
        F.lit("*").alias("event_name"), F.col("id").alias("field_id"), "field_name", "data_type", "json_field_name"
    )
    split = ops.split_at_delimiter(one_event, delimiter).orderBy("field_id", "field_name")
    rows = collect_metadata(split, "the field list")
    specs = tuple(_field(row, use_json_field_name) for row in rows)
    warnings = ()
    if rows and not rows[0].has_delimiter:
        warnings = (f"no {delimiter!r} field; all fields are outer fields",)
    return EventCatalog({row.event_name: specs for row in names}, warnings, specs), specs


def _field(row, use_json_field_name: bool) -> FieldSpec:
    if row.data_type is None:
        raise ValueError(f"field {row.field_name!r} has no type")
    if row.field_name == PROPERTIES_KEY and row.scope == ops.OUTER:
        raise ValueError(f"{PROPERTIES_KEY!r} holds the properties and cannot be an outer field")
    declared_type(row.data_type)
    source = row.json_field_name if use_json_field_name and row.json_field_name else None
    return FieldSpec(row.field_name, row.data_type, row.scope, source)
