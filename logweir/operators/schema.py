"""Schema discovery: the merged JSON schema of every event in one grouped aggregation.

Types merge pairwise in partial aggregates before the shuffle, so one event with most of the rows still reaches
the final stage as a handful of partial schemas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions import records
from logweir.operators.bounds import collect_metadata


def infer_schemas(tagged: DataFrame) -> DataFrame:
    """``event, schema_ddl, rows, rows_skipped`` for each event in ``tagged(value, event)``.

    A record whose JSON object repeats a key is not a variant, and counts as skipped unless the session sets
    ``spark.sql.variant.allowDuplicateKeys``.
    """
    return (
        tagged.withColumn("doc", F.try_parse_json("value"))
        .groupBy("event")
        .agg(
            F.schema_of_variant_agg("doc").alias("variant_schema"),
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("doc").isNull()).alias("rows_skipped"),
        )
        .select("event", _ddl(F.col("variant_schema")).alias("schema_ddl"), "rows", "rows_skipped")
    )


def _ddl(variant_schema: Column) -> Column:
    """Variant schema text → Spark DDL: objects are structs, and an always-null key is read as text."""
    at_type = r"(?<=: |ARRAY<|^)"  # keys follow a comma or an opening OBJECT<, and stay as they are
    ddl = F.regexp_replace(variant_schema, at_type + "OBJECT<", "STRUCT<")
    return F.regexp_replace(ddl, at_type + r"VOID(?=[,>]|$)", "STRING")


def struct_of(schema_ddl: str) -> T.StructType:
    parsed = T.DataType.fromDDL(schema_ddl)
    return parsed if isinstance(parsed, T.StructType) else T.StructType()


def collect_schemas(tagged: DataFrame) -> dict[str, T.StructType]:
    """Schemas as driver-side metadata: one row per event. Route first, so that the events are catalog events."""
    rows = collect_metadata(infer_schemas(tagged), "the inferred schema list", max_rows=20_000)
    return {row.event: struct_of(row.schema_ddl) for row in rows}


def observed_paths(tagged: DataFrame) -> DataFrame:
    """``event, path, doc`` for every key of every record, nested objects one level deep.

    One scan and one parse: both levels go into one array, and that array is exploded once.
    """
    docs = tagged.select("event", _members(F.try_parse_json("value")).alias("members"))
    nested = F.flatten(F.transform("members", lambda top: F.transform(_members(top["doc"]), lambda m: _below(top, m))))
    return docs.select("event", F.inline(F.concat("members", nested)))


def _members(doc: Column) -> Column:
    """``path, doc`` of every member of an object; of anything else, none."""
    entries = F.map_entries(F.try_variant_get(doc, "$", "map<string,variant>"))
    pairs = F.transform(entries, lambda e: F.struct(e["key"].alias("path"), e["value"].alias("doc")))
    return F.coalesce(pairs, F.array().cast("array<struct<path:string,doc:variant>>"))


def _below(top: Column, member: Column) -> Column:
    return F.struct(F.concat(top["path"], F.lit("."), member["path"]).alias("path"), member["doc"].alias("doc"))


def classify_columns(tagged: DataFrame) -> DataFrame:
    """``event, path, kind, family``: outer scalars, structs and the members of structs, with their type family."""
    return (
        observed_paths(tagged)
        .groupBy("event", "path")
        .agg(F.schema_of_variant_agg("doc").alias("type"))
        .select(
            "event",
            "path",
            F.when(F.col("type").startswith("OBJECT<"), F.lit("struct")).otherwise(F.lit("scalar")).alias("kind"),
            type_family(F.col("type")).alias("family"),
        )
    )


def type_family(variant_type: Column) -> Column:
    """Families, because a variant types numbers as exact decimals where JSON inference says double."""
    return (
        F.when(variant_type.startswith("OBJECT<"), F.lit("object"))
        .when(variant_type.startswith("ARRAY<"), F.lit("array"))
        .when(variant_type.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit("number"))
        .when(variant_type == "BOOLEAN", F.lit("boolean"))
        .when(variant_type == "STRING", F.lit("string"))
        .when(variant_type == "VOID", F.lit("null"))
        .otherwise(F.lit("mixed"))
    )


def parse_flatten(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Parse ``value`` with a known schema and lift the top-level keys to columns; other columns are kept."""
    kept = [name for name in df.columns if name != "value"]
    return df.withColumn("k", F.from_json("value", schema)).select(*kept, "k.*")


def schema_json(df: DataFrame) -> str:
    return df.schema.json()
