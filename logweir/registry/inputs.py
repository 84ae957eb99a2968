"""Inputs of the registered queries, all derived from the given tables, in Spark and in SQL.

* the record stream is the ``events`` table written as JSON envelopes;
* the small routing catalog has the five event types of that table plus one that never occurs and one without fields;
* the large catalog, for the relational catalog operators, reads ``orders`` as events and ``lineitem`` as fields.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.operators.projection import FieldSpec, fields_from_specs
from logweir.sinks.workdir import new_folder
from logweir.sources.catalog import EventCatalog, load_catalog


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- the record stream -------------------------------------------------------------------------------------------

ENVELOPE_SQL = """
select event_id, event_type, ts, user_id, event_value, k,
  concat('{"event":"', event_type, '","event_id":', cast(event_id as varchar),
    ',"ts":"', strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '","asn":"', cast(64512 + user_id as varchar),
    '","properties_raw":{"value":', cast(event_value as varchar), ',"k":', k, '}}') as value
from (select event_id, event_type, ts, user_id, value as event_value, json_extract_string(props, '$.k') as k
      from events)
"""

TYPED_SQL = """
select event_type, event_id, ts, cast(64512 + user_id as integer) as asn, value,
  cast(json_extract_string(props, '$.k') as integer) as k
from events
"""


def envelopes(events: DataFrame) -> DataFrame:
    """``events`` rows with their record text."""
    k = F.get_json_object("props", "$.k")
    return events.select(
        "event_id",
        "event_type",
        "ts",
        "user_id",
        F.col("value").alias("event_value"),
        k.alias("k"),
        F.concat(
            F.lit('{"event":"'),
            "event_type",
            F.lit('","event_id":'),
            F.col("event_id").cast("string"),
            F.lit(',"ts":"'),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            F.lit('","asn":"'),
            (64512 + F.col("user_id")).cast("string"),
            F.lit('","properties_raw":{"value":'),
            F.col("value").cast("string"),
            F.lit(',"k":'),
            k,
            F.lit("}}"),
        ).alias("value"),
    )


_landing: dict[tuple[str, str], tuple[str, T.StructType]] = {}


def landing_area(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """Folder and schema of the records as they land: written once per application into the shared folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landing:
        files = int(spark.conf.get("spark.sql.shuffle.partitions"))
        incoming = envelopes(table(spark, sf_dir, "events")).repartition(files)
        folder = new_folder(spark, "records")
        incoming.write.parquet(folder)
        _landing[key] = (folder, incoming.schema)
    return _landing[key]


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed records, as every query reads them."""
    folder, schema = landing_area(spark, sf_dir)
    return spark.read.schema(schema).parquet(folder)


# Records as they look when a transfer was cut short: the text of low-value events misses its last three characters.
DAMAGED_SQL = f"""
select event_id, case when event_value < 10 then left(value, length(value) - 3) else value end as value
from ({ENVELOPE_SQL})
"""


def damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    cut = F.left(value, F.length(value) - 3)
    text = F.when(F.col("event_value") < 10, cut).otherwise(value)
    return records(spark, sf_dir).select("event_id", text.alias("value"))


# Records that share their message with other text: a second document, a bracket too many, or just white space.
TRAILING_SQL = f"""
select event_id, event_type, concat(value, case when event_value < 5 then ' {{"event":"view"}}' when event_value < 10 then '}}'
  when event_value < 15 then ']' when event_value < 20 then ',' when event_value < 30 then '  ' else '' end) as value
from ({ENVELOPE_SQL})
"""


def trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("event_value")
    more = F.when(size < 5, ' {"event":"view"}').when(size < 10, "}").when(size < 15, "]").when(size < 20, ",")
    text = F.concat("value", more.when(size < 30, "  ").otherwise(""))
    return records(spark, sf_dir).select("event_id", text.alias("value"))


# Records that quote an earlier event in a nested object: textual and structural routing disagree on them.
NESTED_SQL = f"""
select event_id, event_type,
  concat('{{"prev":{{"event":"', case when event_value < 50 then 'purchase' else 'view' end, '"}},',
    substring(value, 2)) as value
from ({ENVELOPE_SQL})
"""


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier = F.when(F.col("event_value") < 50, "purchase").otherwise("view")
    text = F.concat(F.lit('{"prev":{"event":"'), earlier, F.lit('"},'), F.substring("value", 2, 2**30))
    return records(spark, sf_dir).select("event_id", "event_type", text.alias("value"))


# ---- the small routing catalog -------------------------------------------------------------------------------------

ROUTES_SQL = """
select * from (values (1, 'click', 0), (2, 'view', 0), (3, 'signup', 1), (4, 'purchase', 1), (5, 'error', 2),
  (6, 'refund', 2), (7, 'ghost', 1)) as t(id, event_name, event_type)
"""

SPECS = ("event_id:bigint", "ts:timestamp_ntz", "asn:int", "value:double", "k:int")

FIELDS: tuple[FieldSpec, ...] = fields_from_specs(SPECS)

# The tables an event type of the given data can have, and the two catalog events that stay empty.
SEEN = ("click", "error", "purchase", "signup", "view")


def routes(spark: SparkSession) -> DataFrame:
    return spark.sql(ROUTES_SQL)


def route_fields(spark: SparkSession) -> DataFrame:
    pairs = [tuple(spec.split(":")) for spec in SPECS]
    fields = spark.createDataFrame(
        [(position, *pair) for position, pair in enumerate(pairs, 1)], "pos int, field_name string, data_type string"
    )
    owners = routes(spark).where("event_name <> 'ghost'").select(F.col("id").alias("event_id"))
    everywhere = owners.withColumn("pos", F.explode(F.sequence(F.lit(1), F.lit(len(SPECS)))))
    return everywhere.join(fields, "pos").select(
        (F.col("event_id") * 10 + F.col("pos")).alias("id"),
        "event_id",
        "field_name",
        "data_type",
        F.lit(None).cast("string").alias("json_field_name"),
    )


_catalogs: dict[str, EventCatalog] = {}


def route_catalog(spark: SparkSession) -> EventCatalog:
    """A job loads its catalog once, when it starts."""
    application = spark.sparkContext.applicationId
    if application not in _catalogs:
        _catalogs[application] = load_catalog(routes(spark), route_fields(spark))
    return _catalogs[application]


# ---- the large catalog ---------------------------------------------------------------------------------------------

EVENT_LIST_SQL = """
select o_orderkey as id, concat('event_', cast(o_custkey as varchar)) as event_name,
  case o_orderstatus when 'O' then 0 when 'F' then 1 else 2 end as event_type
from orders
"""

_FIELD_NAME = """case l_linenumber when 1 then 'event_id' when 2 then 'ts' when 3 then 'asn' when 4 then 'value'
  when 5 then 'k' when 6 then 'note' else case when l_linestatus = 'O' then 'flag' end end"""
_DATA_TYPE = """case l_linenumber when 1 then 'bigint' when 2 then 'timestamptz' when 3 then 'int' when 4 then 'double'
  when 5 then 'varchar(8)' when 6 then 'varchar' end"""

FIELD_LIST_SQL = f"""
select id, event_id, case when shout then upper(name) else name end as field_name, data_type,
  case when renamed then 'src_' || name end as json_field_name
from (select l_orderkey * 10 + l_linenumber as id, l_orderkey as event_id, l_discount >= 0.05 as shout,
        l_returnflag = 'R' as renamed, {_FIELD_NAME} as name, {_DATA_TYPE} as data_type
      from lineitem)
"""


def event_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("event_"), F.col("o_custkey").cast("string")).alias("event_name"),
        F.when(status == "O", 0).when(status == "F", 1).otherwise(2).alias("event_type"),
    )


def field_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, data_type = F.expr(_FIELD_NAME), F.expr(_DATA_TYPE)
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("event_id"),
        F.when(F.col("l_discount") >= 0.05, F.upper(name)).otherwise(name).alias("field_name"),
        data_type.alias("data_type"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("src_"), name)).alias("json_field_name"),
    )
