"""Schema discovery, parsing, typed projection, coercions and preview."""

from pyspark.sql import functions as F

from logweir.functions import coercion
from logweir.functions import records as rec
from logweir.functions.specs import declared_type
from logweir.operators import projection, routing, schema
from logweir.registry import register
from logweir.registry.inputs import ENVELOPE_SQL, FIELDS, SPECS, TYPED_SQL, records, table

OUTER = [spec for spec in SPECS[:3]]
WIDTH = 40


def _tagged(spark, sf_dir):
    return routing.tag(records(spark, sf_dir).select("event_id", "value"))


def _as_one(tagged):
    """The whole table as one group, so that one schema covers every event."""
    return tagged.withColumn("event", F.lit("*"))


@register(
    f"""select event_type as event, event_id, cast(asn as varchar) as asn, value, cast(k as bigint) as k
    from ({TYPED_SQL})"""
)
def parse_flatten(spark, sf_dir):
    rows = records(spark, sf_dir).select("value")
    found = schema.collect_schemas(_as_one(rows))["*"]
    flat = schema.parse_flatten(rows, found)
    return flat.select(
        "event",
        "event_id",
        "asn",
        F.col("properties_raw.value").cast("double").alias("value"),
        F.col("properties_raw.k").alias("k"),
    )


@register(f"select event_id, ts, asn from ({TYPED_SQL})")
def project_outer(spark, sf_dir):
    fields = projection.fields_from_specs(OUTER)
    return projection.project(records(spark, sf_dir), fields)


@register(f"select event_id, ts, asn from ({TYPED_SQL})")
def project_outer_missing(spark, sf_dir):
    """A declared outer field that no record has is left out, on request."""
    fields = projection.fields_from_specs(["session_id:varchar(8)", *OUTER])
    rows = records(spark, sf_dir).select("value")
    present = schema.collect_schemas(_as_one(rows))["*"].names
    return projection.project(rows, fields, present=present)


@register(f"select event_id, ts, asn, cast(null as varchar) as session_id from ({TYPED_SQL})")
def project_outer_missing_null(spark, sf_dir):
    """The default: a declared outer field that no record has is a typed NULL column."""
    fields = projection.fields_from_specs(["session_id:varchar(8)", *OUTER])
    return projection.project(records(spark, sf_dir), fields)


@register(f"select event_id, value, k from ({TYPED_SQL})")
def project_props(spark, sf_dir):
    fields = [f for f in FIELDS if f.name in ("value", "k")]
    rows = records(spark, sf_dir).withColumn("record", rec.parse_record("value", projection.record_schema(fields)))
    return rows.select("event_id", *projection.property_columns(F.col("record"), fields))


@register(
    f"""select event_id, value, k, cast(null as integer) as clicks, cast(null as timestamp) as seen
    from ({TYPED_SQL})"""
)
def project_props_missing(spark, sf_dir):
    fields = projection.fields_from_specs([*SPECS, "clicks:int", "seen:timestamp_ntz"])
    typed = projection.project(records(spark, sf_dir), fields)
    return typed.select("event_id", "value", "k", "clicks", "seen")


@register(f"select event_id, ts, asn, value, k from ({TYPED_SQL}) where event_type = 'purchase'")
def project_event_table(spark, sf_dir):
    return projection.project(routing.route(records(spark, sf_dir), "purchase"), FIELDS)


@register(f"select event_id, ts, asn, value, k from ({TYPED_SQL})")
def project_legacy_casts(spark, sf_dir):
    rules = projection.CastRules(cast_mode="legacy", width_unit="chars")
    return projection.project(records(spark, sf_dir), FIELDS, rules)


@register(
    f"""select event, path, case when kind = 'OBJECT' then 'struct' else 'scalar' end as kind,
      case when kind = 'OBJECT' then 'object' when kind = 'VARCHAR' then 'string' else 'number' end as family
    from (
      select distinct event, path, kind from (
        select event_type as event, unnest(json_keys(value)) as path, json_type(value, '$.' || path) as kind
        from ({ENVELOPE_SQL})
        union all
        select event_type, 'properties_raw.' || key, json_type(value, '$.properties_raw.' || key)
        from (select event_type, value, unnest(json_keys(value, '$.properties_raw')) as key from ({ENVELOPE_SQL}))))"""
)
def classify_columns(spark, sf_dir):
    return schema.classify_columns(_tagged(spark, sf_dir))


@register(
    """select event_type as event, count(*) as row_count, cast(0 as bigint) as rows_skipped,
      concat('STRUCT<asn: STRING, event: STRING, event_id: NUMBER, ',
        'properties_raw: STRUCT<k: NUMBER, value: NUMBER>, ts: STRING>') as families
    from events group by event_type"""
)
def infer_schema(spark, sf_dir):
    families = F.regexp_replace("schema_ddl", r"\b(BIGINT|DECIMAL\(\d+,\d+\)|DOUBLE)", "NUMBER")
    return schema.infer_schemas(_tagged(spark, sf_dir)).select(
        "event", F.col("rows").alias("row_count"), "rows_skipped", families.alias("families")
    )


@register(f"select doc_id, left(text, {WIDTH}) as text, left(source, 4) as source from documents")
def truncate_columns(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        coercion.coerce(F.col("text"), declared_type(f"varchar({WIDTH})"), width_unit="chars").alias("text"),
        coercion.coerce(F.col("source"), declared_type("varchar(4)"), width_unit="chars").alias("source"),
    )


@register(
    f"""select doc_id, left(text, cast(list_max(list_filter(range(0, {WIDTH} + 1),
      lambda n: strlen(left(text, cast(n as bigint))) <= {WIDTH})) as bigint)) as text from documents"""
)
def truncate_columns_bytes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", coercion.coerce(F.col("text"), declared_type(f"varchar({WIDTH})")).alias("text")
    )


# How the same instant is written by different log producers.
RENDERINGS = (
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy/MM/dd HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
    "yyyyMMddHHmmss",
    "dd MMM yyyy HH:mm:ss",
    "MMM dd, yyyy HH:mm:ss",
)


@register("select event_id, date_trunc('second', ts) as ts from events")
def auto_datetime(spark, sf_dir):
    style = F.col("event_id") % (len(RENDERINGS) + 1)
    written = F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")
    for number, pattern in enumerate(RENDERINGS):
        written = F.when(style == number, F.date_format("ts", pattern)).otherwise(written)
    return (
        table(spark, sf_dir, "events")
        .select("event_id", written.alias("written"))
        .select("event_id", coercion.auto_timestamp(F.col("written"), "timestamp_ntz").alias("ts"))
    )


@register("select event_id, cast(ts as date) as day from events")
def auto_date(spark, sf_dir):
    style = F.col("event_id") % 3
    written = (
        F.when(style == 0, F.date_format("ts", "yyyyMMdd"))
        .when(style == 1, F.date_format("ts", "dd-MMM-yyyy"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    return (
        table(spark, sf_dir, "events")
        .select("event_id", written.alias("written"))
        .select("event_id", coercion.coerce(F.col("written"), declared_type("date")).alias("day"))
    )


@register(
    f"""select cast(event_id as varchar) as event_id, event_type,
      case when length(value) > 20 then left(value, 17) || '...' else value end as value
    from ({ENVELOPE_SQL}) order by cast(event_id as bigint) limit 5"""
)
def preview_rows(spark, sf_dir):
    return projection.preview_rows(records(spark, sf_dir).select("event_id", "event_type", "value"), ["event_id"])


# Numbers of 38 digits, and values of every JSON kind under one key.
EXACT_SQL = """
select event_id, cast('1' || lpad(cast(event_id as varchar), 7, '0') || '98765432109876543210.0123456789' as decimal(38,10)) as amount,
  case event_type when 'click' then '{"k":' || k || ',"list":[1,"1",null]}' when 'view' then '"' || k || '"'
    when 'signup' then 'true' when 'error' then '0.25' end as extra
from (select event_id, event_type, json_extract_string(props, '$.k') as k from events)
"""


def exact_records(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    extra = (
        F.when(F.col("event_type") == "click", F.concat(F.lit('{"k":'), k, F.lit(',"list":[1,"1",null]}')))
        .when(F.col("event_type") == "view", F.concat(F.lit('"'), k, F.lit('"')))
        .when(F.col("event_type") == "signup", F.lit("true"))
        .when(F.col("event_type") == "error", F.lit("0.25"))
        .otherwise(F.lit("null"))
    )
    number = F.concat(F.lit("1"), F.lpad(F.col("event_id").cast("string"), 7, "0"), F.lit("98765432109876543210.0123456789"))
    return table(spark, sf_dir, "events").select(
        F.concat(
            F.lit('{"event":"'), "event_type", F.lit('","event_id":'), F.col("event_id").cast("string"), F.lit(',"asn":1,'),
            F.lit('"properties_raw":{"amount":'), number, F.lit(',"extra":'), extra, F.lit("}}"),
        ).alias("value")
    )


EXACT = ("event_id:bigint", "asn:int", "amount:decimal(38,10)", "extra:super")


@register(f"select event_id, amount from ({EXACT_SQL})")
def project_decimal38(spark, sf_dir):
    """Every digit of a long number arrives."""
    typed = projection.project(exact_records(spark, sf_dir), projection.fields_from_specs(EXACT))
    return typed.select("event_id", "amount")


@register(f"select event_id, extra from ({EXACT_SQL})")
def project_super(spark, sf_dir):
    """Semi-structured values keep their kind: the text "12" is not the number 12, and a JSON null is NULL."""
    typed = projection.project(exact_records(spark, sf_dir), projection.fields_from_specs(EXACT))
    return typed.select("event_id", F.to_json("extra").alias("extra"))
