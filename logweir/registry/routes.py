"""Source decoding, start position and routing."""

from pyspark.sql import functions as F

from logweir.operators import routing
from logweir.registry import register
from logweir.registry.inputs import (
    DAMAGED_SQL,
    ENVELOPE_SQL,
    NESTED_SQL,
    TRAILING_SQL,
    damaged,
    nested,
    records,
    routes,
    table,
    trailing,
)
from logweir.sources.stream import decode

SET = ["click", "view", "signup"]
SET_PATTERN = '"event":"click|view|signup"'


@register(f"select value from ({ENVELOPE_SQL})")
def decode_value(spark, sf_dir):
    payload = F.col("value").cast("binary").alias("value")
    return decode(records(spark, sf_dir).select(payload, F.col("event_id").alias("key")))


@register("select event_id, ts, event_type from events where ts >= timestamp '2024-01-15 00:00:00'")
def start_from_timestamp(spark, sf_dir):
    return (
        table(spark, sf_dir, "events")
        .where(F.col("ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
        .select("event_id", "ts", "event_type")
    )


@register("select event_id from events where event_type = 'purchase'")
def route_exact(spark, sf_dir):
    return routing.route(records(spark, sf_dir), "purchase").select("event_id")


@register(f"""select event_id from ({ENVELOPE_SQL}) where regexp_matches(value, '"event":"purchase"')""")
def route_regex_compat(spark, sf_dir):
    return routing.route(records(spark, sf_dir), "purchase", mode="regex").select("event_id")


@register("select event_id, event_type from events where event_type in ('click', 'view', 'signup')")
def route_set(spark, sf_dir):
    return routing.route(records(spark, sf_dir), SET).select("event_id", "event_type")


@register(f"select event_id, event_type from ({ENVELOPE_SQL}) where regexp_matches(value, '{SET_PATTERN}')")
def route_set_compat(spark, sf_dir):
    return routing.route(records(spark, sf_dir), SET, mode="regex").select("event_id", "event_type")


@register("select event_id, event_type from events where event_type = 'purchase'")
def route_nested_exact(spark, sf_dir):
    return routing.route(nested(spark, sf_dir), "purchase").select("event_id", "event_type")


@register(f"""select event_id, event_type from ({NESTED_SQL}) where regexp_matches(value, '"event":"purchase"')""")
def route_nested_compat(spark, sf_dir):
    return routing.route(nested(spark, sf_dir), "purchase", mode="regex").select("event_id", "event_type")


@register("select event_id, event_type as event from events where event_type in ('signup', 'purchase')")
def route_join(spark, sf_dir):
    tagged = routing.tag(records(spark, sf_dir).select("event_id", "value"))
    return routing.route_join(tagged, routes(spark).where("event_type = 1")).select("event_id", "event")


@register("select event_id, event_type as event from events where event_type not in ('signup', 'purchase')")
def unrouted_events(spark, sf_dir):
    tagged = routing.tag(records(spark, sf_dir).select("event_id", "value"))
    return routing.unrouted(tagged, routes(spark).where("event_type = 1")).select("event_id", "event")


@register(f"select event_id, value, 'malformed json' as reason from ({DAMAGED_SQL}) where not json_valid(value)")
def quarantine_malformed(spark, sf_dir):
    return routing.quarantine(damaged(spark, sf_dir)).select("event_id", "value", "reason")


@register(
    f"""select case when not json_valid(value) then 'quarantined'
      when json_extract_string(case when json_valid(value) then value end, '$.event') in ('click', 'view', 'signup')
        then 'routed' else 'unrouted' end as outcome, event_id
    from ({DAMAGED_SQL})"""
)
def record_outcomes(spark, sf_dir):
    return routing.sort_out(damaged(spark, sf_dir), SET).select("event_id", "outcome")


@register(
    f"""select event_id, case when not json_valid(value) then 'quarantined' when event_type in ('click', 'view', 'signup')
        then 'routed' else 'unrouted' end as outcome,
      case when not json_valid(value) then 'text after the record' end as reason
    from ({TRAILING_SQL})"""
)
def trailing_text_outcomes(spark, sf_dir):
    """Only records that are one whole document are used."""
    return routing.sort_out(trailing(spark, sf_dir), SET, one_document=True).select("event_id", "outcome", "reason")
