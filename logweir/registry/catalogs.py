"""Catalog operators over the large catalog."""

from pyspark.sql import functions as F

from logweir.functions import specs
from logweir.operators import catalog
from logweir.registry import register
from logweir.registry.inputs import EVENT_LIST_SQL, FIELD_LIST_SQL, event_list, field_list

JOINED_SQL = f"""
select e.id as event_id, e.event_name, e.event_type, f.id as field_id, f.field_name, f.data_type, f.json_field_name
from ({EVENT_LIST_SQL}) e left join ({FIELD_LIST_SQL}) f on e.id = f.event_id
"""

# One row per event name and field: the first declaration by id.
FIRST_SQL = f"""
select event_name, field_id, field_name, data_type, json_field_name, lower(field_name) as field_key
from ({JOINED_SQL}) where field_name is not null
qualify row_number() over (partition by event_name, lower(field_name)
  order by field_id, field_name, data_type nulls first, json_field_name nulls first) = 1
"""

SPECS_SQL = f"""
select *, nullif(split_part(spec, ':', 1), '') as spec_name,
  case when contains(spec, ':') then substring(spec, strpos(spec, ':') + 1) end as spec_type
from (select event_id, field_id, concat_ws(':', field_name, data_type) as spec from ({JOINED_SQL}))
"""


def _joined(spark, sf_dir):
    return catalog.join_fields(event_list(spark, sf_dir), field_list(spark, sf_dir))


@register(JOINED_SQL)
def catalog_join(spark, sf_dir):
    return _joined(spark, sf_dir)


@register(
    f"""select event_id, field_id, spec, spec_name, spec_type,
      case when spec_type like 'varchar%' then 'string' when spec_type = 'timestamptz' then 'timestamp' else spec_type
      end as spark_type from ({SPECS_SQL})"""
)
def catalog_field_specs(spark, sf_dir):
    return catalog.with_specs(_joined(spark, sf_dir)).select(
        "event_id", "field_id", "spec", "spec_name", "spec_type", "spark_type"
    )


@register(
    f"""select event_name, string_agg(concat_ws(':', field_name, data_type), ',' order by field_id, field_key) as specs
    from ({FIRST_SQL}) group by event_name"""
)
def catalog_field_lists(spark, sf_dir):
    return catalog.field_lists(_joined(spark, sf_dir)).select("event_name", F.array_join("specs", ",").alias("specs"))


@register(f"select id, event_name, event_type from ({EVENT_LIST_SQL}) where event_type in (0, 1)")
def catalog_type_filter(spark, sf_dir):
    return catalog.filter_types(event_list(spark, sf_dir), "0,1")


@register(f"select id, event_name, event_type from ({EVENT_LIST_SQL}) where event_type in (1, 2)")
def catalog_type_filter_text(spark, sf_dir):
    """The list stays text in the plan; parts that are not numbers match nothing."""
    return event_list(spark, sf_dir).where(specs.in_int_list(F.col("event_type"), F.lit("1, x,2")))


@register(
    f"""select event_name, field_name, data_type,
      case when end_id is null or field_id < end_id or (field_id = end_id and field_key <= 'asn') then 'outer'
        else 'property' end as scope,
      end_id is not null as has_delimiter
    from (select *, min(case when field_key = 'asn' then field_id end) over (partition by event_name) as end_id
          from ({FIRST_SQL}))"""
)
def catalog_split_fields(spark, sf_dir):
    return catalog.split_at_delimiter(_joined(spark, sf_dir)).select(
        "event_name", "field_name", "data_type", "scope", "has_delimiter"
    )


@register(
    f"""select id, event_name, event_type from ({EVENT_LIST_SQL}) e
    where not exists (select 1 from ({FIELD_LIST_SQL}) f where f.event_id = e.id)"""
)
def catalog_events_without_fields(spark, sf_dir):
    return catalog.events_without_fields(event_list(spark, sf_dir), field_list(spark, sf_dir))


@register(
    f"""select id, concat_ws(':', field_name, data_type) as spec, json_field_name from ({FIELD_LIST_SQL})
    order by id, spec"""
)
def catalog_shared_fields(spark, sf_dir):
    return catalog.shared_fields(field_list(spark, sf_dir))


@register(f"select id, event_name, event_type from ({EVENT_LIST_SQL}) where event_type = 1 order by id")
def catalog_shared_events(spark, sf_dir):
    return catalog.shared_events(event_list(spark, sf_dir), "1")
