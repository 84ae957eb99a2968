"""Textual routing with thousands of names: records of the ``orders`` table, whose event is the customer."""

from pyspark.sql import functions as F

from logweir.config import IngestConfig
from logweir.operators import routing
from logweir.operators.projection import fields_from_specs
from logweir.plans import router
from logweir.registry import register
from logweir.registry.inputs import table
from logweir.sources.catalog import EventCatalog

#: The catalog: more names than a plan could hold as patterns of their own.
NAMES = tuple(f"event_{i}" for i in range(2000))
LONG_NAMES = tuple(f"event_{i:05d}" for i in range(2000))

ORDERS_SQL = """
select o_orderkey, o_custkey, concat('{"prev":{"event":"event_', cast(o_custkey + 1 as varchar), '"},"event":"event_',
  cast(o_custkey as varchar), '","long":"event_', lpad(cast(o_custkey as varchar), 5, '0'), '"}') as value
from orders
"""


def order_records(spark, sf_dir):
    customer = F.col("o_custkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(
            F.lit('{"prev":{"event":"event_'), (customer + 1).cast("string"), F.lit('"},"event":"event_'), customer.cast("string"),
            F.lit('","long":"event_'), F.lpad(customer.cast("string"), 5, "0"), F.lit('"}'),
        ).alias("value"),
    )


@register(
    f"""select o_orderkey, name from ({ORDERS_SQL}), (select concat('event_', cast(unnest(range(2000)) as varchar)) as name)
    where contains(value, concat('"event":"', name, '"'))"""
)
def route_many_names(spark, sf_dir):
    """Each record with every name whose pattern it contains, out of 2,000."""
    found = F.explode(routing.text_events(NAMES)).alias("name")
    return order_records(spark, sf_dir).select("o_orderkey", found)


@register(f"""select o_orderkey from ({ORDERS_SQL}) where regexp_matches(value, '"event":"{'|'.join(LONG_NAMES)}"')""")
def route_many_names_compat(spark, sf_dir):
    """One alternation over the whole pattern: names in the middle are found anywhere."""
    return routing.route(order_records(spark, sf_dir), LONG_NAMES, mode="regex").select("o_orderkey")


@register(
    f"""select name as event, count(*) as n from ({ORDERS_SQL}),
      (select concat('event_', cast(unnest(range(2000)) as varchar)) as name)
    where contains(value, concat('"event":"', name, '"')) group by name"""
)
def tag_many_names(spark, sf_dir):
    """The router's tagged batch under textual routing: one row for each record and table."""
    catalog = EventCatalog(dict.fromkeys(NAMES, fields_from_specs(["asn:int"])))
    settings = IngestConfig(checkpoint_location="unused", routing_mode="regex")
    tagged = router.tag_batch(order_records(spark, sf_dir), catalog, settings)
    return tagged.where("outcome = 'routed'").groupBy("event").agg(F.count(F.lit(1)).alias("n"))
