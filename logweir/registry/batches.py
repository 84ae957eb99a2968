"""Batch counts and statuses."""

import uuid

from logweir.operators import routing, status
from logweir.plans.batch import Batch
from logweir.plans.router import route_batch
from logweir.registry import register
from logweir.registry.inputs import ROUTES_SQL, records, route_catalog, routes
from logweir.registry.sinks import config, quiet
from logweir.sinks.tables import ParquetSink
from logweir.sinks.workdir import new_folder

COUNTS_SQL = f"""
select r.event_name, count(e.event_id) as row_count
from ({ROUTES_SQL}) r left join events e on e.event_type = r.event_name group by r.event_name
"""

STATUS_SQL = f"""
select event_name as table_name, case when event_name = 'ghost' then 'no fields' when row_count = 0 then 'no data'
  else 'finished' end as status, cast(null as varchar) as exception, row_count, cast(0 as bigint) as batch_id
from ({COUNTS_SQL})
"""


def _counts(spark, sf_dir):
    return status.route_counts(routing.tag(records(spark, sf_dir)), routes(spark))


def _report(spark, sf_dir):
    """What the router itself reports for a batch of all records."""
    folder = new_folder(spark, "status")
    batch = Batch(records(spark, sf_dir).select("value"), 0, uuid.uuid4().hex)
    return route_batch(batch, route_catalog(spark), ParquetSink(folder), config(folder), quiet).frame(spark)


@register("select count(*) as row_count from events")
def batch_count(spark, sf_dir):
    return status.batch_count(records(spark, sf_dir))


@register(COUNTS_SQL)
def batch_route_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@register(STATUS_SQL)
def status_report(spark, sf_dir):
    return _report(spark, sf_dir)


@register(
    f"""select status, count(*) as tables, cast(sum(row_count) as bigint) as row_count
    from ({STATUS_SQL}) group by status"""
)
def status_summary(spark, sf_dir):
    return status.status_summary(_report(spark, sf_dir))
