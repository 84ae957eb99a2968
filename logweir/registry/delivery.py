"""Exactly-once delivery to targets that only append: the first run dies at some point of a batch, the second ends it."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from logweir.operators.projection import table_schema
from logweir.plans.batch import Batch
from logweir.plans.router import route_batch
from logweir.registry import register
from logweir.registry.inputs import FIELDS, SEEN, TYPED_SQL, records, route_catalog
from logweir.registry.sinks import TABLES_SQL, config, quiet
from logweir.registry.streams import _files_config
from logweir.sinks.ledger import ROW_MARK, LedgerSink
from logweir.sinks.tables import ConnectorSink
from logweir.sinks.workdir import new_folder
from logweir.streaming.runner import run_router


class Died(RuntimeError):
    """Stands for a lost driver."""


@dataclass(frozen=True)
class DyingSink(ConnectorSink):
    """Appends all or some rows of one table and dies, once."""

    victim: str = "purchase"
    share: int = 1
    deaths: list = field(default_factory=list)

    def append(self, df, table, source_id, batch_id):
        if table != self.victim or self.deaths:
            return super().append(df, table, source_id, batch_id)
        self.deaths.append(batch_id)
        if self.share:
            super().append(df.where(F.col(ROW_MARK) % self.share == 0), table, source_id, batch_id)
        raise Died(f"{table}, batch {batch_id}")


def union_of(spark, sink, names=SEEN):
    columns = [f.name for f in table_schema(FIELDS)]
    tables = [sink.read(spark, name).select(*columns).withColumn("table_name", F.lit(name)) for name in names]
    union = tables[0]
    for other in tables[1:]:
        union = union.unionByName(other)
    return union


def _stream_dies(spark, sf_dir, share):
    """The job dies in a batch and is started again from its checkpoint."""
    folder = new_folder(spark, "exactly-once")
    records(spark, sf_dir).select("event_id", "value").write.parquet(f"{folder}/input")
    target = DyingSink("parquet", "public", table_option="path", prefix=f"{folder}/", share=share)
    sink, settings = LedgerSink(target, f"{folder}/ledger"), _files_config(folder)
    try:
        run_router(spark, settings, route_catalog(spark), sink).awaitTermination()
    except Exception as err:
        if "Died" not in str(err) and "purchase, batch 0" not in str(err):
            raise
    run_router(spark, settings, route_catalog(spark), sink).awaitTermination()
    if target.deaths != [0]:
        raise AssertionError("the first run was meant to die in batch 0")
    return union_of(spark, sink)


@register(TABLES_SQL)
def exactly_once_after_append(spark, sf_dir):
    """All rows of one table are in the target, the batch is not committed."""
    return _stream_dies(spark, sf_dir, share=1)


@register(TABLES_SQL)
def exactly_once_within_append(spark, sf_dir):
    """A third of the rows of one table are in the target."""
    return _stream_dies(spark, sf_dir, share=3)


@register(TABLES_SQL)
def exactly_once_before_append(spark, sf_dir):
    return _stream_dies(spark, sf_dir, share=0)


@register(
    f"""select event_type as table_name, event_id, ts, asn, value, k from ({TYPED_SQL})
    union all select event_type, event_id, ts, asn, value, k from ({TYPED_SQL})"""
)
def at_least_once_doubles(spark, sf_dir):
    """The same connector without a ledger: a repeated batch is there twice."""
    folder = new_folder(spark, "at-least-once")
    target = ConnectorSink("parquet", "public", table_option="path", prefix=f"{folder}/")
    batch = Batch(records(spark, sf_dir).select("value"), 0, uuid.uuid4().hex)
    for _ in range(2):
        route_batch(batch, route_catalog(spark), target, config(folder), quiet)
    return union_of(spark, _Plain(target))


@dataclass(frozen=True)
class _Plain:
    target: ConnectorSink

    def read(self, spark, table):
        return self.target.load(spark, table)
