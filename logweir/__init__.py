"""logweir: typed, append-only tables from a stream of JSON application-log events."""

from logweir.config import IngestConfig
from logweir.operators.projection import CastRules, FieldSpec, project
from logweir.operators.routing import route
from logweir.operators.schema import infer_schemas
from logweir.plans.batch import Batch, BatchFailed, BatchReport
from logweir.plans.router import route_batch
from logweir.plans.single_table import single_table_batch
from logweir.sinks.ledger import LedgerSink
from logweir.sinks.tables import ConnectorSink, MetastoreSink, ParquetSink, StagedSink
from logweir.sources.catalog import EventCatalog, load_catalog, load_shared_catalog
from logweir.sources.refresh import VersionedCatalog
from logweir.streaming.runner import run_router, run_single_table

__all__ = [
    "Batch",
    "BatchFailed",
    "BatchReport",
    "CastRules",
    "ConnectorSink",
    "EventCatalog",
    "FieldSpec",
    "IngestConfig",
    "LedgerSink",
    "MetastoreSink",
    "ParquetSink",
    "StagedSink",
    "VersionedCatalog",
    "infer_schemas",
    "load_catalog",
    "load_shared_catalog",
    "project",
    "route",
    "route_batch",
    "run_router",
    "run_single_table",
    "single_table_batch",
]
