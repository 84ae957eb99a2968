"""Command line: ``python -m logweir.job router|single <region> <properties path>``."""

from __future__ import annotations

import sys
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from logweir.config import IngestConfig, load_properties, redacted
from logweir.sinks.ledger import LedgerSink
from logweir.sinks.tables import ConnectorSink, ParquetSink, StagedSink, TableSink, warehouse_options
from logweir.sources import catalog as catalogs
from logweir.sources.catalog import EventCatalog
from logweir.sources.refresh import VersionedCatalog
from logweir.streaming.runner import run_router, run_single_table

# Fixed value: the community warehouse connector's data source name; ``sink_format`` in the properties replaces it.
WAREHOUSE_FORMAT = "io.github.spark_redshift_community.spark.redshift"


def make_sink(properties: Mapping[str, str], config: IngestConfig) -> TableSink:
    """The warehouse connector, or parquet tables under ``table_root`` (by way of ``staging_root``, if given).

    With ``ledger_location`` the connector's appends are exactly-once; its tables then need the two mark columns.
    """
    if "table_root" not in properties:
        fmt = properties.get("sink_format", WAREHOUSE_FORMAT)
        own = {key[5:]: text for key, text in properties.items() if key.startswith("sink.")}
        options = own or warehouse_options(properties)
        target = ConnectorSink(
            fmt, config.target_schema, options, properties.get("sink_table_option", "dbtable"), properties.get("sink_prefix", "")
        )
        ledger = properties.get("ledger_location")
        return LedgerSink(target, ledger) if ledger else target
    tables = ParquetSink(properties["table_root"], config.target_schema)
    staging = properties.get("staging_root")
    return StagedSink(tables, staging, config.staging_format) if staging else tables


def catalog_tables(spark: SparkSession, properties: Mapping[str, str], names: tuple[str, str]) -> list[DataFrame]:
    """The two catalog tables from the metadata database, or from files under ``catalog_root``."""
    fmt = properties.get("catalog_format", "jdbc")
    root = properties.get("catalog_root")
    options = {"root": root} if root else catalogs.mysql_options(properties)
    return [catalogs.read_table(spark, name, fmt, options) for name in names]


def start(spark: SparkSession, job: str, properties: Mapping[str, str]) -> StreamingQuery:
    config = IngestConfig.from_properties(properties)
    sink = make_sink(properties, config)
    settings = (config.event_types, config.delimiter, config.use_json_field_name)
    router = job == "router"
    table_names = catalogs.ROUTER_TABLES if router else catalogs.SINGLE_TABLES

    def load() -> EventCatalog:
        tables = catalog_tables(spark, properties, table_names)
        return catalogs.load_catalog(*tables, *settings) if router else catalogs.load_shared_catalog(*tables, *settings)[0]

    catalog: EventCatalog | VersionedCatalog = load()
    for warning in catalog.warnings:
        print(f"warning: {warning}")
    names, fields = catalog.event_names, catalog.shared
    if "catalog_refresh_seconds" in properties:
        root = properties.get("catalog_versions", f"{config.checkpoint_location}-catalog")
        seconds = float(properties["catalog_refresh_seconds"])
        names = catalog = VersionedCatalog(spark, load, root, seconds, on_change=print)
    if router:
        return run_router(spark, config, catalog, sink, on_report=print)
    return run_single_table(spark, config, names, fields, sink, on_report=print)


def main(argv: list[str]) -> None:
    if len(argv) != 3 or argv[0] not in ("router", "single"):
        sys.exit("usage: python -m logweir.job router|single <region> <properties path>")
    job, region, path = argv
    spark = SparkSession.builder.appName(f"logweir-{job}").getOrCreate()
    properties = {"aws_region": region, **load_properties(spark, path)}
    print(f"properties: {redacted(properties)}")
    start(spark, job, properties).awaitTermination()


if __name__ == "__main__":
    main(sys.argv[1:])
