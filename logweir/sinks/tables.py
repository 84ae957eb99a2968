"""Append-only target tables.

``append(df, table, source_id, batch_id)`` is the whole contract. File tables write each batch into its own
``source_id=…/batch_id=…`` directory and overwrite just that directory, so running a failed batch again replaces
what it had written instead of doubling it. ``source_id`` belongs to the checkpoint: a restart from the same checkpoint
keeps it, a new checkpoint starts a new one and so really appends.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.config import unquote
from logweir.sinks.staging import read_staged, stage
from logweir.sinks.workdir import empty_folder

BATCH_COLUMNS = ("source_id", "batch_id")

_SOURCE_ID = re.compile(r"^[A-Za-z0-9_-]+$")
_IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_$-]*$")


def identifier(name: str) -> str:
    """A checked table or schema name; names come from a catalog and end up in paths and SQL."""
    name = unquote(name)
    if not _IDENTIFIER.match(name):
        raise ValueError(f"not a valid table or schema name: {name!r}")
    return name


def qualified(schema: str, table: str) -> str:
    return f"{identifier(schema)}.{identifier(table)}"


class TableSink(Protocol):
    def append(self, df: DataFrame, table: str, source_id: str, batch_id: int) -> None: ...


@dataclass(frozen=True)
class ParquetSink:
    """Tables as parquet directories under ``root/schema/table``."""

    root: str
    schema: str = "public"

    def path(self, table: str) -> str:
        return f"{self.root}/{identifier(self.schema)}/{identifier(table)}"

    def batch_path(self, table: str, source_id: str, batch_id: int) -> str:
        return f"{self.path(table)}/source_id={source_id}/batch_id={batch_id}"

    def append(self, df: DataFrame, table: str, source_id: str, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(self.batch_path(table, source_id, batch_id))

    def read(self, spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
        """All batches of a table, with the columns of every batch. A declared schema saves looking into the files."""
        reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
        return reader.parquet(self.path(table)).drop(*BATCH_COLUMNS)


@dataclass(frozen=True)
class MetastoreSink:
    """Tables of the session catalog, partitioned by source and batch; ``root`` makes them external tables."""

    schema: str = "default"
    root: str | None = None

    def append(self, df: DataFrame, table: str, source_id: str, batch_id: int) -> None:
        spark, name = df.sparkSession, qualified(self.schema, table)
        if not spark.catalog.tableExists(name):
            self._create(df, name)
        if not _SOURCE_ID.match(source_id):
            raise ValueError(f"not a valid source id: {source_id!r}")
        known = [c for c in spark.table(name).columns if c not in BATCH_COLUMNS]
        if new := set(df.columns) - set(known):
            raise ValueError(f"table {name} has no columns {sorted(new)}")
        kinds = {f.name: f.dataType for f in spark.table(name).schema}
        named = df.select(*(F.col(c) if c in df.columns else F.lit(None).cast(kinds[c]).alias(c) for c in known))
        partition = f"source_id = '{source_id}', batch_id = {int(batch_id)}"
        spark.sql(f"INSERT OVERWRITE {name} PARTITION ({partition}) SELECT * FROM {{batch}}", batch=named)

    def _create(self, df: DataFrame, name: str) -> None:
        marks = {"source_id": F.lit("").cast("string"), "batch_id": F.lit(0).cast("bigint")}
        writer = df.withColumns(marks).limit(0).write.mode("ignore").partitionBy(*BATCH_COLUMNS)
        if self.root:
            writer = writer.option("path", f"{self.root}/{name.replace('.', '/')}")
        writer.saveAsTable(name)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.table(qualified(self.schema, table)).drop(*BATCH_COLUMNS)


@dataclass(frozen=True)
class StagedSink:
    """Stage the typed rows as text files first, then load the target table from exactly those files.

    The files are emptied once they are loaded, or if loading fails, unless ``keep`` says otherwise.
    """

    target: ParquetSink
    staging_root: str
    staging_format: str = "JSON"
    keep: bool = False

    def append(self, df: DataFrame, table: str, source_id: str, batch_id: int) -> None:
        path = f"{self.staging_root}/{identifier(table)}/source_id={source_id}/batch_id={batch_id}"
        try:
            stage(df, path, self.staging_format)
            staged = read_staged(df.sparkSession, path, df.schema, self.staging_format)
            self.target.append(staged, table, source_id, batch_id)
        finally:
            if not self.keep:
                empty_folder(df.sparkSession, path)

    def read(self, spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
        return self.target.read(spark, table, schema)


@dataclass(frozen=True)
class ConnectorSink:
    """Any Spark data source that appends to ``schema.table``: a warehouse connector, or ``jdbc``.

    On its own delivery is at-least-once: a repeated batch is appended again. ``LedgerSink`` makes it exactly-once.
    ``prefix`` stands before the table name, for formats whose tables are paths.
    """

    format: str
    schema: str
    options: Mapping[str, str] = field(default_factory=dict, repr=False)
    table_option: str = "dbtable"
    prefix: str = ""

    def table_options(self, table: str) -> dict[str, str]:
        return {**self.options, self.table_option: self.prefix + qualified(self.schema, table)}

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format(self.format).options(**self.table_options(table)).load()

    def append(self, df: DataFrame, table: str, source_id: str, batch_id: int) -> None:
        df.write.format(self.format).options(**self.table_options(table)).mode("append").save()


def copy_options(region: str) -> str:
    """Load options of the warehouse: cut long texts, recognise dates and times."""
    return f"TRUNCATECOLUMNS region '{region}' dateformat 'auto' timeformat 'auto'"


def warehouse_options(properties: Mapping[str, str]) -> dict[str, str]:
    """Connector options from the job properties."""
    p = properties
    return {
        "url": f"jdbc:redshift://{p['redshift_host']}:{p['redshift_port']}/{p['redshift_database']}",
        "user": p["redshift_username"],
        "password": p["redshift_password"],
        "tempdir": p["redshift_tmpdir"],
        "tempformat": p.get("tempformat") or "JSON",
        "s3_endpoint": p["s3_endpoint"],
        "aws_iam_role": p["redshift_iam_role"],
        "extracopyoptions": copy_options(p["aws_region"]),
    }
