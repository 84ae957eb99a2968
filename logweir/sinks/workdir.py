"""The shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Executors on other machines must see it, so a temporary folder stands in for it only on a local master.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="logweir-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    return f"{shared_folder(spark)}/logweir/{purpose}-{uuid.uuid4().hex}"


def empty_folder(spark: SparkSession, path: str) -> None:
    """Replaces what a folder holds by an empty table, so that no record texts stay behind."""
    spark.createDataFrame([], "value string").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
