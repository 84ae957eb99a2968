"""Intermediate tables in the folder that driver and executors share.

The folder is the cluster's ``spark.checkpoint.dir``. Only a local master, as in tests, may go without that setting;
a temporary folder of the machine serves then. Staged tables are deleted when the Python process ends.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_staged: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, set to a temporary folder where it is unset and the master is local."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="logweir-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def staged_path(spark: SparkSession) -> str:
    """A new place in the shared folder, deleted with the others."""
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    _staged.append((spark, path))
    return path


def stage(frame: DataFrame, row_group: int = 128 << 20) -> DataFrame:
    """Writes ``frame`` once and returns the table read back: later uses neither recompute it nor depend on executors.

    ``row_group`` is the size in bytes of a row group; smaller ones keep readers of long rows small.
    """
    path = staged_path(frame.sparkSession)
    frame.write.option("parquet.block.size", row_group).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of frames that are no longer referenced, which else wait for the JVM's garbage."""
    for _ in range(2):  # the first round frees the frames, the second what they held
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def drop_staged() -> None:
    """Deletes all staged tables of this process; results that still read them must have been written before."""
    while _staged:
        spark, path = _staged.pop()
        context = spark.sparkContext
        if context._jsc is None:
            continue
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _at_exit() -> None:
    try:
        drop_staged()
    except Exception:  # noqa: BLE001  the JVM may be gone already
        _staged.clear()
