"""What happened to a batch: counts per route, one status row per target, and the roll-up."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The states a target can be in after a batch.
FINISHED = "finished"
ERROR = "error"
NO_DATA = "no data"
NO_FIELDS = "no fields"

STATUS_DDL = "table_name string, status string, exception string, row_count bigint, batch_id bigint"


def batch_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def route_counts(tagged: DataFrame, events: DataFrame) -> DataFrame:
    """Rows per catalog event, zero included: count first, then join the few counts to the catalog.

    Records without an event are counted under a name that is never NULL: a null filter for the join would be pushed
    below the count, and parse every record once more.
    """
    counts = tagged.groupBy(F.coalesce("event", F.lit("")).alias("counted")).agg(F.count(F.lit(1)).alias("n"))
    names = events.select("event_name").distinct()
    return names.join(counts, F.col("event_name") == F.col("counted"), "left").select(
        "event_name", F.coalesce("n", F.lit(0)).alias("row_count")
    )


def status_frame(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), STATUS_DDL)


def status_summary(statuses: DataFrame) -> DataFrame:
    return statuses.groupBy("status").agg(
        F.count(F.lit(1)).alias("tables"), F.sum("row_count").alias("row_count")
    )
