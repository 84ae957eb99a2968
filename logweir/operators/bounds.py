"""Size check in front of what is brought to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row

METADATA_ROWS = 200_000
#: Session setting that replaces every bound, for catalogs and schema lists that are larger on purpose.
BOUND_SETTING = "spark.logweir.metadataRows"


def collect_metadata(df: DataFrame, what: str, max_rows: int = METADATA_ROWS) -> list[Row]:
    """Collect planning metadata, refusing (never cutting) anything larger than the bound."""
    bound = int(df.sparkSession.conf.get(BOUND_SETTING, str(max_rows)))
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what} has more than {bound} rows; {BOUND_SETTING} sets that bound")
    return rows
