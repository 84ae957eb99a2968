"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the input folder and ``BENCH_CPUS`` the number of cores. Every query runs once untimed, so that
code generation, the landing table and the catalog are in place, and once timed, up to the last row of its result.
"""

from __future__ import annotations

import json
import os
import time

from logweir.registry import load_all
from logweir.registry.inputs import table
from logweir.session import local_session

HEADLINE = (
    "decode_value",
    "start_from_timestamp",
    "route_exact",
    "route_regex_compat",
    "route_set",
    "route_join",
    "unrouted_events",
    "record_outcomes",
    "quarantine_malformed",
    "parse_flatten",
    "infer_schema",
    "classify_columns",
    "project_event_table",
    "project_legacy_casts",
    "truncate_columns_bytes",
    "auto_datetime",
    "catalog_join",
    "catalog_field_lists",
    "catalog_split_fields",
    "batch_route_counts",
    "stage_json_roundtrip",
    "stage_csv_roundtrip",
    "fanout_union",
    "fanout_cached",
    "single_table",
    "stream_append",
    "stream_single_table",
)


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, app="logweir-bench")
    queries = load_all().queries
    seconds = {}
    for name in HEADLINE:
        timed(queries[name], spark, sf_dir)
        seconds[name] = round(timed(queries[name], spark, sf_dir), 3)
    records = table(spark, sf_dir, "events").count()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cores": int(cores),
                "records": records,
                "router_records_per_sec": round(records / seconds["fanout_union"]),
                "single_table_records_per_sec": round(records / seconds["single_table"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
