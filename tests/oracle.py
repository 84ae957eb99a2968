"""Row-for-row comparison of a Spark frame with a DuckDB query on the same parquet files."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {name} as select * from '{path}'")
    return con


def expected(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [column[0] for column in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in cursor.fetchall())


def actual(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())
