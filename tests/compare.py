"""Compare a Spark result with its DuckDB twin: column names, types, and rows as a multiset."""

from __future__ import annotations

from collections import Counter
from datetime import datetime
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "DOUBLE": "double",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value: object) -> object:
    return value.replace(tzinfo=None) if isinstance(value, datetime) else value


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    relation = con.sql(sql)
    columns = sorted(df.columns)
    if columns != sorted(relation.columns):
        return [f"columns {columns} vs {sorted(relation.columns)}"]
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    found = [
        f"type of {name}: {kind} vs {kinds[name]}"
        for name, kind in df.dtypes if TYPES.get(kinds[name], kinds[name]) != kind
    ]
    rows = [tuple(_plain(v) for v in row) for row in df.select(*columns).collect()]
    order = [relation.columns.index(c) for c in columns]
    twin = [tuple(_plain(row[i]) for i in order) for row in relation.fetchall()]
    mine, theirs = Counter(rows), Counter(twin)
    if mine != theirs:
        found.append(f"{len(rows)} vs {len(twin)} rows")
        found += [f"only here: {row}" for row in list((mine - theirs).elements())[:3]]
        found += [f"only there: {row}" for row in list((theirs - mine).elements())[:3]]
    return found
