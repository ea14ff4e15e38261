"""Order-insensitive comparison of a Spark result with DuckDB."""

from __future__ import annotations

import datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> DuckDB type.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ")
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = rows_of(columns, cur.fetchall())
    out = []
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    for name, dtype in df.dtypes:
        if TYPES.get(dtype) != types[name]:
            out.append(f"type of {name}: {dtype} != {types[name]}")
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ, first {bad[0]}")
    return out
