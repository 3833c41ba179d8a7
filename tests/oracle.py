"""Compare a Spark result with its SQL oracle: names, types and every row."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Spark type -> DuckDB type of the same meaning.
SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(directory, f"{name}.parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """The differences found; an empty list means equal results."""
    problems = []
    expected = con.sql(sql)
    theirs = dict(zip(expected.columns, [str(t) for t in expected.types]))
    ours = {f.name: SAME_TYPE.get(f.dataType.simpleString(), "?") for f in df.schema.fields}
    if ours != theirs:
        problems.append(f"schema: {ours} != {theirs}")
    names = sorted(theirs)
    order = [expected.columns.index(n) for n in names]
    want = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    have = Counter(tuple(row[n] for n in names) for row in df.collect())
    if want != have:
        missing, extra = want - have, have - want
        problems.append(
            f"rows: {sum(have.values())} != {sum(want.values())}; "
            f"missing {list(missing)[:3]}, extra {list(extra)[:3]}"
        )
    return problems
