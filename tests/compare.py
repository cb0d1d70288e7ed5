"""Run a registered query on Spark and its SQL on DuckDB and compare rows, types and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

KINDS = {"int": "integer", "bigint": "bigint", "double": "double", "boolean": "boolean", "string": "varchar"}
KINDS |= {"timestamp_ntz": "timestamp", "date": "date"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        assert not math.isnan(value), "NaN in a result"
        return repr(value)
    return str(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    found = []
    result = con.execute(sql)
    theirs = {d[0]: str(d[1]).lower() for d in result.description}
    ours = {c: KINDS.get(t, t) for c, t in df.dtypes}
    if ours != theirs:
        found.append(f"schema: spark {ours} duckdb {theirs}")
    if set(ours) != set(theirs):
        return found
    left = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    right = _sorted_rows(list(theirs), result.fetchall())
    if len(left) != len(right):
        found.append(f"rows: spark {len(left)} duckdb {len(right)}")
    a, b = set(left) - set(right), set(right) - set(left)
    if left != right:
        found.append(f"values: only spark {sorted(a)[:3]} only duckdb {sorted(b)[:3]}")
    return found
