"""Compares a query with its SQL in DuckDB: same columns, types and rows in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TYPES = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "MAP(VARCHAR, VARCHAR)": "map<string,string>",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def sort_key(row: tuple) -> tuple:
    return tuple((v is None, repr(v)) for v in row)


def same(a: object, b: object) -> bool:
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return a == b


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences found, none if equal."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    order = sorted(names)
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    wanted = {row[0]: TYPES.get(row[1], row[1]) for row in described}
    problems = [
        f"type of {n}: {t} instead of {wanted[n]}" for n, t in df.dtypes if t != wanted[n]
    ]
    place = [names.index(n) for n in order]
    left = sorted((tuple(r) for r in df.select(*order).collect()), key=sort_key)
    right = sorted((tuple(r[i] for i in place) for r in expected), key=sort_key)
    if len(left) != len(right):
        problems.append(f"{len(left)} rows instead of {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if not all(same(x, y) for x, y in zip(a, b))]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {bad[0]}")
    return problems
