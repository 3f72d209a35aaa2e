"""Row-by-row comparison of a query with its SQL counterpart."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_normal(row[i]) for i in order) for row in rows)


_SPARK_KIND = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
               "boolean": "BOOLEAN"}


def differences(df, con, sql: str) -> list[str]:
    """Empty when columns, types and all rows agree bit by bit."""
    relation = con.sql(sql)
    left = {f.name: _SPARK_KIND.get(f.dataType.simpleString(), "?") for f in df.schema.fields}
    right = dict(zip(relation.columns, (str(t) for t in relation.types)))
    found = []
    if left != right:
        found.append(f"schema: {sorted(set(left.items()) ^ set(right.items()))}")
    if set(left) != set(right):
        return found
    mine = _rows(df.columns, [tuple(row) for row in df.collect()])
    theirs = _rows(relation.columns, relation.fetchall())
    if len(mine) != len(theirs):
        found.append(f"rows: {len(mine)} and {len(theirs)}")
    elif mine != theirs:
        wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
        found.append(f"{len(wrong)} of {len(mine)} rows differ, first {wrong[0]}")
    return found
