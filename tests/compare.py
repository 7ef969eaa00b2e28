"""Compare a query with its SQL counterpart: column names, types and rows in any order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

_SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    described = {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}
    ours = {c: _SPARK_TYPES.get(t, t) for c, t in df.dtypes}
    if ours != described:
        return [f"schema: {sorted(set(ours.items()) ^ set(described.items()))}"]
    names = sorted(ours)
    got = Counter(tuple(_cell(r[c]) for c in names) for r in df.collect())
    order = ", ".join(f'"{c}"' for c in names)
    want = Counter(tuple(map(_cell, r)) for r in con.execute(f"select {order} from ({sql})").fetchall())
    if got == want:
        return []
    return [f"rows: {got.total()} and {want.total()}", f"only here: {list((got - want).items())[:2]}",
            f"only in SQL: {list((want - got).items())[:2]}", f"columns: {names}"]
