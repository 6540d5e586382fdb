"""Run a query and its SQL twin and say how they differ."""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

_KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def _rows(rows, order) -> list[tuple]:
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    found = []
    twin = con.execute(sql)
    names = [d[0] for d in twin.description]
    kinds = {d[0]: str(d[1]) for d in twin.description}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if _KINDS.get(kind) != kinds[name]:
            found.append(f"type of {name}: {kind} != {kinds[name]}")
    wanted = sorted(names)
    ours = _rows(df.collect(), [df.columns.index(n) for n in wanted])
    theirs = _rows(twin.fetchall(), [names.index(n) for n in wanted])
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} != {len(theirs)}")
    elif ours != theirs:
        unlike = [(a, b) for a, b in zip(ours, theirs) if a != b]
        found.append(f"{len(unlike)} rows differ, first {wanted}: {unlike[0]}")
    return found
