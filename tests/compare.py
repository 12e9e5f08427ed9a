"""Run a registered query and its oracle SQL and compare rows and schema."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP",
}


def connect(folder: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def difference(frame, connection, sql: str) -> tuple[int, str | None]:
    """Number of rows, and the first difference found (None if equal)."""
    cursor = connection.execute(sql)
    want_schema = {column[0]: str(column[1]) for column in cursor.description}
    got_schema = {f.name: KIND.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in frame.schema}
    names = sorted(got_schema)
    if names != sorted(want_schema):
        return 0, f"columns {names} != {sorted(want_schema)}"
    kinds = {n: (got_schema[n], want_schema[n]) for n in names if got_schema[n] != want_schema[n]}
    if kinds:
        return 0, f"types {kinds}"
    order = [list(want_schema).index(n) for n in names]
    want = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    got = Counter(tuple(row) for row in frame.select(*names).collect())
    if got != want:
        missing, extra = list((want - got).items())[:3], list((got - want).items())[:3]
        return sum(got.values()), f"{names}\n missing {missing}\n extra {extra}"
    return sum(got.values()), None
