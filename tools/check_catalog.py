"""Run registered queries next to their SQL twins in DuckDB and compare the rows.

usage: python tools/check_catalog.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scanlens.catalog import ORACLES, QUERIES  # noqa: E402
from scanlens.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def spark_rows(frame):
    names = sorted(frame.columns)
    return names, sorted((tuple(_plain(v) for v in row) for row in frame.select(*names).collect()), key=repr)


def duck_rows(connection, sql):
    relation = connection.sql(sql)
    names = sorted(relation.columns)
    picked = ", ".join('"' + n + '"' for n in names)
    rows = connection.sql(f"SELECT {picked} FROM ({sql})").fetchall()
    return names, sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def difference(frame, connection, sql) -> str | None:
    """None when columns and rows agree exactly, else a short description."""
    left_names, left = spark_rows(frame)
    right_names, right = duck_rows(connection, sql)
    if left_names != right_names:
        return f"columns {left_names} != {right_names}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    wrong = [(a, b) for a, b in zip(left, right) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(left)} rows differ, e.g. {left_names}: {wrong[0][0]} != {wrong[0][1]}"
    kinds = [(n, type(a), type(b)) for n, a, b in zip(left_names, left[0], right[0]) if a is not None and type(a) is not type(b)] if left else []
    return f"types differ: {kinds}" if kinds else None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", master="local[8]", spark__ui__enabled="false", spark__driver__memory="12g",
                          spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failures = 0
    for name in chosen:
        start = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            if name in ORACLES:
                message = difference(frame, connection, ORACLES[name])
            else:
                message = None if frame.count() >= 0 else "no rows"
        except Exception as error:  # report and go on with the next query
            message = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'ok  ' if message is None else 'FAIL'} {kind:4} {time.time() - start:6.2f}s {name} {message or ''}", flush=True)
        failures += message is not None
    print(f"{len(chosen) - failures} ok, {failures} failed")
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())
