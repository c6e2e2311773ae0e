"""Run a registered query and its SQL on the same tables and compare whole results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def load(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or value != value:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        if value.is_integer():
            return int(value)
        return round(value, 9 - math.ceil(math.log10(abs(value))))
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return _rows([d[0] for d in result.description], result.fetchall())
