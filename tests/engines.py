"""Run registered queries on Spark and their SQL on DuckDB, and compare the row sets."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def cell(value):
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, (float, decimal.Decimal)):
        return round(float(value), 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def bag(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(cell(row[i]) for i in order) for row in rows)


def spark_rows(frame):
    return sorted(frame.columns), bag(frame.columns, frame.collect())


def duck_rows(con, sql: str):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), bag(names, cursor.fetchall())
