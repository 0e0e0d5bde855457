"""Run a registered query and its SQL, and compare all values."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def as_bag(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    bag = Counter(tuple(_plain(row[i]) for i in order) for row in rows)
    return [names[i] for i in order], bag


def spark_bag(df):
    return as_bag(df.columns, df.collect())


def duckdb_bag(con, sql: str):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return as_bag(names, result.fetchall())


_KINDS = {
    "TINYINT": "tinyint",
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
}


def duckdb_types(con, sql: str) -> dict[str, str]:
    rows = con.execute(f"DESCRIBE {sql}").fetchall()
    return {row[0]: _KINDS.get(row[1], row[1].lower()) for row in rows}


def differences(left: Counter, right: Counter, n: int = 3):
    return list((left - right).items())[:n], list((right - left).items())[:n]
