"""Compare a Spark result with DuckDB's, ignoring row and column order."""

from __future__ import annotations

import glob
import math
import os
from datetime import date, datetime

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (1, repr(value + 0.0))
    if isinstance(value, datetime):
        return (1, value.isoformat())
    if isinstance(value, date):
        return (1, value.isoformat())
    return (1, str(value))


def normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = sorted(tuple(_cell(row[i]) for i in order) for row in rows)
    return [columns[i] for i in order], cells


def spark_rows(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(db, sql):
    result = db.execute(sql)
    return normal([c[0] for c in result.description], result.fetchall())


def duck_types(db, sql):
    described = db.execute(f"DESCRIBE {sql}").fetchall()
    return {r[0]: r[1] for r in described}


SPARK_TO_DUCK = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}
