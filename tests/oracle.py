"""Compare query results with DuckDB on the same Parquet files."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value


def _rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


FAMILIES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def compare(df, db, sql: str) -> str | None:
    """None if equal as multisets of rows, else a description of the difference."""
    found = df.collect()
    cursor = db.execute(sql)
    columns = [c[0] for c in cursor.description]
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    for name, kind in df.dtypes:
        if FAMILIES.get(kind, kind) != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    left, right = _rows(df.columns, found), _rows(columns, expected)
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (
        f"{sum(left.values())} vs {sum(right.values())} rows; {sum(only_left.values())} only in Spark, e.g. "
        f"{sorted(map(str, only_left))[:3]}; only in SQL, e.g. {sorted(map(str, only_right))[:3]}"
    )
