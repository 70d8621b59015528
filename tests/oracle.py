"""Row-by-row comparison of a query with its SQL twin."""

from __future__ import annotations

import duckdb

from pitwall.plans.adapters import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with the shared tables as views."""
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (1, repr(float(value)) if isinstance(value, float) else repr(float(value)))
    return (1, str(value))


def rows_of(columns, rows):
    """Rows with columns in name order, as a sorted list of comparable tuples."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_key(row[i]) for i in order) for row in rows)


def compare(spark, connection, folder, function, sql) -> str | None:
    """Null if both sides agree, else a description of the difference."""
    frame = function(spark, folder)
    ours = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    relation = connection.sql(sql)
    theirs = rows_of(relation.columns, relation.fetchall())
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} != {sorted(relation.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"first difference\n  spark {a}\n  sql   {b}"
    if not ours:
        return "both sides are empty"
    return None
