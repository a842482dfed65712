"""Run a query on Spark and its SQL on DuckDB and compare all values."""

import math
import os

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
DATA = os.environ.get("TEST_DATA", "/root/testdata")


def database(folder):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}") + 0.0
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda place: names[place])
    keyed = [tuple(_value(row[place]) for place in order) for row in rows]
    return sorted(keyed, key=lambda row: tuple((value is None, str(value)) for value in row))


def difference(frame, connection, sql):
    """None if equal, else a short account of what differs."""
    result = connection.execute(sql)
    sql_names = [column[0] for column in result.description]
    sql_rows = result.fetchall()
    rows = frame.collect()
    if sorted(frame.columns) != sorted(sql_names):
        return f"columns {sorted(frame.columns)} / {sorted(sql_names)}"
    if len(rows) != len(sql_rows):
        return f"{len(rows)} rows / {len(sql_rows)}"
    ours, theirs = _rows(frame.columns, rows), _rows(sql_names, sql_rows)
    wrong = [(a, b) for a, b in zip(ours, theirs) if [type(v) for v in a] != [type(v) for v in b] or a != b]
    return f"{len(wrong)} of {len(rows)} rows, first {wrong[0]}" if wrong else None
