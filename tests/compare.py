"""Side-by-side run of the registered queries and their SQL."""

from __future__ import annotations

import datetime as dt
import decimal
from pathlib import Path


def normalized(value):
    """One spelling for values that engines hand out in different types."""
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(normalized(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(table, key=repr)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return rows_of(columns, cursor.fetchall())


def connect(sf_dir):
    import duckdb

    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection
