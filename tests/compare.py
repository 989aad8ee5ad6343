"""Compare a Spark result with a DuckDB result: column names, row count, values regardless of order."""

import datetime
import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str:
    """Empty when equal, else what differs."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    expected = bag(result.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    actual = bag([tuple(row) for row in df.collect()], df.columns)
    if actual == expected:
        return ""
    extra, lacking = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows, expected {sum(expected.values())}; "
        f"extra {list(extra.items())[:3]}; lacking {list(lacking.items())[:3]}"
    )
