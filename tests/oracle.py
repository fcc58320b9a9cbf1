"""Compare a query with its oracle in DuckDB over the same files."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


# Spark type name -> DuckDB type name.
TYPES = {
    "string": "VARCHAR", "long": "BIGINT", "integer": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark_df, connection, sql: str) -> None:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    kinds = {column[0]: str(column[1]) for column in cursor.description}
    for field in spark_df.schema.fields:
        assert TYPES[field.dataType.typeName()] == kinds.get(field.name), (field, kinds.get(field.name))
    want_rows = cursor.fetchall()
    got_rows = spark_df.collect()
    assert sorted(spark_df.columns) == sorted(names)
    order = sorted(names)
    got = _sorted([[_plain(row[name]) for name in order] for row in got_rows])
    at = [names.index(name) for name in order]
    want = _sorted([[_plain(row[i]) for i in at] for row in want_rows])
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    for mine, theirs in zip(got, want):
        assert mine == theirs, f"{order}\n{mine}\n{theirs}"


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(rows):
    return sorted(rows, key=lambda row: [(value is not None, str(type(value)), value if value is not None else 0) for value in row])
