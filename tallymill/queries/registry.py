"""Named queries over the test tables, each with the SQL its result must equal."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tallymill.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its own name, together with its oracle."""
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        ORACLES[function.__name__] = sql
        return function
    return add


@contextmanager
def scratch_database(spark: SparkSession) -> Iterator[str]:
    """A database below the scratch folder, dropped with its tables at the end (see :func:`kept`)."""
    name, before = f"tallymill_{uuid.uuid4().hex[:12]}", spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'database')}'")
    try:
        yield name
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def kept(df: DataFrame) -> DataFrame:
    """Rows written to the scratch folder, so that they outlast the database they came from."""
    path = scratch_path(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Views the oracles build on, as SQL text ---------------------------------------------

SALES = """
sales AS (
  SELECT l_orderkey AS transaction_id, l_linenumber AS line_no, l_shipdate AS transaction_timestamp,
         l_suppkey AS store_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         l_extendedprice AS unit_price, l_discount AS discount, l_tax AS tax,
         l_returnflag AS return_flag, l_linestatus AS line_status
  FROM lineitem)"""

TOTAL = "round(quantity * unit_price - discount, 2)"

CALIBRATED = f"{SALES}, calibrated AS (SELECT *, {TOTAL} AS total_amount FROM sales)"

PRODUCTS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         p_size AS size, p_retailprice AS standard_price
  FROM part)"""

STORES = """
stores AS (
  SELECT s_suppkey AS store_id, s_name AS store_name, r_name AS region, n_name AS country, s_acctbal AS balance
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

LATEST_ORDER = ", ".join(
    f"{column} DESC NULLS LAST" for column in (
        "transaction_timestamp", "store_id", "product_id", "quantity", "unit_price", "discount", "tax",
        "return_flag", "line_status",
    )
)

LATEST = f"""{SALES}, latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id, line_no ORDER BY {LATEST_ORDER}) AS rn FROM sales)
  WHERE rn = 1)"""

TRIPS = """
trips AS (
  SELECT l_orderkey AS trip_id, l_linenumber AS leg, o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
         l_quantity / 4 - 1 AS trip_distance, l_extendedprice / 2000 AS fare_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

RUN_LOG = """
log AS (
  SELECT event_id AS run_id, user_id AS pipeline_name, event_type AS layer, ts AS start_time,
         CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
         CAST(CASE WHEN event_type = 'error' THEN 0 ELSE floor(value) END AS BIGINT) AS records_processed,
         CAST(CASE WHEN event_type = 'error' THEN ceil(value) ELSE 0 END AS BIGINT) AS records_rejected
  FROM events)"""

BOOK = """
book AS (
  SELECT o_orderkey AS order_id, o_orderdate AS order_timestamp, o_custkey AS customer_id,
         o_orderpriority AS country, o_totalprice AS amount,
         CASE o_orderstatus WHEN 'P' THEN 'PAID' WHEN 'F' THEN 'CANCELLED' ELSE 'CREATED' END AS status,
         CAST(year(o_orderdate) AS INTEGER) AS order_year
  FROM orders)"""

REVENUE = "CAST(round(sum(CAST(total_amount AS DECIMAL(38,4))), 2) AS DOUBLE) AS total_revenue"
QUANTITY = "CAST(sum(quantity) AS BIGINT) AS total_quantity"
TRANSACTIONS = "CAST(count(transaction_id) AS BIGINT) AS total_transactions"
