"""Retail, taxi and run-log views of the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SALE_KEYS = ["transaction_id", "line_no"]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales fact: one row per delivered line; a sale is known by order and line number."""
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_shipdate").alias("transaction_timestamp"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("standard_price"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation, region = (load(spark, sf_dir, name) for name in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("country"),
            F.col("s_acctbal").alias("balance"),
        )
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxi view: a trip runs from the order date to the ship date of a line.

    Distances and fares are scaled so that every rule of the taxi pipeline is broken by some trips only.
    """
    lines = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("trip_id"),
        F.col("l_linenumber").alias("leg"),
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        (F.col("l_quantity") / 4 - 1).alias("trip_distance"),
        (F.col("l_extendedprice") / 2000).alias("fare_amount"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-log view of the events: a pipeline per user, an error event is a failed run."""
    failed = F.col("event_type") == "error"
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"),
        F.col("user_id").alias("pipeline_name"),
        F.col("event_type").alias("layer"),
        F.col("ts").alias("start_time"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(failed, F.lit(0)).otherwise(F.floor("value")).cast("long").alias("records_processed"),
        F.when(failed, F.ceil("value")).otherwise(F.lit(0)).cast("long").alias("records_rejected"),
    )


def order_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an order book; the priority class stands in for the country."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("order_timestamp"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("country"),
        F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderstatus") == "P", "PAID").when(F.col("o_orderstatus") == "F", "CANCELLED")
        .otherwise("CREATED").alias("status"),
        F.year("o_orderdate").alias("order_year"),
    )
