"""Taxi pipeline: bronze, clean silver, then suspicious rides, weekly sums and top fares."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tallymill.fixed_values import (
    TAXI_BRONZE, TAXI_CLEAN, TAXI_DATABASE, TAXI_SUSPICIOUS, TAXI_TOP, TAXI_WEEKLY, TOP_FARES,
)
from tallymill.operators.aggregate import top_rows, weekly_rollup
from tallymill.operators.clean import bad_distance, count_side_by_side, count_where, flag_suspicious, ride_metrics
from tallymill.schemas import TAXI_TRIPS
from tallymill.sinks.writers import overwrite_table, use_database
from tallymill.sources.readers import read_csv

AVERAGES = [("fare_amount", "avg_fare_amount"), ("trip_distance", "avg_trip_distance")]


def weekly(rides: DataFrame) -> DataFrame:
    return weekly_rollup(rides, "pickup_datetime", "total_amount", AVERAGES)


def top_fares(rides: DataFrame, k: int = TOP_FARES) -> DataFrame:
    """The ``k`` highest fares with their rank; equal fares are ordered by trip id."""
    # The window sees the k rows left by the limit.
    rank = F.row_number().over(Window.orderBy(F.col("fare_amount").desc_nulls_last(), "trip_id"))
    return top_rows(rides.select(*TAXI_TRIPS.names), "fare_amount", ["trip_id"], k).withColumn("rank", rank)


def run(spark: SparkSession, csv_dir: str, database: str = TAXI_DATABASE) -> None:
    use_database(spark, database)
    raw = read_csv(spark, csv_dir, TAXI_TRIPS)
    overwrite_table(raw.withColumn("ingest_time", F.current_timestamp()), TAXI_BRONZE)
    overwrite_table(ride_metrics(spark.table(TAXI_BRONZE)), TAXI_CLEAN)
    clean = spark.table(TAXI_CLEAN)
    overwrite_table(flag_suspicious(clean), TAXI_SUSPICIOUS)
    overwrite_table(weekly(clean), TAXI_WEEKLY)
    overwrite_table(top_fares(clean), TAXI_TOP)


def layer_counts(spark: SparkSession) -> DataFrame:
    return count_side_by_side(bronze_count=spark.table(TAXI_BRONZE), silver_clean_count=spark.table(TAXI_CLEAN))


def bad_trips(spark: SparkSession) -> DataFrame:
    """Rule check on the clean table: must be zero."""
    return count_where(spark.table(TAXI_CLEAN), bad_distance(), "bad_trips_in_silver")
