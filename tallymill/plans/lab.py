"""Mini ETL of the sales lab: CSV in, dates and nulls cleaned, JSON records out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.fixed_values import LAB_FILLS
from tallymill.operators.clean import fill_nulls
from tallymill.schemas import LAB_SALES
from tallymill.sinks.writers import write_json_records
from tallymill.sources.readers import read_csv


def clean_lab_sales(raw: DataFrame) -> DataFrame:
    dated = raw.withColumn("date", F.col("date").cast("timestamp_ntz"))
    return fill_nulls(dated, LAB_FILLS, {"customer_id": "bigint"})


def run(spark: SparkSession, csv_path: str, json_path: str) -> DataFrame:
    cleaned = clean_lab_sales(read_csv(spark, csv_path, LAB_SALES))
    write_json_records(cleaned, json_path)
    return cleaned
