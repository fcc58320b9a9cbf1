"""Declared table schemas.  Declaring them avoids the extra scan of schema inference."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def table(columns: str, never_null: tuple[str, ...] = ()) -> T.StructType:
    """``"a long, b string"`` -> StructType, without a session; ``never_null`` names columns."""
    pairs = [item.split() for item in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], name not in never_null) for name, kind in pairs])


LAB_SALES = table(
    "transaction_id long, store_id long, store_name string, date string, product_id long, "
    "product_name string, quantity long, unit_price double, total double, customer_id long, promo_code string"
)

TAXI_TRIPS = table(
    "trip_id string, vendor_id string, pickup_datetime timestamp, dropoff_datetime timestamp, "
    "passenger_count int, trip_distance double, fare_amount double, total_amount double, payment_type string"
)

ORDERS = table(
    "order_id string, order_timestamp timestamp, customer_id string, country string, amount double, currency string, status string",
    never_null=("order_id", "order_timestamp", "customer_id", "country", "amount", "currency", "status"),
)

# Prices are double already in the raw layer: declared as int, a value such as
# ``1299.0`` would be read as NULL.
RAW_SALES = table(
    "transaction_id string, transaction_timestamp timestamp, store_id string, product_id string, "
    "quantity int, unit_price double, discount double, total_amount double, currency string"
)

_LOAD_METADATA = "ingestion_timestamp timestamp, source_system string, source_file string"

BRONZE_SALES = T.StructType(RAW_SALES.fields + table(_LOAD_METADATA).fields)

SILVER_SALES = table(
    "transaction_id string, transaction_timestamp timestamp, store_id string, product_id string, "
    "quantity int, unit_price double, discount double, total_amount double, currency string, " + _LOAD_METADATA,
    never_null=("transaction_id",),
)

PRODUCTS = table("product_id string, product_name string, category string, brand string, standard_price int")

STORES = table("store_id string, store_name string, region string, country string")

RUN_LOG = table(
    "pipeline_name string, layer string, start_time timestamp, end_time timestamp, status string, "
    "records_processed long, records_rejected long, error_message string"
)
