"""Life cycle of an orders table: partitioned write, changes, evolution, compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallymill.fixed_values import CANCELLED, DELETE_BELOW, LOW_VALUE, ORDER_PARTITIONS, PAID
from tallymill.operators.versioned import VersionedTable


def with_order_date(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_date", F.to_date("order_timestamp"))


def open_book(spark: SparkSession, root: str, partition_by: Sequence[str] = ORDER_PARTITIONS) -> VersionedTable:
    return VersionedTable(spark, root, partition_by)


def paid_in(country: str, below: float | None = None) -> Column:
    test = (F.col("country") == country) & (F.col("status") == PAID)
    return test if below is None else test & (F.col("amount") < below)


def cancel(book: VersionedTable, condition: Column) -> int:
    return book.update(condition, {"status": F.lit(CANCELLED)})


def life_cycle(book: VersionedTable, orders: DataFrame, later_orders: DataFrame, cancelled_country: str,
               cleaned_country: str, low_value: float = LOW_VALUE, cutoff: float = DELETE_BELOW, cluster_by: str = "customer_id") -> int:
    """Versions 0 to 5: create, cancel a country, append wider rows, cancel low values,
    delete the smallest amounts, compact."""
    book.create(with_order_date(orders))
    cancel(book, paid_in(cancelled_country))
    book.append(with_order_date(later_orders))
    cancel(book, paid_in(cleaned_country, low_value))
    book.delete(F.col("amount") < cutoff)
    return book.compact(cluster_by)
