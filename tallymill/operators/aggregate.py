"""Grouped and global aggregates.

All aggregate functions used combine before the shuffle, so a frequent key costs one row
per task.  Amounts are summed as decimals: results do not depend on row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallymill.functions.columns import money, whole_week


def sum_by_key(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Sum per key; rows without a key are left out."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key).agg(F.sum(money(value)).cast("double").alias(name))
    )


def mean_of(df: DataFrame, value: str, name: str) -> DataFrame:
    return df.agg(steady_mean(value).alias(name))


def steady_mean(value: Column | str) -> Column:
    """Mean from a sum that does not depend on row order; null for no values."""
    return F.try_divide(F.sum(money(value)).cast("double"), F.count(value))


def null_counts(df: DataFrame) -> DataFrame:
    """Number of nulls per column, one row per column, in a single aggregation."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def weekly_rollup(df: DataFrame, timestamp: str, total: str, averages: Sequence[tuple[str, str]]) -> DataFrame:
    """Trips, revenue and means per week starting on Monday."""
    return df.groupBy(whole_week(timestamp).alias("week_start")).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum(money(total)).cast("double").alias("total_revenue"),
        *[steady_mean(column).alias(name) for column, name in averages],
    )


def top_rows(df: DataFrame, by: str, tie_break: Sequence[str], k: int, ascending: bool = False) -> DataFrame:
    """The ``k`` extreme rows.  Each task keeps its best ``k``; no full sort is made."""
    first = F.col(by).asc_nulls_last() if ascending else F.col(by).desc_nulls_last()
    return df.orderBy(first, *tie_break).limit(k)


def reject_ratio(log: DataFrame) -> DataFrame:
    """Records processed and rejected per pipeline, and the share rejected."""
    sums = log.groupBy("pipeline_name").agg(
        F.sum("records_processed").alias("total_processed"),
        F.sum("records_rejected").alias("total_rejected"),
    )
    everything = F.col("total_processed") + F.col("total_rejected")
    return sums.withColumn("reject_ratio", F.try_divide(F.col("total_rejected").cast("double"), everything))
