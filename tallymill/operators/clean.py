"""Row-wise cleaning: filters, null fills, types and derived columns.

Everything here is a narrow transformation: no shuffle, and filters and column choices
reach the file scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tallymill.fixed_values import HIGH_FARE, SHORT_TRIP_KM, SUSPICIOUS_FARE_PER_KM
from tallymill.functions.columns import minutes_between, net_total, ratio_if_positive

SILVER_TYPES = {"quantity": "int", "unit_price": "double", "discount": "double", "total_amount": "double"}


def above(df: DataFrame, column: str, bound: float) -> DataFrame:
    return df.where(F.col(column) > bound)


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def in_period(df: DataFrame, timestamp: str, first: str, last: str) -> DataFrame:
    """Rows of the days ``first`` to ``last``, both included.

    Written as a range on the bare column, so that it is pushed into the scan.
    """
    start = F.lit(first).cast("date")
    end = F.date_add(F.lit(last).cast("date"), 1)
    kind = df.schema[timestamp].dataType.typeName()
    return df.where((F.col(timestamp) >= start.cast(kind)) & (F.col(timestamp) < end.cast(kind)))


def slicer(df: DataFrame, **choices: Sequence[Any] | None) -> DataFrame:
    """Keep the chosen values of each named column; ``None`` leaves a column unfiltered."""
    for column, values in choices.items():
        if values is not None:
            df = df.where(F.col(column).isin(list(values)))
    return df


def fill_nulls(df: DataFrame, fills: Mapping[str, Any], types: Mapping[str, str] | None = None) -> DataFrame:
    """Replace nulls by constants, then cast the columns named in ``types``."""
    return cast_columns(df.fillna(dict(fills)), types or {})


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in types.items()}) if types else df


def align_to(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns of a target table, in its order."""
    return df.select(*columns)


def calibrate(df: DataFrame) -> DataFrame:
    """Recompute ``total_amount`` from its parts, whatever the source claimed."""
    return df.withColumn("total_amount", net_total("quantity", "unit_price", "discount"))


def normalise_sale_types(df: DataFrame) -> DataFrame:
    return cast_columns(df, SILVER_TYPES)


def bad_distance() -> Column:
    """The taxi quality rule, broken: a distance that is absent or not positive."""
    return F.col("trip_distance").isNull() | (F.col("trip_distance") <= 0)


def ride_metrics(trips: DataFrame) -> DataFrame:
    """Trips of a positive distance with duration (may be negative) and fare per km."""
    return trips.where(~bad_distance()).withColumns({
        "ride_duration_min": minutes_between("pickup_datetime", "dropoff_datetime"),
        "fare_per_km": ratio_if_positive("fare_amount", "trip_distance"),
    })


def flag_suspicious(rides: DataFrame) -> DataFrame:
    """Three-valued flags: a null input gives a null flag unless the other one is true."""
    dear = F.col("fare_per_km") > SUSPICIOUS_FARE_PER_KM
    short = (F.col("trip_distance") < SHORT_TRIP_KM) & (F.col("fare_amount") > HIGH_FARE)
    return rides.withColumns({
        "suspicious_fare_per_km": dear,
        "short_trip_high_fare": short,
        "is_suspicious_ride": dear | short,
    })


def count_where(df: DataFrame, condition: Column | str, name: str) -> DataFrame:
    test = F.expr(condition) if isinstance(condition, str) else condition
    return df.agg(F.count_if(test).alias(name))


def count_side_by_side(**tables: DataFrame) -> DataFrame:
    """One row with the row count of every named table, as scalar subqueries."""
    spark = next(iter(tables.values())).sparkSession
    counts = [df.agg(F.count(F.lit(1))).scalar().alias(name) for name, df in tables.items()]
    return spark.range(1).select(*counts)
