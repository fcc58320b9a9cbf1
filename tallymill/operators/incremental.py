"""Incremental selection by a high-water mark with a look-back for late rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallymill.fixed_values import LOOKBACK


def look_back_bound(target: DataFrame, timestamp: str, lookback: str = LOOKBACK) -> str | None:
    """The target's newest timestamp minus the look-back, as text; None where it has no timestamp yet."""
    bound = F.max(timestamp) - F.expr(f"INTERVAL {lookback}")
    return target.agg(bound.cast("string").alias("bound")).first()[0]


def not_before(df: DataFrame, bound: str | None, timestamp: str, period: str | None = None,
               period_of: Callable[[Column], Column] = F.to_date) -> DataFrame:
    """Rows not older than a bound; without one all rows, those without a timestamp too.

    The filter compares the bare column with one value, by which the scan skips files and row groups.
    ``period`` names a column holding ``period_of(timestamp)``, the date or the month; where ``df`` is
    partitioned by it, older partitions are not read.
    """
    if bound is None:
        return df
    least = F.lit(bound).cast(df.schema[timestamp].dataType)
    recent = df.where(F.col(timestamp) >= least)
    return recent if period is None else recent.where(F.col(period) >= period_of(least))


def since_high_water_mark(df: DataFrame, target: DataFrame, timestamp: str, lookback: str = LOOKBACK,
                          period: str | None = None, period_of: Callable[[Column], Column] = F.to_date) -> DataFrame:
    """Rows not older than the target's newest timestamp minus the look-back (see :func:`not_before`)."""
    return not_before(df, look_back_bound(target, timestamp, lookback), timestamp, period, period_of)
