"""Column expressions shared by the operators; all are built-in Spark functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_MICROS_PER_MINUTE = 60_000_000


def money(column: Column | str) -> Column:
    """Decimal form of an amount, so that sums do not depend on row order.

    Ten digits behind the point are kept, below 1e24.
    """
    return _col(column).cast("decimal(34,10)")


def net_total(quantity: Column | str, unit_price: Column | str, discount: Column | str) -> Column:
    """``quantity * unit_price - discount`` rounded half up to cents, once; null if any part is."""
    whole, price, less = (_col(part).cast("double") for part in (quantity, unit_price, discount))
    return F.round(whole * price - less, 2)


def whole_week(timestamp: Column | str) -> Column:
    """Monday of the week as a DATE, the same for zoned and zone-less timestamps."""
    return F.date_trunc("week", _col(timestamp)).cast("date")


def first_of_month(timestamp: Column | str) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(_col(timestamp).cast("date"), "month")


def first_of_year(timestamp: Column | str) -> Column:
    """First day of the year as a DATE."""
    return F.trunc(_col(timestamp).cast("date"), "year")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Signed duration in minutes, with sub-second precision."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(_MICROS_PER_MINUTE)


def ratio_if_positive(numerator: Column | str, denominator: Column | str) -> Column:
    """``numerator / denominator`` where the denominator is above zero, else null."""
    below = _col(denominator)
    return F.when(below > 0, _col(numerator) / below).otherwise(F.lit(None).cast("double"))


def growth(current: Column | str, before: Column | str) -> Column:
    """Relative change; null where there is nothing to compare with."""
    now, then = _col(current), _col(before)
    return F.try_divide(now - then, then)


def holds(condition: Column) -> Column:
    """Two-valued form of a condition: null counts as not met."""
    return F.coalesce(condition, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    met = F.lit(True)
    for condition in conditions:
        met = met & condition
    return met


def epoch_millis(timestamp: Column | str, zoned: bool = False) -> Column:
    """Milliseconds since 1970.  Dates and zone-less timestamps are taken as UTC."""
    if zoned:
        return F.unix_millis(_col(timestamp))
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", start, _col(timestamp).cast("timestamp_ntz"))


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
