"""Calendar dimension and comparisons over time: year to date, month before, last year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallymill.functions.columns import first_of_month, growth, money, whole_week


def calendar(df: DataFrame, timestamp: str) -> DataFrame:
    """One row per day from the first to the last date of a table."""
    day = F.col(timestamp).cast("date")
    bounds = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return _with_date_parts(bounds.select(_each("first", "last", "DAY").alias("date")))


def _each(first: str, last: str, step: str) -> Column:
    return F.explode(F.sequence(first, last, F.expr(f"INTERVAL 1 {step}")))


def _with_date_parts(days: DataFrame) -> DataFrame:
    return days.withColumns(
        {"year": F.year("date"), "month": F.month("date"), "week_start": whole_week("date")}
    )


def _dense(sums: DataFrame, period: str, step: str, keys: Sequence[str]) -> DataFrame:
    """Fill the gaps of periodic sums with zero, from the first to the last period per key.

    ``sums`` has one row per key and period.  A calendar is generated for each key and joined with the sums by key and
    period, so a key with a stray far date costs its own periods and no more.
    """
    # These conditions are always true.  The join puts the first on its other side, and the second keeps ``amount``: so both
    # sides' plans are equal, and Spark reads the same shuffle output twice instead of scanning the facts again.
    sums = sums.where(F.col(period).isNotNull())
    spans = sums.groupBy(*keys).agg(F.min(period).alias("_first"), F.max(period).alias("_last"), F.count("amount").alias("_n")).where("_n >= 0")
    days = spans.select(*[F.col(k).alias(f"_{k}") for k in keys], _each("_first", "_last", step).alias("_period"))
    same = F.col("_period") == F.col(period)
    for k in keys:
        same = same & F.col(f"_{k}").eqNullSafe(F.col(k))
    return days.join(sums, same, "left").select(
        *[F.col(f"_{k}").alias(k) for k in keys], F.col("_period").alias(period), F.coalesce("amount", F.lit(0)).alias("amount"))


def sales_by_calendar(df: DataFrame, timestamp: str, value: str) -> DataFrame:
    """Daily sum on the dense calendar: days without rows show zero."""
    per_day = (
        df.where(F.col(timestamp).isNotNull())
        .groupBy(F.col(timestamp).cast("date").alias("date")).agg(F.sum(money(value)).alias("amount"))
    )
    days = _dense(per_day, "date", "DAY", [])
    return _with_date_parts(days.withColumn("amount", F.col("amount").cast("double")))


def monthly_series(df: DataFrame, timestamp: str, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Dense monthly sums (decimal ``amount``) of each key, from its first to its last month."""
    sums = (
        df.where(F.col(timestamp).isNotNull())
        .groupBy(*keys, first_of_month(timestamp).alias("month_start"))
        .agg(F.sum(money(value)).alias("amount"))
    )
    months = _dense(sums, "month_start", "MONTH", keys)
    return months.withColumns({"year": F.year("month_start"), "month": F.month("month_start")})


def year_to_date(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Running total within the year.  A window group is at most twelve rows."""
    so_far = (
        Window.partitionBy(*keys, "year").orderBy("month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return series.withColumn("ytd", F.sum("amount").over(so_far))


def with_prior(series: DataFrame, months: int, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Add the amount of ``months`` months earlier.

    Every row is sent to its own month and, as the prior value, to the later one; one
    aggregation then puts both side by side.  No window over the whole series is needed.
    """
    own = F.struct(F.col("month_start"), F.col("amount"), F.lit(None).cast("decimal(38,4)").alias("prior"))
    later = F.struct(
        F.add_months("month_start", months).alias("month_start"),
        F.lit(None).cast(series.schema["amount"].dataType).alias("amount"),
        F.col("amount").cast("decimal(38,4)").alias("prior"),
    )
    return (
        series.select(*keys, F.explode(F.array(own, later)).alias("p")).select(*keys, "p.*")
        .groupBy(*keys, "month_start").agg(F.max("amount").alias("amount"), F.max("prior").alias(name))
        .where(F.col("amount").isNotNull())
        .withColumns({"year": F.year("month_start"), "month": F.month("month_start")})
    )


def month_over_month(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    compared = with_prior(series, 1, "previous_month", keys)
    return compared.withColumn("change", F.col("amount") - F.col("previous_month"))


def year_over_year(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    compared = with_prior(series, 12, "last_year", keys)
    return compared.withColumn(
        "yoy_growth", growth(F.col("amount").cast("double"), F.col("last_year").cast("double"))
    )


def target_vs_actual(actual: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full match of ``actual`` and ``target`` on the keys, with the share attained."""
    both = actual.join(target, list(keys), "full")
    return both.withColumn(
        "attainment", F.try_divide(F.col("actual").cast("double"), F.col("target").cast("double"))
    )
