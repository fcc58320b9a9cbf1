"""Gold aggregates of the sales fact.

Facts are reduced to partial sums per foreign key before any master is joined, so the
join sees one row per key and period instead of every sale, and a store or product that
makes up much of the data is combined before the shuffle.  Partial sums can be rolled up
further: one pass over the facts serves several gold tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallymill.functions.columns import money

_PARTS = ("revenue", "quantity", "transactions", "price_sum", "price_count")


def _day() -> Column:
    return F.to_date("transaction_timestamp").alias("sales_date")


def _year_and_month() -> list[Column]:
    return [F.year("transaction_timestamp").alias("year"), F.month("transaction_timestamp").alias("month")]


def _revenue() -> Column:
    return F.round(F.sum("revenue"), 2).cast("double").alias("total_revenue")


def _quantity() -> Column:
    return F.sum("quantity").alias("total_quantity")


def _transactions() -> Column:
    return F.sum("transactions").alias("total_transactions")


def _mean_price() -> Column:
    mean = F.try_divide(F.sum("price_sum"), F.sum("price_count"))
    return F.round(mean, 2).cast("double").alias("avg_unit_price")


def _totals() -> list[Column]:
    return [_revenue(), _quantity(), _transactions()]


def partial_sums(sales: DataFrame, *keys: Column | str) -> DataFrame:
    """Sums per key that add up to the sums of any coarser key."""
    return sales.groupBy(*keys).agg(
        F.sum(money("total_amount")).alias("revenue"),
        F.sum("quantity").alias("quantity"),
        F.count("transaction_id").alias("transactions"),
        F.sum(money("unit_price")).alias("price_sum"),
        F.count("unit_price").alias("price_count"),
    )


def by_store_and_day(sales: DataFrame) -> DataFrame:
    return partial_sums(sales, _day(), "store_id")


def by_product(sales: DataFrame) -> DataFrame:
    return partial_sums(sales, "product_id")


def _months(parts: DataFrame) -> DataFrame:
    return parts.withColumns({"year": F.year("sales_date"), "month": F.month("sales_date")})


# Roll-ups of partial sums -----------------------------------------------------------

def daily(store_days: DataFrame) -> DataFrame:
    return store_days.groupBy("sales_date").agg(*_totals())


def monthly(store_days: DataFrame) -> DataFrame:
    return _months(store_days).groupBy("year", "month").agg(*_totals())


def monthly_region(store_days: DataFrame, stores: DataFrame) -> DataFrame:
    store_months = _combine(_months(store_days), "year", "month", "store_id")
    return (
        store_months.join(stores, "store_id", "left")
        .groupBy("year", "month", "region", "country").agg(_revenue(), _quantity())
    )


def store_performance(store_days: DataFrame, stores: DataFrame) -> DataFrame:
    return (
        _combine(store_days, "store_id").join(stores, "store_id", "left")
        .groupBy("store_id", "store_name", "region", "country").agg(*_totals())
    )


def product_performance(product_sums: DataFrame, products: DataFrame) -> DataFrame:
    return (
        product_sums.join(products, "product_id", "left")
        .groupBy("product_id", "product_name", "category", "brand").agg(_quantity(), _revenue(), _mean_price())
    )


def category_performance(product_sums: DataFrame, products: DataFrame) -> DataFrame:
    return (
        product_sums.join(products, "product_id", "left")
        .groupBy("category").agg(*_totals())
    )


def _combine(parts: DataFrame, *keys: str) -> DataFrame:
    return parts.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in _PARTS])


# The gold tables straight from the facts --------------------------------------------

def gold_daily(sales: DataFrame) -> DataFrame:
    return daily(partial_sums(sales, _day()))


def gold_monthly(sales: DataFrame) -> DataFrame:
    return partial_sums(sales, *_year_and_month()).groupBy("year", "month").agg(*_totals())


def gold_monthly_region(sales: DataFrame, stores: DataFrame) -> DataFrame:
    return (
        partial_sums(sales, *_year_and_month(), "store_id").join(stores, "store_id", "left")
        .groupBy("year", "month", "region", "country").agg(_revenue(), _quantity())
    )


def gold_product(sales: DataFrame, products: DataFrame) -> DataFrame:
    return product_performance(by_product(sales), products)


def gold_category(sales: DataFrame, products: DataFrame) -> DataFrame:
    return category_performance(by_product(sales), products)


def gold_store(sales: DataFrame, stores: DataFrame) -> DataFrame:
    return store_performance(partial_sums(sales, "store_id"), stores)


# Dashboard measures -----------------------------------------------------------------

def _profit(parts: DataFrame, products: DataFrame) -> DataFrame:
    """Partial sums per product with cost at the product's standard price."""
    priced = parts.join(products, "product_id", "left")
    return priced.withColumn("cost", money(F.col("quantity") * F.col("standard_price").cast("double")))


def kpi_cards(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Total sales, profit, quantity and transactions."""
    profit = F.round(F.sum(F.col("revenue") - F.col("cost")), 2).cast("double").alias("total_profit")
    return _profit(by_product(sales), products).agg(_revenue(), profit, _quantity(), _transactions())


def product_profit(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Profit and margin per product; the margin of zero sales is null."""
    sums = (
        _profit(by_product(sales), products).groupBy("product_id", "product_name")
        .agg(F.sum("revenue").alias("revenue"), F.sum(F.col("revenue") - F.col("cost")).alias("profit"))
    )
    return sums.select(
        "product_id", "product_name",
        F.round("revenue", 2).cast("double").alias("total_revenue"),
        F.round("profit", 2).cast("double").alias("total_profit"),
        F.try_divide(F.col("profit").cast("double"), F.col("revenue").cast("double")).alias("margin"),
    )


def product_demand(sales: DataFrame) -> DataFrame:
    """Quantity sold per product and day."""
    return sales.groupBy("product_id", _day()).agg(F.sum("quantity").alias("total_quantity"))


def region_rollup(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Revenue per region and country with subtotals; ``level`` 0 detail, 1 region, 3 all."""
    return (
        partial_sums(sales, "store_id").join(stores, "store_id", "left")
        .rollup("region", "country").agg(F.grouping_id().alias("level"), *_totals())
    )


def top_products(sales: DataFrame, k: int) -> DataFrame:
    """Products holding one of the ``k`` highest revenues, densely ranked.

    Only the ``k`` best distinct revenues are ordered in one place; products are then
    matched to them, so any number of ties is returned.
    """
    revenue = by_product(sales).select("product_id", F.round("revenue", 2).alias("total_revenue"))
    best = (
        revenue.select("total_revenue").where(F.col("total_revenue").isNotNull()).distinct()
        .orderBy(F.col("total_revenue").desc()).limit(k)
        .agg(F.sort_array(F.collect_list("total_revenue"), asc=False).alias("best"))
        .select(F.posexplode("best").alias("place", "total_revenue"))
    )
    ranked = revenue.join(F.broadcast(best), "total_revenue")
    return ranked.select(
        "product_id", F.col("total_revenue").cast("double").alias("total_revenue"),
        (F.col("place") + 1).alias("revenue_rank"),
    )
