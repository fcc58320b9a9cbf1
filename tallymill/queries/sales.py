"""Dedup, validation, joins, gold aggregates and dashboard measures on the retail view."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.operators import dedup, gold, joins, timeintel, validate
from tallymill.operators.clean import calibrate
from tallymill.operators.incremental import since_high_water_mark
from tallymill.queries.registry import (
    CALIBRATED, LATEST, PRODUCTS, QUANTITY, REVENUE, SALES, STORES, TOTAL, TRANSACTIONS, query,
)
from tallymill.plans.medallion import RetailLakehouse
from tallymill.schemas import BRONZE_SALES, PRODUCTS as PRODUCTS_FILE, STORES as STORES_FILE
from tallymill.session import scratch_path
from tallymill.sinks import writers
from tallymill.sources import star

# The masters of the validation queries lack some keys, so that sales get rejected.
_KNOWN = f"""{PRODUCTS}, known_products AS (SELECT * FROM products WHERE size <= 40),
{STORES}, known_stores AS (SELECT * FROM stores WHERE balance > 0)"""


def _known_products(spark, sf_dir):
    return star.products(spark, sf_dir).where("size <= 40")


def _known_stores(spark, sf_dir):
    return star.stores(spark, sf_dir).where("balance > 0")


def _latest(spark, sf_dir):
    return dedup.latest_per_key(star.sales(spark, sf_dir), star.SALE_KEYS, ["transaction_timestamp"])


def _flagged(spark, sf_dir):
    masters = {"product_id": _known_products(spark, sf_dir), "store_id": _known_stores(spark, sf_dir)}
    return validate.flag_rows(_latest(spark, sf_dir), masters, {"quantity_not_positive": F.col("quantity") > 0})


def _sales(spark, sf_dir):
    return calibrate(star.sales(spark, sf_dir))


@query(f"WITH {LATEST} SELECT * FROM latest")
def latest_per_key(spark, sf_dir):
    return _latest(spark, sf_dir)


@query(f"""WITH {PRODUCTS} SELECT brand, product_id, product_name, category, size, standard_price FROM (
  SELECT *, row_number() OVER (PARTITION BY brand ORDER BY product_id DESC NULLS LAST) AS rn
  FROM products WHERE brand IS NOT NULL) WHERE rn = 1""")
def master_rows(spark, sf_dir):
    return dedup.master_rows(star.products(spark, sf_dir), "brand")


_VALID = "EXISTS (SELECT 1 FROM known_products p WHERE p.product_id = l.product_id)" \
         " AND EXISTS (SELECT 1 FROM known_stores s WHERE s.store_id = l.store_id) AND coalesce(quantity > 0, false)"


@query(f"WITH {LATEST}, {_KNOWN} SELECT * FROM latest l WHERE {_VALID}")
def fk_valid(spark, sf_dir):
    """Foreign keys by semi joins."""
    known = joins.with_known_key(_latest(spark, sf_dir), _known_products(spark, sf_dir), "product_id")
    return joins.with_known_key(known, _known_stores(spark, sf_dir), "store_id").where("quantity > 0")


@query(f"WITH {LATEST}, {_KNOWN} SELECT * FROM latest l WHERE NOT ({_VALID})")
def fk_rejected(spark, sf_dir):
    """The complement from the one-pass split."""
    return validate.rejected_rows(_flagged(spark, sf_dir)).drop(validate.REASONS)


@query(f"""WITH {LATEST}, {_KNOWN} SELECT * FROM latest l
WHERE NOT EXISTS (SELECT 1 FROM known_products p WHERE p.product_id = l.product_id)""")
def fk_rejected_by_anti_join(spark, sf_dir):
    return joins.without_keys_of(_latest(spark, sf_dir), _known_products(spark, sf_dir), ["product_id"])


@query(f"""WITH {LATEST}, {_KNOWN}, marked AS (SELECT {_VALID} AS ok FROM latest l)
SELECT count(*) AS checked, count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS rejected
FROM marked""")
def split_counts(spark, sf_dir):
    return validate.split_counts(_flagged(spark, sf_dir))


@query(f"""WITH {LATEST}, {_KNOWN}
SELECT 'unknown_product_id' AS reason, count(*) AS rejected FROM latest l
WHERE NOT EXISTS (SELECT 1 FROM known_products p WHERE p.product_id = l.product_id) HAVING count(*) > 0
UNION ALL
SELECT 'unknown_store_id', count(*) FROM latest l
WHERE NOT EXISTS (SELECT 1 FROM known_stores s WHERE s.store_id = l.store_id) HAVING count(*) > 0""")
def reject_reasons(spark, sf_dir):
    return validate.reason_counts(_flagged(spark, sf_dir))


@query(f"""WITH {LATEST}, {_KNOWN}, silver AS (SELECT *, {TOTAL} AS total_amount FROM latest l WHERE {_VALID})
SELECT CAST(year(transaction_timestamp) AS INTEGER) AS year, CAST(month(transaction_timestamp) AS INTEGER) AS month,
       region, country, {REVENUE}, {QUANTITY}
FROM silver LEFT JOIN stores USING (store_id) GROUP BY ALL""")
def medallion_monthly_region(spark, sf_dir):
    """Flagship: dedup, validate, calibrate, then revenue by month and region."""
    silver = calibrate(validate.valid_rows(_flagged(spark, sf_dir)))
    return gold.gold_monthly_region(silver, star.stores(spark, sf_dir))


# Stored keys are text, and so is their order among equal timestamps.
@query(f"""WITH {SALES}, latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id, line_no ORDER BY transaction_timestamp DESC,
      CAST(store_id AS VARCHAR) DESC, CAST(product_id AS VARCHAR) DESC, quantity DESC, unit_price DESC, discount DESC) AS rn
    FROM sales)
  WHERE rn = 1), {_KNOWN}, silver AS (SELECT *, {TOTAL} AS total_amount FROM latest l WHERE {_VALID})
SELECT CAST(year(transaction_timestamp) AS INTEGER) AS year, CAST(month(transaction_timestamp) AS INTEGER) AS month,
       region, country, {REVENUE}, {QUANTITY}
FROM silver LEFT JOIN known_stores USING (store_id) GROUP BY ALL""")
def lakehouse_monthly_region(spark, sf_dir):
    """The same through stored tables: bronze load, silver refresh with quarantine, gold build."""
    house = RetailLakehouse(spark, scratch_path(spark, "lakehouse"), period="month")
    house.create()
    for table, load in ((_known_products(spark, sf_dir), house.load_products), (_known_stores(spark, sf_dir), house.load_stores)):
        path = scratch_path(spark, "masters")
        writers.write_csv(table.select(*(PRODUCTS_FILE if load == house.load_products else STORES_FILE).names), path)
        load(path)
    sale_id = F.concat_ws("-", "transaction_id", "line_no")
    raw = star.sales(spark, sf_dir).withColumns({
        "transaction_id": sale_id, "transaction_timestamp": F.col("transaction_timestamp").cast("timestamp"),
        "store_id": F.col("store_id").cast("string"), "product_id": F.col("product_id").cast("string"),
        "total_amount": F.lit(None).cast("double"), "currency": F.lit("INR"),
        "ingestion_timestamp": F.current_timestamp(), "source_system": F.lit("star"), "source_file": F.lit("lineitem"),
    })
    house.write_bronze(raw.select(*BRONZE_SALES.names), "all")
    house.refresh_silver()
    house.build_gold()
    return house.gold("monthly_region_sales")


@query("""SELECT * FROM events
WHERE ts >= (SELECT max(ts) FROM events WHERE event_type = 'purchase') - INTERVAL 2 DAY""")
def incremental_window(spark, sf_dir):
    events = star.load(spark, sf_dir, "events")
    return since_high_water_mark(events, events.where("event_type = 'purchase'"), "ts")


@query("SELECT * FROM events")
def incremental_first_run(spark, sf_dir):
    events = star.load(spark, sf_dir, "events")
    nothing = spark.createDataFrame([], events.schema)
    return since_high_water_mark(events, nothing, "ts")


@query(f"""WITH {SALES}, {PRODUCTS}, {STORES}
SELECT transaction_id, line_no, product_name, category, store_name, region, country
FROM sales LEFT JOIN products USING (product_id) LEFT JOIN stores USING (store_id)""")
def star_join(spark, sf_dir):
    masters = {"product_id": star.products(spark, sf_dir), "store_id": star.stores(spark, sf_dir)}
    return joins.enrich(star.sales(spark, sf_dir), masters).select(
        "transaction_id", "line_no", "product_name", "category", "store_name", "region", "country"
    )


_YEAR = "CAST(year(transaction_timestamp) AS INTEGER) AS year"
_MONTH = "CAST(month(transaction_timestamp) AS INTEGER) AS month"


@query(f"""WITH {CALIBRATED} SELECT CAST(transaction_timestamp AS DATE) AS sales_date,
{REVENUE}, {QUANTITY}, {TRANSACTIONS} FROM calibrated GROUP BY 1""")
def gold_daily(spark, sf_dir):
    return gold.gold_daily(_sales(spark, sf_dir))


@query(f"WITH {CALIBRATED} SELECT {_YEAR}, {_MONTH}, {REVENUE}, {QUANTITY}, {TRANSACTIONS} FROM calibrated GROUP BY 1, 2")
def gold_monthly(spark, sf_dir):
    return gold.gold_monthly(_sales(spark, sf_dir))


@query(f"""WITH {CALIBRATED}, {STORES} SELECT {_YEAR}, {_MONTH}, region, country, {REVENUE}, {QUANTITY}
FROM calibrated LEFT JOIN stores USING (store_id) GROUP BY ALL""")
def gold_monthly_region(spark, sf_dir):
    return gold.gold_monthly_region(_sales(spark, sf_dir), star.stores(spark, sf_dir))


# The mean price is rounded half up in whole cents: round() on a double may differ by one.
@query(f"""WITH {CALIBRATED}, {PRODUCTS}, priced AS (
  SELECT product_id, product_name, category, brand, {QUANTITY}, {REVENUE},
         CAST(sum(CAST(round(unit_price * 100) AS HUGEINT)) AS HUGEINT) AS cents, CAST(count(unit_price) AS HUGEINT) AS n
  FROM calibrated LEFT JOIN products USING (product_id) GROUP BY product_id, product_name, category, brand)
SELECT product_id, product_name, category, brand, total_quantity, total_revenue,
       CAST((2 * cents + n) // (2 * n) AS DOUBLE) / 100 AS avg_unit_price FROM priced""")
def gold_product(spark, sf_dir):
    return gold.gold_product(_sales(spark, sf_dir), star.products(spark, sf_dir))


@query(f"""WITH {CALIBRATED}, {PRODUCTS} SELECT category, {REVENUE}, {QUANTITY}, {TRANSACTIONS}
FROM calibrated LEFT JOIN products USING (product_id) GROUP BY category""")
def gold_category(spark, sf_dir):
    return gold.gold_category(_sales(spark, sf_dir), star.products(spark, sf_dir))


@query(f"""WITH {CALIBRATED}, {STORES}
SELECT store_id, store_name, region, country, {REVENUE}, {QUANTITY}, {TRANSACTIONS}
FROM calibrated LEFT JOIN stores USING (store_id) GROUP BY ALL""")
def gold_store(spark, sf_dir):
    return gold.gold_store(_sales(spark, sf_dir), star.stores(spark, sf_dir))


@query(f"""WITH {CALIBRATED}, {STORES}
SELECT region, country, CAST(grouping(region, country) AS BIGINT) AS level, {REVENUE}, {QUANTITY}, {TRANSACTIONS}
FROM calibrated LEFT JOIN stores USING (store_id) GROUP BY ROLLUP (region, country)""")
def region_country_rollup(spark, sf_dir):
    return gold.region_rollup(_sales(spark, sf_dir), star.stores(spark, sf_dir))


_COST = "quantity * CAST(standard_price AS DECIMAL(38,4))"
_PROFIT = f"sum(CAST(total_amount AS DECIMAL(38,4))) - sum({_COST})"


@query(f"""WITH {CALIBRATED}, {PRODUCTS}
SELECT {REVENUE}, CAST(round({_PROFIT}, 2) AS DOUBLE) AS total_profit, {QUANTITY}, {TRANSACTIONS}
FROM calibrated LEFT JOIN products USING (product_id)""")
def kpi_cards(spark, sf_dir):
    return gold.kpi_cards(_sales(spark, sf_dir), star.products(spark, sf_dir))


@query(f"""WITH {CALIBRATED}, {PRODUCTS}
SELECT product_id, product_name, {REVENUE}, CAST(round({_PROFIT}, 2) AS DOUBLE) AS total_profit,
CAST({_PROFIT} AS DOUBLE) / nullif(CAST(sum(CAST(total_amount AS DECIMAL(38,4))) AS DOUBLE), 0) AS margin
FROM calibrated LEFT JOIN products USING (product_id) GROUP BY product_id, product_name""")
def product_profit(spark, sf_dir):
    return gold.product_profit(_sales(spark, sf_dir), star.products(spark, sf_dir))


@query(f"""WITH {SALES} SELECT product_id, CAST(transaction_timestamp AS DATE) AS sales_date, {QUANTITY}
FROM sales GROUP BY 1, 2""")
def product_demand(spark, sf_dir):
    return gold.product_demand(star.sales(spark, sf_dir))


@query(f"""WITH {CALIBRATED}, revenue AS (SELECT product_id, {REVENUE} FROM calibrated GROUP BY product_id)
SELECT product_id, total_revenue, CAST(revenue_rank AS INTEGER) AS revenue_rank FROM (
  SELECT *, dense_rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank FROM revenue WHERE total_revenue IS NOT NULL)
WHERE revenue_rank <= 10""")
def top_products(spark, sf_dir):
    return gold.top_products(_sales(spark, sf_dir), 10)


# Time intelligence on orders ---------------------------------------------------------

_SERIES = """WITH sums AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, sum(CAST(o_totalprice AS DECIMAL(38,4))) AS amount
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1),
months AS (
  SELECT CAST(unnest(generate_series((SELECT min(month_start) FROM sums), (SELECT max(month_start) FROM sums),
    INTERVAL 1 MONTH)) AS DATE) AS month_start),
series AS (
  SELECT month_start, CAST(year(month_start) AS INTEGER) AS year, CAST(month(month_start) AS INTEGER) AS month,
         coalesce(amount, 0) AS amount
  FROM months LEFT JOIN sums USING (month_start))"""


def _series(spark, sf_dir):
    return timeintel.monthly_series(star.load(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")


def _doubles(df, *columns):
    return df.withColumns({name: F.col(name).cast("double") for name in columns})


@query(f"""{_SERIES} SELECT year, month, CAST(amount AS DOUBLE) AS amount,
CAST(sum(amount) OVER (PARTITION BY year ORDER BY month) AS DOUBLE) AS ytd FROM series""")
def ytd(spark, sf_dir):
    return _doubles(timeintel.year_to_date(_series(spark, sf_dir)), "amount", "ytd").drop("month_start")


@query(f"""{_SERIES} SELECT year, month, CAST(amount AS DOUBLE) AS amount,
CAST(lag(amount) OVER (ORDER BY month_start) AS DOUBLE) AS previous_month,
CAST(amount - lag(amount) OVER (ORDER BY month_start) AS DOUBLE) AS change FROM series""")
def mom(spark, sf_dir):
    compared = timeintel.month_over_month(_series(spark, sf_dir))
    return _doubles(compared, "amount", "previous_month", "change").drop("month_start")


@query(f"""{_SERIES}, compared AS (
  SELECT year, month, CAST(amount AS DOUBLE) AS amount,
         CAST(lag(amount, 12) OVER (ORDER BY month_start) AS DOUBLE) AS last_year FROM series)
SELECT *, (amount - last_year) / nullif(last_year, 0) AS yoy_growth FROM compared""")
def yoy(spark, sf_dir):
    compared = timeintel.year_over_year(_series(spark, sf_dir))
    return _doubles(compared, "amount", "last_year").drop("month_start")


@query("""WITH sums AS (
  SELECT o_orderpriority AS country, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start,
         sum(CAST(o_totalprice AS DECIMAL(38,4))) AS amount
  FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2),
months AS (
  SELECT country, CAST(unnest(generate_series(min(month_start), max(month_start), INTERVAL 1 MONTH)) AS DATE) AS month_start
  FROM sums GROUP BY country),
series AS (
  SELECT country, month_start, coalesce(amount, 0) AS amount FROM months LEFT JOIN sums USING (country, month_start))
SELECT country, CAST(year(month_start) AS INTEGER) AS year, CAST(month(month_start) AS INTEGER) AS month,
       CAST(amount AS DOUBLE) AS amount,
       CAST(sum(amount) OVER (PARTITION BY country, year(month_start) ORDER BY month_start) AS DOUBLE) AS ytd,
       CAST(lag(amount, 12) OVER (PARTITION BY country ORDER BY month_start) AS DOUBLE) AS last_year
FROM series""")
def ytd_and_last_year_by_country(spark, sf_dir):
    series = timeintel.monthly_series(
        star.order_book(spark, sf_dir), "order_timestamp", "amount", ["country"]
    )
    compared = timeintel.with_prior(series, 12, "last_year", ["country"])
    return _doubles(timeintel.year_to_date(compared, ["country"]), "amount", "ytd", "last_year").drop("month_start")


@query(f"""{_SERIES}, target AS (
  SELECT CAST(year + 1 AS INTEGER) AS year, month, CAST(round(amount * 1.1, 2) AS DOUBLE) AS target FROM series)
SELECT coalesce(s.year, t.year) AS year, coalesce(s.month, t.month) AS month, CAST(amount AS DOUBLE) AS actual, target,
       CAST(amount AS DOUBLE) / nullif(target, 0) AS attainment
FROM series s FULL JOIN target t ON s.year = t.year AND s.month = t.month""")
def target_vs_actual(spark, sf_dir):
    """Target: a tenth more than the same month of the year before."""
    series = _series(spark, sf_dir)
    actual = series.select("year", "month", F.col("amount").cast("double").alias("actual"))
    target = series.select(
        (F.col("year") + 1).alias("year"), "month",
        F.round(F.col("amount") * F.lit("1.1").cast("decimal(2,1)"), 2).cast("double").alias("target"),
    )
    return timeintel.target_vs_actual(actual, target, ["year", "month"])


@query("""WITH days AS (
  SELECT CAST(unnest(generate_series((SELECT min(CAST(o_orderdate AS DATE)) FROM orders),
    (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY)) AS DATE) AS date),
sums AS (
  SELECT CAST(o_orderdate AS DATE) AS date, CAST(sum(CAST(o_totalprice AS DECIMAL(38,4))) AS DOUBLE) AS amount
  FROM orders GROUP BY 1)
SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
       CAST(date_trunc('week', date) AS DATE) AS week_start, coalesce(amount, 0) AS amount
FROM days LEFT JOIN sums USING (date)""")
def calendar_join(spark, sf_dir):
    return timeintel.sales_by_calendar(star.load(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")
