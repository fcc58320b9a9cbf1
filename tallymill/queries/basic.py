"""Filters, cleaning, plain aggregates and round trips."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.functions.columns import first_of_month
from tallymill.operators import aggregate, clean, dedup, describe as stats, joins, ranking, timeintel
from tallymill.queries.registry import CALIBRATED, RUN_LOG, SALES, TOTAL, TRIPS, query
from tallymill.plans import runlog, taxi
from tallymill.session import scratch_path
from tallymill.sinks import writers
from tallymill.sources import readers, star


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 400000")
def high_value_rows(spark, sf_dir):
    return clean.above(star.load(spark, sf_dir, "orders"), "o_totalprice", 400_000).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("""SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1997-07-01'""")
def rows_in_period(spark, sf_dir):
    orders = star.load(spark, sf_dir, "orders")
    return clean.in_period(orders, "o_orderdate", "1997-03-01", "1997-06-30").select(
        "o_orderkey", "o_orderdate", "o_totalprice"
    )


@query("""SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority = '1-URGENT'""")
def sliced_rows(spark, sf_dir):
    orders = star.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return clean.slicer(orders, o_orderstatus=["F", "P"], o_orderpriority=["1-URGENT"], o_orderkey=None)


@query("""SELECT (SELECT count(*) FROM orders) AS order_rows, (SELECT count(*) FROM lineitem) AS line_rows,
(SELECT count(*) FROM orders WHERE o_totalprice <= 2000 OR o_totalprice IS NULL) AS bad_rows""")
def bad_row_counts(spark, sf_dir):
    orders, lines = star.load(spark, sf_dir, "orders"), star.load(spark, sf_dir, "lineitem")
    bad = clean.count_where(orders, "o_totalprice <= 2000 OR o_totalprice IS NULL", "bad_rows")
    return clean.count_side_by_side(order_rows=orders, line_rows=lines).withColumn("bad_rows", bad.scalar())


@query("SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf_dir):
    return writers.row_count(star.load(spark, sf_dir, "lineitem"))


def _describe_sql(*measures: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{m}' AS measure, count({m}) AS "count", round(avg({m}), 6) AS mean,
round(stddev_samp({m}), 6) AS std, min({m}) AS "min", round(quantile_cont({m}, 0.25), 6) AS p25,
round(quantile_cont({m}, 0.5), 6) AS p50, round(quantile_cont({m}, 0.75), 6) AS p75, max({m}) AS "max"
FROM lineitem""" for m in measures
    )


@query(_describe_sql("l_quantity", "l_extendedprice", "l_discount"))
def describe_measures(spark, sf_dir):
    result = stats.describe(star.load(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return result.withColumns({name: F.round(name, 6) for name in ("mean", "std", "p25", "p50", "p75")})


_JOINED = """WITH joined AS (
  SELECT o_orderkey, o_custkey, c_custkey, c_name, c_mktsegment
  FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey)"""


def _orders_with_solvent_customers(spark, sf_dir):
    orders = star.load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    solvent = clean.above(star.load(spark, sf_dir, "customer"), "c_acctbal", 0).select(
        "c_custkey", "c_name", "c_mktsegment"
    )
    return orders.join(solvent, F.col("o_custkey") == F.col("c_custkey"), "left")


@query(_JOINED + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM joined"
    for c in ("o_orderkey", "o_custkey", "c_custkey", "c_name", "c_mktsegment")
))
def null_counts(spark, sf_dir):
    return aggregate.null_counts(_orders_with_solvent_customers(spark, sf_dir))


@query(_JOINED + """ SELECT o_orderkey, o_custkey, CAST(coalesce(c_custkey, 0) AS BIGINT) AS c_custkey,
coalesce(c_name, 'NO NAME') AS c_name, c_mktsegment FROM joined""")
def fill_nulls(spark, sf_dir):
    joined = _orders_with_solvent_customers(spark, sf_dir)
    return clean.fill_nulls(joined, {"c_custkey": 0, "c_name": "NO NAME"}, {"c_custkey": "bigint"})


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_values(spark, sf_dir):
    return dedup.distinct_values(star.load(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


@query("SELECT l_returnflag, l_linestatus FROM lineitem ORDER BY 1, 2 LIMIT 1")
def first_distinct(spark, sf_dir):
    return dedup.first_distinct(star.load(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus")


@query("SELECT DISTINCT * FROM lineitem")
def exact_dedup(spark, sf_dir):
    """Whole rows: the table with a third of itself added once more."""
    lines = star.load(spark, sf_dir, "lineitem")
    return dedup.exact_dedup(lines.unionByName(lines.where("l_orderkey % 3 = 0")))


@query("""SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(38,4))) AS DOUBLE) AS revenue
FROM lineitem WHERE l_suppkey IS NOT NULL GROUP BY l_suppkey""")
def sum_by_key(spark, sf_dir):
    return aggregate.sum_by_key(star.load(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice", "revenue")


@query("""SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(38,4))) AS DOUBLE) AS revenue
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority ORDER BY o_orderpriority""")
def sums_in_key_order(spark, sf_dir):
    """Grouped sums as they are shown, in the order of their keys."""
    sums = aggregate.sum_by_key(star.load(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", "revenue")
    return ranking.in_key_order(sums, "o_orderpriority")


@query("""SELECT CAST(sum(CAST(l_quantity AS DECIMAL(38,4))) AS DOUBLE) / count(l_quantity) AS avg_quantity
FROM lineitem""")
def avg_basket(spark, sf_dir):
    return aggregate.mean_of(star.load(spark, sf_dir, "lineitem"), "l_quantity", "avg_quantity")


@query(f"WITH {CALIBRATED} SELECT * FROM calibrated")
def calibrated_total(spark, sf_dir):
    return clean.calibrate(star.sales(spark, sf_dir))


@query(f"""WITH {SALES} SELECT transaction_id, quantity, unit_price, discount, {TOTAL} AS total_amount FROM sales""")
def normalised_types(spark, sf_dir):
    """Types and columns of a target table, from rows whose numbers arrive as text."""
    text = clean.calibrate(star.sales(spark, sf_dir)).withColumns({
        name: F.col(name).cast("string") for name in ("quantity", "unit_price", "discount")
    })
    return clean.align_to(
        clean.normalise_sale_types(text), ["transaction_id", "quantity", "unit_price", "discount", "total_amount"]
    )


_RIDES = f"""WITH {TRIPS}, rides AS (
  SELECT *, date_diff('microsecond', pickup_datetime, dropoff_datetime) / 60000000 AS ride_duration_min,
         fare_amount / trip_distance AS fare_per_km
  FROM trips WHERE trip_distance > 0)"""


@query(f"{_RIDES} SELECT * FROM rides")
def ride_metrics(spark, sf_dir):
    return clean.ride_metrics(star.trips(spark, sf_dir))


@query(f"""{_RIDES} SELECT trip_id, leg, fare_per_km > 10 AS suspicious_fare_per_km,
trip_distance < 1 AND fare_amount > 25 AS short_trip_high_fare,
fare_per_km > 10 OR (trip_distance < 1 AND fare_amount > 25) AS is_suspicious_ride FROM rides""")
def suspicious_rides(spark, sf_dir):
    flags = ["suspicious_fare_per_km", "short_trip_high_fare", "is_suspicious_ride"]
    return clean.flag_suspicious(clean.ride_metrics(star.trips(spark, sf_dir))).select("trip_id", "leg", *flags)


@query(f"{_RIDES} SELECT trip_id, leg, fare_per_km FROM rides WHERE fare_per_km > 10 OR (trip_distance < 1 AND fare_amount > 25)")
def suspicious_only(spark, sf_dir):
    flagged = clean.flag_suspicious(clean.ride_metrics(star.trips(spark, sf_dir)))
    return flagged.where("is_suspicious_ride").select("trip_id", "leg", "fare_per_km")


@query(f"""{_RIDES} SELECT CAST(date_trunc('week', pickup_datetime) AS DATE) AS week_start, count(*) AS total_trips,
CAST(sum(CAST(fare_amount AS DECIMAL(38,10))) AS DOUBLE) AS total_revenue,
CAST(sum(CAST(fare_amount AS DECIMAL(38,10))) AS DOUBLE) / count(fare_amount) AS avg_fare_amount,
CAST(sum(CAST(trip_distance AS DECIMAL(38,10))) AS DOUBLE) / count(trip_distance) AS avg_trip_distance
FROM rides GROUP BY 1""")
def weekly_rides(spark, sf_dir):
    rides = clean.ride_metrics(star.trips(spark, sf_dir))
    return aggregate.weekly_rollup(rides, "pickup_datetime", "fare_amount", taxi.AVERAGES)


@query("""SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, count(*) AS total_trips,
CAST(sum(CAST(value AS DECIMAL(38,4))) AS DOUBLE) AS total_revenue,
CAST(sum(CAST(value AS DECIMAL(38,4))) AS DOUBLE) / count(value) AS avg_fare_amount,
CAST(sum(CAST(user_id AS DECIMAL(38,4))) AS DOUBLE) / count(user_id) AS avg_trip_distance
FROM events GROUP BY 1""")
def weekly_rollup(spark, sf_dir):
    return aggregate.weekly_rollup(
        star.load(spark, sf_dir, "events"), "ts", "value",
        [("value", "avg_fare_amount"), ("user_id", "avg_trip_distance")],
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 3")
def top3(spark, sf_dir):
    return aggregate.top_rows(
        star.load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], 3
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice ASC NULLS LAST, o_orderkey LIMIT 20")
def bottom20(spark, sf_dir):
    return aggregate.top_rows(
        star.load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], 20,
        ascending=True,
    )


@query("SELECT count(*) AS row_count FROM (SELECT * FROM orders LIMIT 20)")
def limited_rows(spark, sf_dir):
    """Any twenty rows: only their number is defined."""
    return writers.row_count(writers.preview(star.load(spark, sf_dir, "orders"), 20))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey")
def sorted_rows(spark, sf_dir):
    return star.load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")


@query("""SELECT o_orderkey, o_orderpriority, o_totalprice,
row_number() OVER (ORDER BY o_orderpriority NULLS FIRST, o_totalprice NULLS FIRST, o_orderkey NULLS FIRST) AS row_number,
rank() OVER (ORDER BY o_orderpriority NULLS FIRST) AS rank FROM orders""")
def ranked_rows(spark, sf_dir):
    """All orders numbered by priority and price, and ranked by priority, of which there are five."""
    orders = star.load(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ranking.with_ranks(orders, ["o_orderpriority"], ["o_orderpriority", "o_totalprice", "o_orderkey"])


@query("""SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
CAST(date_trunc('week', date) AS DATE) AS week_start
FROM (SELECT CAST(unnest(generate_series(
  (SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders),
  INTERVAL 1 DAY)) AS DATE) AS date)""")
def calendar(spark, sf_dir):
    return timeintel.calendar(star.load(spark, sf_dir, "orders"), "o_orderdate")


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS year,
CAST(month(o_orderdate) AS INTEGER) AS month, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start FROM orders""")
def calendar_star_join(spark, sf_dir):
    """Facts with the columns of their calendar day."""
    orders = star.load(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return joins.enrich(orders, {"date": timeintel.calendar(orders, "date")})


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders""")
def date_parts(spark, sf_dir):
    return star.load(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("order_date"),
        first_of_month("o_orderdate").alias("month_start"),
    )


@query(f"WITH {RUN_LOG} SELECT * FROM log WHERE layer = 'purchase' ORDER BY start_time DESC, run_id")
def run_log_of_layer(spark, sf_dir):
    return runlog.newest_first(runlog.of_layer(star.run_log(spark, sf_dir), "purchase"), "run_id")


@query(f"WITH {RUN_LOG} SELECT * FROM log WHERE status = 'FAILED' ORDER BY start_time DESC, run_id")
def run_log_failed(spark, sf_dir):
    return runlog.newest_first(runlog.failed_runs(star.run_log(spark, sf_dir)), "run_id")


@query(f"WITH {RUN_LOG} SELECT * FROM log ORDER BY start_time DESC, run_id LIMIT 1")
def run_log_latest(spark, sf_dir):
    return runlog.latest_run(star.run_log(spark, sf_dir), "run_id")


@query(f"""WITH {RUN_LOG} SELECT *, CAST(total_rejected AS DOUBLE) / nullif(total_processed + total_rejected, 0)
AS reject_ratio FROM (
  SELECT pipeline_name, CAST(sum(records_processed) AS BIGINT) AS total_processed,
         CAST(sum(records_rejected) AS BIGINT) AS total_rejected FROM log GROUP BY pipeline_name)""")
def reject_ratio(spark, sf_dir):
    return aggregate.reject_ratio(star.run_log(spark, sf_dir))


@query("""SELECT o_orderkey, epoch_ms(o_orderdate) AS o_orderdate, o_totalprice,
CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS promo FROM orders""")
def json_records(spark, sf_dir):
    orders = star.load(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_totalprice",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("promo"),
    )
    path = scratch_path(spark, "json")
    writers.write_json_records(orders, path)
    schema = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderdate", T.LongType()),
        T.StructField("o_totalprice", T.DoubleType()), T.StructField("promo", T.StringType()),
    ])
    return spark.read.schema(schema).json(path)


@query("SELECT * FROM orders")
def csv_round_trip(spark, sf_dir):
    orders = star.load(spark, sf_dir, "orders")
    path = scratch_path(spark, "csv")
    writers.write_csv(orders, path)
    return readers.read_csv(spark, path, orders.schema)


@query("""SELECT o_orderkey, 'star_schema' AS source_system, 'orders.parquet' AS source_file,
true AS has_load_time FROM orders""")
def load_metadata(spark, sf_dir):
    loaded = readers.with_load_metadata(star.load(spark, sf_dir, "orders"), "star_schema")
    return loaded.select(
        "o_orderkey", "source_system", F.element_at(F.split("source_file", "/"), -1).alias("source_file"),
        F.col("ingestion_timestamp").isNotNull().alias("has_load_time"),
    )
