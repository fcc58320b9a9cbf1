"""Queries through stored tables: managed tables, the taxi pipeline, the lab job and the run log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallymill.operators import dedup
from tallymill.plans import lab, taxi
from tallymill.plans.medallion import RetailLakehouse
from tallymill.plans.runlog import RunLog
from tallymill.queries.registry import PRODUCTS, STORES, kept, query, scratch_database
from tallymill.schemas import LAB_SALES, PRODUCTS as PRODUCTS_FILE, RAW_SALES, STORES as STORES_FILE, TAXI_TRIPS, table
from tallymill.session import scratch_path
from tallymill.sinks import writers
from tallymill.sources import readers, star


@query("SELECT event_id, user_id, event_type, value FROM events")
def managed_table_rows(spark, sf_dir):
    """Half of the events overwrite a managed table and the rest are appended."""
    events = star.load(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    with scratch_database(spark) as database:
        name = f"{database}.events"
        writers.overwrite_table(events, name)
        writers.overwrite_table(events.where("event_id % 2 = 0"), name)
        writers.append_table(events.where("event_id % 2 = 1"), name)
        return kept(readers.read_table(spark, name))


@query("SELECT DISTINCT 'event_type=' || event_type AS partition FROM events")
def table_partitions(spark, sf_dir):
    with scratch_database(spark) as database:
        name = f"{database}.events"
        writers.overwrite_table(star.load(spark, sf_dir, "events").select("event_id", "event_type"), name, ("event_type",))
        return kept(writers.table_partitions(spark, name))


@query("""SELECT event_type, count(*) AS n, CAST(NULL AS DOUBLE) AS top_value FROM events GROUP BY event_type""")
def gold_keeps_columns(spark, sf_dir):
    """A second result without a column of the first: the column stays, filled with null."""
    events = star.load(spark, sf_dir, "events")
    with scratch_database(spark) as database:
        name = f"{database}.gold"
        writers.overwrite_table(events.groupBy("event_type").agg(F.count("*").alias("n"), F.max("value").alias("top_value")), name)
        writers.overwrite_keeping_columns(events.groupBy("event_type").agg(F.count("*").alias("n")), name)
        return kept(readers.read_table(spark, name))


@query("""SELECT 'tables' AS step, 'clicks,views' AS found
UNION ALL SELECT 'columns', 'event_id bigint,event_type string,value double'
UNION ALL SELECT 'shape', count(*) || ' x 3' FROM events WHERE event_type = 'view'
UNION ALL SELECT 'tables after a drop', 'clicks'""")
def catalog_life_cycle(spark, sf_dir):
    """Two tables made, listed and described, and one dropped."""
    events = star.load(spark, sf_dir, "events").select("event_id", "event_type", "value")

    def listed() -> DataFrame:
        names = writers.tables(spark).where(F.col("namespace") == database)
        return names.agg(F.array_join(F.array_sort(F.collect_list("tableName")), ",").alias("found"))  # two names
    with scratch_database(spark) as database:
        writers.use_database(spark, database)
        for name, kind in (("clicks", "click"), ("views", "view")):
            writers.overwrite_table(events.where(F.col("event_type") == kind), name)
        # The description begins with the columns and goes on after an empty line.
        columns = writers.table_detail(spark, "views").where(F.col("col_name").isin(*events.columns) & F.col("data_type").isin("bigint", "string", "double"))
        described = columns.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(" ", "col_name", "data_type"))), ",").alias("found"))
        n_rows, n_columns = writers.shape(spark.table("views"))
        steps = {"tables": listed(), "columns": described, "shape": spark.range(1).select(F.lit(f"{n_rows} x {n_columns}").alias("found"))}
        found = [kept(df.select(F.lit(step).alias("step"), "found")) for step, df in steps.items()]
        writers.drop_table(spark, "views")
        found.append(kept(listed().select(F.lit("tables after a drop").alias("step"), "found")))
    return reduce(DataFrame.unionAll, found)


_LINES = """lines AS (
  SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderstatus, o_orderkey % 10 AS kind,
         o_orderkey || ',' || strftime(o_orderdate, '%Y-%m-%d') AS head
  FROM orders)"""


@query(f"""WITH {_LINES}
SELECT o_orderkey, cents, o_orderstatus, CAST(NULL AS VARCHAR) AS raw_line FROM lines WHERE kind NOT IN (3, 6, 9)
UNION ALL SELECT NULL, NULL, NULL, CASE kind WHEN 3 THEN head WHEN 6 THEN head || ',' || cents || ',' || o_orderstatus || ',surplus'
  ELSE head || ',n/a,' || o_orderstatus END FROM lines WHERE kind IN (3, 6, 9)""")
def csv_rejects(spark, sf_dir):
    """Orders as CSV lines, of which some are short, long or ill-typed: rows, and the text of the others."""
    orders = star.load(spark, sf_dir, "orders")
    cents, kind = F.round(F.col("o_totalprice") * 100).cast("long"), F.col("o_orderkey") % 10
    head = F.concat_ws(",", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd"))
    line = (
        F.when(kind == 3, head).when(kind == 6, F.concat_ws(",", head, cents, "o_orderstatus", F.lit("surplus")))
        .when(kind == 9, F.concat_ws(",", head, F.lit("n/a"), "o_orderstatus")).otherwise(F.concat_ws(",", head, cents, "o_orderstatus"))
    )
    path, schema = scratch_path(spark, "lines"), table("o_orderkey long, o_orderdate date, cents long, o_orderstatus string")
    # One column whose name is the header; a separator that no line has leaves the lines as they are.
    orders.select(line.alias(",".join(schema.names))).write.option("header", True).option("sep", "\u0001").csv(path)
    checked = readers.read_csv_checked(spark, path, schema)
    # What could be read of a malformed line is not shown.
    fields = [F.when(F.col(readers.RAW_LINE).isNull(), F.col(c)).alias(c) for c in ("o_orderkey", "cents", "o_orderstatus")]
    return checked.select(*fields, readers.RAW_LINE)


# Distances are shifted so that some trips fail the quality rule.
_TRIPS = """trips AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS trip_id, o_orderdate AS pickup_datetime,
         l_quantity - 10 AS trip_distance, l_extendedprice AS fare_amount, l_extendedprice + 1 AS total_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _taxi(spark, sf_dir, table_name: str, *columns: str) -> DataFrame:
    """Run the taxi pipeline on trips written as CSV; one of its tables."""
    lines, orders = star.load(spark, sf_dir, "lineitem"), star.load(spark, sf_dir, "orders")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    trips = joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey").alias("trip_id"), F.lit("V1").alias("vendor_id"),
        F.col("o_orderdate").cast("timestamp").alias("pickup_datetime"), F.col("l_shipdate").cast("timestamp").alias("dropoff_datetime"),
        F.lit(1).alias("passenger_count"), (F.col("l_quantity") - 10).alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"), (F.col("l_extendedprice") + 1).alias("total_amount"), F.lit("CARD").alias("payment_type"),
    ).select(*TAXI_TRIPS.names)
    path = scratch_path(spark, "taxi")
    writers.write_csv(trips, path)
    with scratch_database(spark) as database:
        taxi.run(spark, path, database)
        return kept(readers.read_table(spark, table_name).select(*columns or "*"))


@query(f"""WITH {_TRIPS} SELECT CAST(date_trunc('week', pickup_datetime) AS DATE) AS week_start, count(*) AS total_trips,
CAST(sum(CAST(total_amount AS DECIMAL(38,4))) AS DOUBLE) AS total_revenue,
CAST(sum(CAST(fare_amount AS DECIMAL(38,4))) AS DOUBLE) / count(fare_amount) AS avg_fare_amount,
CAST(sum(CAST(trip_distance AS DECIMAL(38,4))) AS DOUBLE) / count(trip_distance) AS avg_trip_distance
FROM trips WHERE trip_distance > 0 GROUP BY 1""")
def taxi_weekly_stored(spark, sf_dir):
    return _taxi(spark, sf_dir, taxi.TAXI_WEEKLY)


@query(f"""WITH {_TRIPS}, clean AS (SELECT * FROM trips WHERE trip_distance > 0)
SELECT trip_id, fare_amount, CAST(row_number() OVER (ORDER BY fare_amount DESC, trip_id) AS INTEGER) AS rank
FROM clean ORDER BY rank LIMIT 3""")
def taxi_top_stored(spark, sf_dir):
    return _taxi(spark, sf_dir, taxi.TAXI_TOP, "trip_id", "fare_amount", "rank")


@query("""SELECT o_orderkey AS transaction_id, CAST(epoch_ms(CAST(o_orderdate AS DATE)::TIMESTAMP) AS BIGINT) AS date, o_totalprice AS total,
CASE WHEN o_custkey % 7 = 0 THEN 0 ELSE o_custkey END AS customer_id, CASE WHEN o_orderstatus = 'P' THEN 'PAID' ELSE 'NO CODE' END AS promo_code
FROM orders""")
def lab_job(spark, sf_dir):
    """The lab's small ETL job on orders: text dates, missing customers and codes, JSON out."""
    orders = star.load(spark, sf_dir, "orders")
    raw = orders.select(
        F.col("o_orderkey").alias("transaction_id"), F.lit(1).alias("store_id"), F.lit("s").alias("store_name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.lit(1).alias("product_id"), F.lit("p").alias("product_name"),
        F.lit(1).alias("quantity"), F.col("o_totalprice").alias("unit_price"), F.col("o_totalprice").alias("total"),
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("customer_id"),
        F.when(F.col("o_orderstatus") == "P", "PAID").alias("promo_code"),
    ).select(*LAB_SALES.names)
    source, target = scratch_path(spark, "lab-in"), scratch_path(spark, "lab-out")
    writers.write_csv(raw, source)
    lab.run(spark, source, target)
    found = spark.read.schema("transaction_id long, date long, total double, customer_id long, promo_code string").json(target)
    return found


@query("""SELECT event_type AS pipeline_name, CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS records_processed, CAST(0 AS BIGINT) AS records_rejected
FROM events GROUP BY event_type""")
def run_log_written(spark, sf_dir):
    """One logged run for each event type; the run over errors fails."""
    log = RunLog(spark, scratch_path(spark, "log"))
    log.create()
    events = star.load(spark, sf_dir, "events")
    for row in events.groupBy("event_type").count().collect():  # five types
        try:
            with log.run(row["event_type"], "bronze") as run:
                run.processed = row["count"]
                if row["event_type"] == "error":
                    raise ValueError("errors are not loaded")
        except ValueError:
            pass
    return log.read().select("pipeline_name", "status", "records_processed", "records_rejected")


# Replay: three loads, ids that come again in a later load, rows too old for the look-back, unknown masters.

_LOOK_BACK_DAYS = 900
_REPLAY = f"""WITH {PRODUCTS}, {STORES}, arrived AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id, l_suppkey % 3 + 1 AS load, l_shipdate AS ts, l_suppkey, l_partkey,
         CAST(l_quantity AS INTEGER) - 3 AS quantity, l_extendedprice AS unit_price, l_discount AS discount
  FROM lineitem),
rows AS (
  SELECT *, l_partkey IN (SELECT product_id FROM products WHERE size <= 40) AS known_product,
         l_suppkey IN (SELECT store_id FROM stores WHERE balance > 0) AS known_store, quantity > 0 AS positive
  FROM arrived
  QUALIFY row_number() OVER (PARTITION BY transaction_id, load ORDER BY ts DESC, l_suppkey DESC, l_partkey DESC, quantity DESC, unit_price DESC, discount DESC) = 1),
tested AS (SELECT *, known_product AND known_store AND positive AS ok FROM rows),
seen1 AS (SELECT * FROM tested WHERE load = 1),
silver1 AS (SELECT * FROM seen1 WHERE ok),
seen2 AS (
  SELECT * FROM tested WHERE load <= 2 AND ts >= (SELECT max(ts) FROM silver1) - INTERVAL {_LOOK_BACK_DAYS} DAY
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY load DESC) = 1),
silver2 AS (SELECT * FROM seen2 WHERE ok UNION ALL SELECT * FROM silver1 WHERE transaction_id NOT IN (SELECT transaction_id FROM seen2 WHERE ok)),
seen3 AS (
  SELECT * FROM tested WHERE ts >= (SELECT max(ts) FROM silver2) - INTERVAL {_LOOK_BACK_DAYS} DAY
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY load DESC) = 1),
silver3 AS (SELECT * FROM seen3 WHERE ok UNION ALL SELECT * FROM silver2 WHERE transaction_id NOT IN (SELECT transaction_id FROM seen3 WHERE ok)),
refused AS (
  SELECT * FROM (
    SELECT *, 1 AS step FROM seen1 WHERE NOT ok UNION ALL SELECT *, 2 FROM seen2 WHERE NOT ok UNION ALL SELECT *, 3 FROM seen3 WHERE NOT ok)
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY step DESC) = 1)"""


def _replayed(spark, sf_dir, gold: bool = False) -> RetailLakehouse:
    """Load, refresh, three times; the last refresh is run twice and must change nothing.  ``gold`` is refreshed each time."""
    house = RetailLakehouse(spark, scratch_path(spark, "replay"), lookback=f"{_LOOK_BACK_DAYS} days", period="year")
    house.create()
    products = star.products(spark, sf_dir).where("size <= 40").select(*PRODUCTS_FILE.names)
    stores = star.stores(spark, sf_dir).where("balance > 0").select(*STORES_FILE.names)
    for masters, load in ((products, house.load_products), (stores, house.load_stores)):
        path = scratch_path(spark, "masters")
        writers.write_csv(masters, path)
        load(path)
    lines = star.load(spark, sf_dir, "lineitem")
    arrived = lines.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id"), F.col("l_shipdate").cast("timestamp").alias("transaction_timestamp"),
        "l_suppkey", "l_partkey", (F.col("l_quantity").cast("int") - 3).alias("quantity"), F.col("l_extendedprice").alias("unit_price"),
        F.col("l_discount").alias("discount"), (F.col("l_suppkey") % 3 + 1).alias("load"))
    rows = dedup.latest_per_key(arrived, ["transaction_id", "load"], ["transaction_timestamp", "l_suppkey", "l_partkey", "quantity", "unit_price", "discount"])
    for number in (1, 2, 3):
        path = scratch_path(spark, "load")
        named = rows.where(F.col("load") == number).withColumns({
            "store_id": F.col("l_suppkey").cast("string"), "product_id": F.col("l_partkey").cast("string"),
            "total_amount": F.lit(0.0), "currency": F.lit("EUR"),
        })
        writers.write_csv(named.select(*RAW_SALES.names), path, "gzip")
        house.ingest(path)
        house.refresh_silver()
        if gold:
            house.refresh_gold()
    house.refresh_silver()
    return house


@query(f"""{_REPLAY} SELECT transaction_id, CAST(ts AS TIMESTAMP) AS transaction_timestamp, CAST(l_suppkey AS VARCHAR) AS store_id,
CAST(l_partkey AS VARCHAR) AS product_id, quantity, round(quantity * unit_price - discount, 2) AS total_amount FROM silver3""")
def incremental_replay(spark, sf_dir):
    """Silver after three loads."""
    silver = _replayed(spark, sf_dir).silver()
    stamp = F.col("transaction_timestamp").cast("timestamp_ntz").alias("transaction_timestamp")
    return silver.select("transaction_id", stamp, "store_id", "product_id", "quantity", "total_amount")


@query(f"""{_REPLAY} SELECT transaction_id, CAST(l_suppkey AS VARCHAR) AS store_id, quantity,
concat_ws(',', CASE WHEN NOT known_product THEN 'unknown_product_id' END, CASE WHEN NOT known_store THEN 'unknown_store_id' END,
          CASE WHEN NOT positive THEN 'quantity_not_positive' END) AS reasons FROM refused""")
def incremental_replay_rejected(spark, sf_dir):
    """The quarantine after three loads, with reasons."""
    refused = _replayed(spark, sf_dir).rejected()
    return refused.select("transaction_id", "store_id", "quantity", F.array_join("reject_reasons", ",").alias("reasons"))


@query(f"""{_REPLAY}, priced AS (SELECT *, round(quantity * unit_price - discount, 2) AS total_amount FROM silver3),
summed AS (
  SELECT l_partkey, CAST(sum(quantity) AS BIGINT) AS total_quantity,
         CAST(round(sum(CAST(total_amount AS DECIMAL(38,4))), 2) AS DOUBLE) AS total_revenue,
         CAST(sum(CAST(round(unit_price * 100) AS HUGEINT)) AS HUGEINT) AS cents, CAST(count(unit_price) AS HUGEINT) AS n,
         min(unit_price) AS least_unit_price, max(unit_price) AS most_unit_price
  FROM priced GROUP BY l_partkey)
SELECT CAST(l_partkey AS VARCHAR) AS product_id, category, brand, total_quantity, total_revenue,
       CAST((2 * cents + n) // (2 * n) AS DOUBLE) / 100 AS avg_unit_price, least_unit_price, most_unit_price
FROM summed JOIN products ON l_partkey = product_id""")
def gold_from_changes(spark, sf_dir):
    """Product gold after three loads, brought up to date from each load's changes."""
    house = _replayed(spark, sf_dir, gold=True)
    columns = ["product_id", "category", "brand", "total_quantity", "total_revenue", "avg_unit_price"]
    return house.gold("product_performance").select(*columns).join(house.gold("product_prices"), "product_id")
