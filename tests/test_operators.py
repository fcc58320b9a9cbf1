"""Edge cases of single operators, and results under heavily repeated keys."""

import datetime as dt
import statistics
from collections import Counter, defaultdict

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tallymill.operators import clean, dedup, dml, gold, timeintel, validate
from tallymill.operators.describe import describe
from tallymill.operators.incremental import since_high_water_mark
from tallymill.operators.layout import clustered
from tallymill.operators.aggregate import sum_by_key
from tallymill.plans import taxi

NTZ = "TIMESTAMP_NTZ"


def test_latest_per_key_is_total_and_independent_of_partitioning(spark):
    data = [("a", 1, i, j) for i in range(40) for j in range(3)] + [(None, 1, 5, 5), (None, 2, 0, 0), ("b", None, 1, 1)]
    df = spark.createDataFrame(data, "k string, ts int, x int, y int")
    want = [(None, 2, 0, 0), ("a", 1, 39, 2), ("b", None, 1, 1)]
    for parts in (1, 7):
        assert rows(dedup.latest_per_key(df.repartition(parts), ["k"], ["ts"])) == want


def test_latest_per_key_sends_one_row_per_task_for_a_hot_key(spark):
    df = spark.range(0, 20_000, 1, 8).select((F.col("id") % 1 + 1).alias("k"), F.col("id").alias("ts"))
    best = dedup.latest_per_key(df, ["k"], ["ts"])
    assert rows(best) == [(1, 19_999)]
    assert "WindowGroupLimit" in best._jdf.queryExecution().executedPlan().toString()


def test_flagging_does_not_multiply_rows_and_keeps_every_row(spark):
    facts = spark.createDataFrame(
        [(1, "p", 1), (2, "p", 0), (3, "q", 1), (4, None, None), (5, "p", None)], "id int, product_id string, quantity int"
    )
    master = spark.createDataFrame([("p",), ("p",), (None,)], "product_id string")
    flagged = validate.flag_rows(facts, {"product_id": master}, {"quantity": F.col("quantity") > 0})
    assert rows(validate.valid_rows(flagged)) == [(1, "p", 1)]
    assert rows(validate.rejected_rows(flagged), "id", "reject_reasons") == [
        (2, ["quantity"]), (3, ["unknown_product_id"]), (4, ["unknown_product_id", "quantity"]), (5, ["quantity"])]
    assert validate.split_counts(flagged).first().asDict() == {"checked": 5, "valid": 1, "rejected": 4}


def test_look_back(spark):
    day = lambda n: dt.datetime(2025, 1, n)
    rows_in = spark.createDataFrame([(1, day(1)), (2, day(8)), (3, day(10)), (4, None)], "id int, ts timestamp_ntz")
    empty = rows_in.limit(0)
    assert rows(since_high_water_mark(rows_in, empty, "ts"), "id") == [(1,), (2,), (3,), (4,)]
    loaded = rows_in.where("id = 3")
    assert rows(since_high_water_mark(rows_in, loaded, "ts"), "id") == [(2,), (3,)]
    assert rows(since_high_water_mark(rows_in, loaded, "ts", "1 day"), "id") == [(3,)]


@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0, 1.0, 2.0], [7.0] * 500 + [1.0, 9.0], [float(i * i % 1009) for i in range(3000)],
    [float(i) for i in range(1, 130)],
])
def test_describe_equals_brute_force(spark, values):
    df = spark.createDataFrame([(v, None) for v in values], "x double, empty double").repartition(5)
    got = {row["measure"]: row for row in describe(df, ["x", "empty"], {"p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}).collect()}
    ordered = sorted(values)

    def percentile(p):
        at = p * (len(ordered) - 1)
        low = ordered[int(at)]
        return low + (ordered[min(int(at) + 1, len(ordered) - 1)] - low) * (at - int(at))

    row = got["x"]
    assert (row["count"], row["min"], row["max"]) == (len(values), ordered[0], ordered[-1])
    assert row["mean"] == pytest.approx(statistics.fmean(values))
    for name, p in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99), ("p100", 1.0)):
        assert row[name] == pytest.approx(percentile(p))
    if len(values) > 1:
        assert row["std"] == pytest.approx(statistics.stdev(values))
    else:
        assert row["std"] is None
    assert got["empty"]["count"] == 0 and got["empty"]["p50"] is None


def test_sum_by_key_drops_null_keys_and_skips_null_values(spark):
    df = spark.createDataFrame([("a", 1.1), ("a", None), (None, 5.0), ("b", 2.2), ("b", 0.1)], "k string, v double")
    assert rows(sum_by_key(df, "k", "v", "s")) == [("a", 1.1), ("b", 2.3)]


def _skewed_sales(spark):
    """A third of the sales belong to one store and product; some have unknown keys."""
    return spark.range(0, 9_000, 1, 6).select(
        F.col("id").alias("transaction_id"),
        F.expr("TIMESTAMP_NTZ '2024-01-01' + make_interval(0, 0, 0, int(id % 700))").alias("transaction_timestamp"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("store_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 91).alias("product_id"),
        (F.col("id") % 4 + 1).cast("int").alias("quantity"),
        (F.col("id") % 1000 / 100).alias("unit_price"), F.lit(0.05).alias("discount"),
    )


def test_gold_under_a_hot_key_equals_brute_force(spark):
    sales = clean.calibrate(_skewed_sales(spark))
    stores = spark.createDataFrame([(i, f"s{i}", f"r{i % 3}", "c") for i in range(40)], "store_id long, store_name string, region string, country string")
    revenue, quantity, count = defaultdict(float), Counter(), Counter()
    for row in sales.collect():
        stamp = row["transaction_timestamp"]
        region = f"r{row['store_id'] % 3}" if row["store_id"] < 40 else None
        key = (stamp.year, stamp.month, region, "c" if region else None)
        revenue[key] += row["total_amount"]
        quantity[key] += row["quantity"]
        count[key] += 1
    got = {tuple(row)[:4]: tuple(row)[4:] for row in gold.gold_monthly_region(sales, stores).collect()}
    assert got.keys() == revenue.keys()
    for key, (total, pieces) in got.items():
        assert total == pytest.approx(revenue[key], abs=0.005) and pieces == quantity[key]
    rolled = gold.monthly_region(gold.by_store_and_day(sales), stores)
    assert {tuple(row)[:4]: tuple(row)[4:] for row in rolled.collect()} == got
    totals = gold.region_rollup(sales, stores).where("level = 3").first()
    assert totals["total_transactions"] == 9_000


def test_top_products_returns_all_ties(spark):
    data = [(i, i % 5, 1, float(10 * (i % 5)), "2024-01-01") for i in range(50)]
    sales = spark.createDataFrame(
        [(i, i, 1, float(10 * (i % 5)), float(10 * (i % 5))) for i in range(50)],
        "transaction_id long, product_id long, quantity int, unit_price double, total_amount double",
    )
    top = gold.top_products(sales, 2)
    assert len(data) == 50 and top.count() == 20
    assert rows(top.select("total_revenue", "revenue_rank").distinct()) == [(30.0, 2), (40.0, 1)]


def test_time_series_fill_gaps(spark):
    data = [("a", dt.datetime(2023, 11, 5), 10.0), ("a", dt.datetime(2024, 2, 1), 5.0), ("a", dt.datetime(2024, 11, 30), 40.0),
            ("b", dt.datetime(2024, 1, 1), 1.0), ("b", None, 99.0)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz, v double")
    series = timeintel.monthly_series(df, "ts", "v", ["k"])
    assert series.where("k = 'a'").count() == 13 and series.where("k = 'b'").count() == 1
    ytd = timeintel.year_to_date(series, ["k"]).where("k = 'a' AND year = 2024")
    assert [float(v) for _, v in rows(ytd.select(F.format_string("%02d", "month"), "ytd"))] == [0.0] + [5.0] * 9 + [45.0]
    last = timeintel.year_over_year(series, ["k"]).where("k = 'a' AND year = 2024 AND month = 11").first()
    assert (float(last["amount"]), float(last["last_year"]), last["yoy_growth"]) == (40.0, 10.0, 3.0)
    assert timeintel.month_over_month(series, ["k"]).where("previous_month IS NULL").count() == 2
    dense = timeintel.sales_by_calendar(df.where("k = 'a'"), "ts", "v")
    assert dense.count() == 392 and dense.where("amount > 0").count() == 3


def test_update_sees_old_values(spark):
    df = spark.createDataFrame([(1, 2), (3, 4)], "a int, b int")
    assert rows(dml.update_rows(df, F.col("a") == 1, {"a": F.col("b"), "b": F.col("a")})) == [(2, 1), (3, 4)]


def test_row_diff_matches_null_keys(spark):
    before = spark.createDataFrame([(None, 1), (1, 1), (2, 1)], "k int, v int")
    after = spark.createDataFrame([(None, 2), (1, 1), (3, 1)], "k int, v int")
    assert rows(dml.row_diff(before, after, ["k"], ["v"])) == [
        (None, 1, 2, "update"), (2, 1, None, "delete"), (3, None, 1, "insert")]


def test_clustering_spreads_a_hot_value(spark):
    df = spark.range(0, 30_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("customer_id"), "id"
    )
    out = clustered(df, "customer_id", files=8)
    sizes = [row[0] for row in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 8_000
    assert out.where("customer_id = -1").select(F.spark_partition_id()).distinct().count() >= 2


def test_suspicious_flags_are_three_valued(spark):
    rides = spark.createDataFrame(
        [(1, 20.0, 0.5, 30.0), (2, None, 0.5, 30.0), (3, None, 5.0, 30.0), (4, 1.0, 5.0, 5.0)],
        "id int, fare_per_km double, trip_distance double, fare_amount double",
    )
    assert rows(clean.flag_suspicious(rides), "id", "is_suspicious_ride") == [
        (1, True), (2, True), (3, None), (4, False)]


def test_net_total_rounds_half_up_and_keeps_null(spark):
    df = spark.createDataFrame([(3, 0.335, 0.0), (1, None, 0.0), (2, 10.0, None), (3, 300.0, 30.0)],
                               "quantity int, unit_price double, discount double")
    assert [row["total_amount"] for row in clean.calibrate(df).collect()] == [1.01, None, None, 870.0]


def test_period_includes_both_days(spark):
    df = spark.createDataFrame([(1, dt.datetime(2025, 1, 1)), (2, dt.datetime(2025, 1, 2, 23, 59)), (3, dt.datetime(2025, 1, 3))],
                               "id int, ts timestamp")
    assert rows(clean.in_period(df, "ts", "2025-01-01", "2025-01-02"), "id") == [(1,), (2,)]


def test_top_fares_have_rank_and_tie_break(spark):
    from tallymill.schemas import TAXI_TRIPS

    rides = spark.createDataFrame(
        [(f"t{i}", "V1", None, None, 1, 1.0, fare, fare, "CASH") for i, fare in enumerate([5.0, 9.0, 9.0, 9.0, None])],
        TAXI_TRIPS,
    )
    assert rows(taxi.top_fares(rides), "rank", "trip_id") == [(1, "t1"), (2, "t2"), (3, "t3")]


def test_amounts_keep_their_digits(spark):
    from tallymill.functions.columns import net_total
    from tallymill.operators import aggregate

    sale = spark.createDataFrame([(1_000_000, 0.00005, 0.0), (3, 0.1, 0.0), (1, 2e14, 0.5)], "q int, p double, d double")
    assert sorted(r[0] for r in sale.select(net_total("q", "p", "d")).collect()) == [0.3, 50.0, 2e14 - 0.5]
    small = spark.createDataFrame([("a", 0.00004), ("a", 0.00004), ("b", 2e14)], "k string, v double")
    assert aggregate.mean_of(small.where("k = 'a'"), "v", "m").first()[0] == 0.00004
    assert rows(aggregate.sum_by_key(small, "k", "v", "s")) == [("a", 0.00008), ("b", 2e14)]
