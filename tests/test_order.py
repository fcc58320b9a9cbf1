"""Row numbers, percentiles, dense series and whole-row duplicates, against brute force and in their plans."""

import datetime as dt
import random

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from tallymill.operators import dedup, describe, ranking, timeintel
from test_skew import settings


@pytest.mark.parametrize("hot", [0, 3])
def test_numbers_and_ranks_equal_a_sort(spark, hot):
    rand = random.Random(3)
    data = [(i, "hot" if hot and i % hot == 0 else rand.choice(["a", "b", None, f"k{i}"]), rand.choice([None, 1.5, float(i)])) for i in range(900)]
    frame = spark.createDataFrame(data + data[:30], "id int, k string, v double").repartition(7)
    got = ranking.with_ranks(frame, ["k"], ["k", F.col("v").desc_nulls_last(), "id"]).collect()
    ordered = sorted(data + data[:30], key=lambda r: (r[1] is not None, r[1] or "", r[2] is None, -(r[2] or 0), r[0]))
    assert [(r["id"], r["k"], r["v"]) for r in sorted(got, key=lambda r: r["row_number"])] == ordered
    assert sorted(r["row_number"] for r in got) == list(range(1, len(ordered) + 1))
    first = {}
    for n, row in enumerate(ordered, 1):
        first.setdefault(row[1], n)
    assert all(r["rank"] == first[r["k"]] for r in got)


def test_one_value_is_numbered_in_several_tasks(spark):
    frame = spark.range(0, 20_000, 1, 4).select(F.lit(1).alias("k"), "id")
    with settings(spark, **{"spark.sql.adaptive.coalescePartitions.enabled": "false"}):
        numbered = ranking.with_row_numbers(frame, "n", "k")
    (folder,) = {name.rpartition("/")[0] for name in numbered.inputFiles() if "numbered-" in name}
    written = spark.read.parquet(folder).groupBy(F.input_file_name()).count()
    assert numbered.select("n").distinct().count() == 20_000 == numbered.agg(F.max("n")).first()[0]
    assert 1 < written.count() and written.agg(F.max("count")).first()[0] < 12_000


def test_numbers_of_no_rows_and_without_an_order(spark):
    assert ranking.with_row_numbers(spark.range(0), "n", "id").isEmpty()
    assert rows(ranking.with_row_numbers(spark.range(0, 50, 1, 5), "n"), "n") == sorted([(n,) for n in range(1, 51)], key=str)


def test_sums_come_in_key_order(spark, sf_dir):
    from tallymill.queries import QUERIES

    keys = [r[0] for r in QUERIES["sums_in_key_order"](spark, sf_dir).collect()]
    assert keys == sorted(keys) and len(keys) == 5


def test_percentiles_of_a_million_values_order_few(spark, monkeypatch):
    monkeypatch.setattr(describe, "MOST_ORDERED", 3000)
    seen = []
    real = describe._searched
    monkeypatch.setattr(describe, "_searched", lambda values, searches: seen.append(searches) or real(values, searches))
    # Values far apart and near each other, some frequent.
    values = spark.range(0, 1_000_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.col("id") * 1e-9).otherwise(F.exp(F.col("id") / 20_000.0)).alias("x"),
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("y"))
    got = {r["measure"]: r for r in describe.exact_percentiles(values, ["x", "y"], {"p1": 0.01, "p50": 0.5, "p99": 0.99}).collect()}
    want = values.agg(*[F.expr(f"percentile({c}, {p})").alias(f"{c}{p}") for c in "xy" for p in (0.01, 0.5, 0.99)]).first()
    for c in "xy":
        for name, p in (("p1", 0.01), ("p50", 0.5), ("p99", 0.99)):
            assert got[c][name] == pytest.approx(want[f"{c}{p}"], rel=1e-12)
    # The last searches are those whose values a task orders; each round leaves at most a hundredth.
    assert max(s.distinct for s in seen[-1]) <= 3000 and len(seen) <= 4


def test_percentiles_of_few_and_no_values(spark):
    frame = spark.createDataFrame([(1.0, None), (2.0, None), (float("nan"), None)], "a double, b double")
    got = {r["measure"]: r for r in describe.describe(frame, ["a", "b"]).collect()}
    assert (got["a"]["p25"], got["a"]["p50"]) == (1.5, 2.0) and got["b"]["p50"] is None and got["b"]["count"] == 0


def test_a_stray_far_date_costs_its_own_days(spark):
    days = [(dt.datetime(2024, 1, 1), "a", 1.0), (dt.datetime(2024, 1, 4), "a", 2.0), (dt.datetime(9999, 12, 30), "b", 3.0), (dt.datetime(9999, 12, 28), "b", 1.0), (dt.datetime(2024, 1, 2), None, 5.0)]
    frame = spark.createDataFrame(days, "ts timestamp, k string, v double")
    got = rows(timeintel.monthly_series(frame, "ts", "v", ["k"]), "k", "month_start", "amount")
    assert [(k, str(m), float(a)) for k, m, a in got] == [(None, "2024-01-01", 5.0), ("a", "2024-01-01", 3.0), ("b", "9999-12-01", 4.0)]
    series = timeintel.sales_by_calendar(frame, "ts", "v")
    assert series.count() == (dt.date(9999, 12, 30) - dt.date(2024, 1, 1)).days + 1
    assert series.agg(F.sum("amount")).first()[0] == 12.0
    assert "collect_list" not in final_plan(series)


def test_whole_row_duplicates_move_hashes_not_rows(spark):
    wide = "x" * 2000
    data = [(i % 400 if i < 500 else i, None if i % 7 == 0 else f"{wide}{i % 400 if i < 500 else i}", -0.0 if i % 2 else 0.0) for i in range(3000)]
    frame = spark.createDataFrame([(a, b, 0.0) for a, b, _ in data], "hash_1 int, b string, c double")
    out = dedup.exact_dedup(frame)
    assert rows(out) == rows(frame.dropDuplicates())
    execution = out._jdf.queryExecution().executedPlan()
    execution.execute().count()

    def exchanged(plan):
        name = plan.nodeName()
        if name == "AdaptiveSparkPlan":
            return exchanged(plan.finalPhysicalPlan())
        if name.endswith("QueryStage"):
            return exchanged(plan.plan())
        own = plan.metrics().apply("dataSize").value() if name == "Exchange" else 0
        children = plan.children()
        return own + sum(exchanged(children.apply(k)) for k in range(children.size()))
    assert exchanged(execution) < 0.2 * 3000 * 2000


def test_very_many_copies_are_shuffled_whole(spark, monkeypatch):
    monkeypatch.setattr(dedup, "MOST_REPEATED", 3)
    frame = spark.createDataFrame([(i % 20, None) for i in range(60)], "a int, b string")
    assert rows(dedup.exact_dedup(frame)) == rows(frame.dropDuplicates())
