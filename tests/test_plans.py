"""What the physical plans must look like for the work to scale."""

from conftest import final_plan
from pyspark.sql import functions as F

from tallymill.operators import gold
from tallymill.operators.clean import calibrate
from tallymill.operators.incremental import since_high_water_mark
from tallymill.queries import QUERIES
from tallymill.sources import star


def _plan(name, spark, sf_dir):
    return final_plan(QUERIES[name](spark, sf_dir))


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = _plan("high_value_rows", spark, sf_dir)
    assert "GreaterThan(o_totalprice,400000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>" in plan
    assert "Exchange" not in plan


def test_top_k_without_a_full_sort(spark, sf_dir):
    plan = _plan("top3", spark, sf_dir)
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_facts_are_scanned_once(spark, sf_dir):
    for name in ("ytd", "yoy", "calendar_join", "gold_daily", "top_products", "target_vs_actual", "split_counts"):
        fact = "lineitem" if name in ("gold_daily", "top_products", "split_counts") else "orders"
        assert _plan(name, spark, sf_dir).count(f"/{fact}.parquet") == 1, name


def test_facts_are_aggregated_before_the_join(spark, sf_dir):
    sales = calibrate(star.sales(spark, sf_dir))
    plan = final_plan(gold.gold_product(sales, star.products(spark, sf_dir)))
    fact_side = plan[plan.index("Join"):]
    assert fact_side.index("HashAggregate") < fact_side.index("lineitem.parquet")
    assert "partial_sum" in plan


def test_narrow_operators_do_not_shuffle(spark, sf_dir):
    for name in ("calibrated_total", "conditional_update", "conditional_delete", "rows_in_period"):
        assert "Exchange" not in _plan(name, spark, sf_dir), name


def test_high_water_mark_skips_row_groups(spark, tmp_path):
    path = str(tmp_path / "facts")
    stamps = spark.range(0, 100_000, 1, 1).select(
        F.expr("TIMESTAMP '2024-01-01' + make_dt_interval(0, 0, int(id))").alias("ts"), "id"
    )
    stamps.sortWithinPartitions("ts").write.option("parquet.block.size", 100_000).option(
        "parquet.page.size", 10_000
    ).parquet(path)
    facts = spark.read.parquet(path)
    recent = since_high_water_mark(facts, facts, "ts", "1 hour")
    execution = recent._jdf.queryExecution()
    kept = execution.executedPlan().execute().count()
    scanned = _scan_rows(execution.executedPlan())
    assert kept <= scanned < 50_000


def test_high_water_mark_skips_partitions(spark, tmp_path):
    path = str(tmp_path / "facts")
    days = spark.range(0, 100).select(
        F.expr("TIMESTAMP '2024-01-01' + make_dt_interval(int(id))").alias("ts"), "id"
    ).withColumn("day", F.to_date("ts"))
    days.write.partitionBy("day").parquet(path)
    facts = spark.read.schema("ts timestamp, id long, day date").parquet(path)
    recent = since_high_water_mark(facts, facts, "ts", "2 days", period="day")
    plan = recent._jdf.queryExecution().executedPlan()
    assert plan.execute().count() == 3 == _scan_rows(plan)


def _scan_rows(plan):
    while not plan.nodeName().startswith("Scan"):
        plan = plan.finalPhysicalPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def test_no_cross_joins_or_python_workers(spark, sf_dir):
    for name in sorted(QUERIES):
        if QUERIES[name].__module__.endswith("changes") or name == "lakehouse_monthly_region":
            continue
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
            assert operator not in plan, (name, operator)
