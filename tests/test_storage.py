"""Sinks, catalog commands, the taxi pipeline on tables, and the run log."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import DataFrameWriter, functions as F
from pyspark.sql.types import StructType

from tallymill import fixed_values as values
from tallymill.operators.versioned import VersionedTable
from tallymill.plans import runlog, taxi
from tallymill.plans.runlog import RunLog
from tallymill.schemas import RUN_LOG, TAXI_TRIPS, table
from tallymill.session import scratch_path
from tallymill.sinks import writers
from tallymill.sources import readers
from tallymill.streaming import loads


def test_taxi_pipeline(spark, tmp_path):
    start = dt.datetime(2024, 1, 1, 8)
    data = []
    for i in range(50):
        distance = [-1.0, 0.0, 0.5, 2.0, 10.0][i % 5]
        fare = 30.0 if i == 2 else 3.0 + i
        pickup = start + dt.timedelta(days=i % 10)
        data.append((f"trip_{i}", "V1", pickup, pickup + dt.timedelta(minutes=i), 1, distance, fare, fare * 1.5, "CARD"))
    spark.createDataFrame(data, TAXI_TRIPS).write.option("header", True).csv(str(tmp_path / "raw"))
    taxi.run(spark, str(tmp_path / "raw"), "taxi_test")
    assert spark.catalog.currentDatabase() == "taxi_test"
    assert taxi.layer_counts(spark).first().asDict() == {"bronze_count": 50, "silver_clean_count": 30}
    assert taxi.bad_trips(spark).first()[0] == 0
    clean = spark.table(values.TAXI_CLEAN)
    assert clean.where("trip_id = 'trip_7'").first()["ride_duration_min"] == 7.0
    assert clean.where("trip_id = 'trip_4'").first()["fare_per_km"] == pytest.approx(0.7)
    flagged = spark.table(values.TAXI_SUSPICIOUS)
    want = [d for d in data if d[5] > 0 and (d[6] / d[5] > 10 or (d[5] < 1 and d[6] > 25))]
    assert flagged.where("is_suspicious_ride").count() == len(want)
    weeks = rows(spark.table(values.TAXI_WEEKLY), "week_start", "total_trips")
    assert [str(week) for week, _ in weeks] == ["2024-01-01", "2024-01-08"] and sum(n for _, n in weeks) == 30
    assert rows(spark.table(values.TAXI_TOP), "rank", "trip_id") == [(1, "trip_49"), (2, "trip_48"), (3, "trip_47")]
    taxi.run(spark, str(tmp_path / "raw"), "taxi_test")
    assert spark.table(values.TAXI_BRONZE).count() == 50
    spark.catalog.setCurrentDatabase("default")


def test_stored_folders_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """Also where a task meets more folders than it may hold open; the session's own number comes back."""
    name, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    write = DataFrameWriter.parquet

    def noted(writer, path, *args, **kwargs):
        seen.append((path, spark.conf.get(name)))
        return write(writer, path, *args, **kwargs)
    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    store = VersionedTable(spark, str(tmp_path / "t"), ("part",))
    store.create(spark.range(0, 400, 1, 1).selectExpr("id", "id % 80 AS part"))
    assert [n for path, n in seen if "/data/" in path] == ["32"] and spark.conf.get(name) == "0"
    assert rows(store.read(), "id") == [(i,) for i in sorted(range(400), key=str)]


def test_managed_tables(spark):
    writers.use_database(spark, "sink_test")
    wide = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "id int, k string, extra double")
    writers.overwrite_table(wide, "t")
    writers.append_table(wide, "t")
    assert spark.table("t").count() == 4
    writers.overwrite_keeping_columns(spark.createDataFrame([(9, "z", True)], "id int, k string, flag boolean"), "t")
    assert spark.table("t").columns == ["id", "k", "extra", "flag"]
    assert rows(spark.table("t")) == [(9, "z", None, True)]
    writers.overwrite_table(wide, "p", ("k",))
    assert rows(writers.table_partitions(spark, "p")) == [("k=a",), ("k=b",)]
    assert {"t", "p"} <= {row["tableName"] for row in writers.tables(spark).collect()}
    assert "parquet" in {row["data_type"] for row in writers.table_detail(spark, "p").collect()}
    assert writers.shape(spark.table("p")) == (2, 3) and writers.preview(spark.table("p"), 1).count() == 1
    assert not writers.create_table_if_absent(spark, "p", wide.schema)
    assert writers.create_table_if_absent(spark, "p", wide.schema, reset=True) and spark.table("p").count() == 0
    writers.drop_table(spark, "p")
    assert not spark.catalog.tableExists("p")
    spark.catalog.setCurrentDatabase("default")


def test_malformed_fields_become_null(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,n\n1,5\n2,1299.0\n3,abc\n")
    assert rows(readers.read_csv(spark, str(tmp_path), table("id int, n int"))) == [(1, 5), (2, None), (3, None)]


def test_path_tables_and_scratch(spark, tmp_path):
    path = str(tmp_path / "made")
    assert writers.create_if_absent(spark, path, RUN_LOG) and not writers.create_if_absent(spark, path, RUN_LOG)
    assert spark.read.parquet(path).count() == 0
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir", "/"))


def test_run_log(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    log.create()
    with log.run("bronze", "bronze") as run:
        run.processed = 7
    with pytest.raises(KeyError):
        with log.run("silver", "silver") as run:
            run.processed = 5
            raise KeyError("lost")
    with log.run("silver", "silver") as run:
        run.processed, run.rejected = 6, 2
    table_ = log.read()
    assert rows(table_, "pipeline_name", "status", "records_processed", "records_rejected", "error_message") == [
        ("bronze", "SUCCESS", 7, 0, ""), ("silver", "FAILED", 0, 0, "'lost'"), ("silver", "SUCCESS", 6, 2, "")]
    assert runlog.latest_run(table_).first()["records_rejected"] == 2
    assert runlog.failed_runs(table_).count() == 1 and runlog.of_layer(table_, "bronze").count() == 1
    assert table_.where("end_time < start_time").count() == 0


def test_file_stream_runs_once_per_file(spark, tmp_path):
    schema = table("id int, k string")
    raw, out, checkpoint = (str(tmp_path / name) for name in ("raw", "out", "ck"))
    first = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    first.write.option("header", True).csv(raw)
    for want in (2, 2):
        loads.append_available(loads.stream_csv(spark, raw, schema), out, checkpoint)
        assert spark.read.schema(schema).parquet(out).count() == want
    first.withColumn("id", F.col("id") + 10).write.mode("append").option("header", True).csv(raw)
    loads.append_available(loads.stream_csv(spark, raw, schema), out, checkpoint)
    assert rows(spark.read.schema(schema).parquet(out), "id") == [(1,), (11,), (12,), (2,)]


def test_latest_rows_are_merged_once_in_a_call(spark, tmp_path):
    """However many batches there are, the table gets one version, and a second call what is new."""
    raw, checkpoint, schema = str(tmp_path / "raw"), str(tmp_path / "cp"), "k long, at long, what string, part int"
    table = VersionedTable(spark, str(tmp_path / "table"), ("part",))
    read = lambda: sorted(map(tuple, table.read().collect()), key=str)

    def add(rows):
        spark.createDataFrame(rows, schema).repartition(len(rows)).write.mode("append").option("header", True).csv(raw)
        stream = loads.stream_csv(spark, raw, StructType.fromDDL(schema), files_per_batch=1)
        loads.stream_latest(stream, table, checkpoint, ["k"], ["at"])
    table.create_if_absent(StructType.fromDDL(schema))
    add([(1, 1, "a", 0), (1, 3, "b", 1), (1, 2, "c", 0), (2, 1, "d", 0), (3, 9, "e", 1), (None, 1, "x", 0)])
    assert table.latest_version() == 1
    assert read() == sorted([(1, 3, "b", 1), (2, 1, "d", 0), (3, 9, "e", 1), (None, 1, "x", 0)], key=str)
    add([(2, 5, "f", 1), (3, 4, "g", 0), (4, 1, "h", 0)])
    assert table.latest_version() == 2
    assert read() == sorted([(1, 3, "b", 1), (2, 5, "f", 1), (3, 9, "e", 1), (4, 1, "h", 0), (None, 1, "x", 0)], key=str)
    # What a failed call left behind is merged by the next one.
    spark.createDataFrame([(4, 2, "i", 0)], schema).write.parquet(f"{table.root}/pending/_stream=s/_batch=0")
    add([(5, 1, "j", 0)])
    assert (4, 2, "i", 0) in read() and (5, 1, "j", 0) in read() and len(read()) == 6
