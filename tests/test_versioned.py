"""Versioned tables: every change against a plain recomputation, and what it touches."""

import datetime as dt

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from tallymill.operators.versioned import VersionedTable
from tallymill.plans import order_book
from tallymill.schemas import ORDERS

COUNTRIES = ["US", "IN", "a b/c%d+[x]é"]


@pytest.fixture()
def orders(spark):
    start = dt.datetime(2025, 3, 1, 12)
    data = [
        (f"O{i}", start + dt.timedelta(days=i % 2), f"C{i % 5}", COUNTRIES[i % 3], float(i * 7 % 100), "X",
         ["CREATED", "PAID", "CANCELLED"][i % 4 % 3])
        for i in range(60)
    ]
    return order_book.with_order_date(spark.createDataFrame(data, ORDERS))


@pytest.fixture()
def book(spark, tmp_path, orders):
    table = order_book.open_book(spark, str(tmp_path / "book"))
    table.create(orders)
    return table


def test_create_and_read_back(book, orders):
    assert rows(book.read()) == rows(orders)
    assert book.latest_version() == 0


def test_update_rewrites_touched_folders_only(book, orders):
    book.update(order_book.paid_in("IN"), {"status": F.lit("CANCELLED")})
    hit = (F.col("country") == "IN") & (F.col("status") == "PAID")
    assert rows(book.read()) == rows(orders.withColumn("status", F.when(hit, "CANCELLED").otherwise(F.col("status"))))
    assert rows(book.read(0)) == rows(orders)
    entry = book.history().where("version = 1").first()
    assert entry["operation"] == "UPDATE"
    assert entry["rows_matched"] == orders.where(hit).count()
    assert entry["folders_rewritten"] == orders.where(hit).select("country", "order_date").distinct().count()
    kept = {name for name in book._version(1).folders if name.startswith("written_in=0-")}
    assert kept < book._version(0).folders and len(kept) == len(book._version(0).folders) - entry["folders_rewritten"]


def test_update_of_a_partition_column_moves_rows(book, orders):
    book.update("country = 'IN'", {"country": F.lit("XX")})
    assert rows(book.read()) == rows(orders.withColumn("country", F.when(F.col("country") == "IN", "XX").otherwise(F.col("country"))))
    assert "XX" in book.partition_values("country") and "IN" not in book.partition_values("country")


def test_null_condition_changes_nothing(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(spark.createDataFrame([(1, None), (2, 5.0), (3, 50.0)], "id int, amount double"))
    table.update("amount < 10", {"id": F.col("id") + 100})
    assert rows(table.read()) == [(1, None), (102, 5.0), (3, 50.0)]
    table.delete("amount < 10")
    assert rows(table.read()) == [(1, None), (3, 50.0)]


def test_change_without_matches_writes_no_rows(book, orders):
    book.delete("amount > 1e9")
    entry = book.history().where("version = 1").first()
    assert (entry["rows_matched"], entry["rows_written"], entry["folders_rewritten"]) == (0, 0, 0)
    assert rows(book.read()) == rows(orders)


def test_delete_everything_then_append(book, orders):
    book.delete("amount >= 0")
    assert book.read().count() == 0
    assert book.read().columns == orders.columns
    book.append(orders)
    assert rows(book.read()) == rows(orders)


def test_upsert_moves_rows_between_partitions(book, orders):
    source = orders.where("order_id IN ('O1', 'O2')").withColumn("country", F.lit("DE")).unionByName(
        orders.where("order_id = 'O3'").withColumn("order_id", F.lit("NEW"))
    )
    book.upsert(source, ["order_id"])
    want = orders.where("order_id NOT IN ('O1', 'O2')").unionByName(source)
    assert rows(book.read()) == rows(want)
    book.upsert(source, ["order_id"])
    assert rows(book.read()) == rows(want)
    assert rows(book.read(0)) == rows(orders)


def test_upsert_with_null_keys(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(spark.createDataFrame([(None, 1), (1, 1)], "id int, n int"))
    source = spark.createDataFrame([(None, 2)], "id int, n int")
    table.upsert(source, ["id"], null_safe=True)
    assert rows(table.read()) == [(None, 2), (1, 1)]
    table.upsert(source, ["id"])
    assert rows(table.read()) == [(None, 2), (None, 2), (1, 1)]


def test_upsert_rejects_repeated_keys(book, orders):
    with pytest.raises(ValueError, match="repeats"):
        book.upsert(orders.unionByName(orders), ["order_id"])
    assert book.latest_version() == 0


def test_append_evolves_schema(book, orders):
    wider = orders.limit(0).unionByName(orders).withColumn("order_id", F.concat(F.lit("N"), "order_id"))
    book.append(wider.withColumn("payment_method", F.lit("CARD")))
    now = book.read()
    assert now.columns == [*orders.columns, "payment_method"]
    assert now.where("payment_method IS NULL").count() == 60 == now.where("payment_method = 'CARD'").count()
    assert book.read(0).columns == orders.columns
    assert len(book._version(1).folders) == 2 * len(book._version(0).folders)


def test_life_cycle_and_compaction(spark, tmp_path, orders):
    later = orders.withColumns({
        "order_id": F.concat(F.lit("L"), "order_id"), "payment_method": F.lit("UPI"), "coupon_code": F.lit(None).cast("string"),
    }).drop("order_date")
    table = order_book.open_book(spark, str(tmp_path / "life"))
    assert order_book.life_cycle(table, orders.drop("order_date"), later, "US", "IN") == 5
    operations = [row[0] for row in table.history().orderBy("version").select("operation").collect()]
    assert operations == ["WRITE", "UPDATE", "APPEND", "UPDATE", "DELETE", "COMPACT"]
    assert rows(table.read(5)) == rows(table.read(4))
    assert table.read().where("amount < 10").count() == 0
    assert table.read().where("country = 'US' AND status = 'PAID' AND order_id NOT LIKE 'L%'").count() == 0
    assert table.read().where("country = 'US' AND status = 'PAID'").count() > 0


def test_diff(book, orders):
    book.update(order_book.paid_in("US"), {"status": F.lit("CANCELLED")})
    book.delete("order_id = 'O1'")
    changes = book.diff(0, 2, ["order_id"], ["status"])
    want = orders.where("country = 'US' AND status = 'PAID'").count()
    assert changes.where("change = 'update'").count() == want
    assert rows(changes.where("change = 'delete'"), "order_id") == [("O1",)]
    assert book.diff(2, 0, ["order_id"], ["status"]).where("change = 'insert'").count() == 1
    assert book.diff(1, 1, ["order_id"], ["status"]).count() == 0


def test_partition_filter_reaches_the_scan(book):
    plan = final_plan(book.read().where("country = 'IN' AND order_date = DATE '2025-03-01' AND amount > 3"))
    assert "PartitionFilters: [isnotnull(country" in plan
    assert "GreaterThan(amount,3.0)" in plan
    assert "Exchange" not in plan


def test_unfinished_version_is_invisible(book, orders, tmp_path):
    orders.write.parquet(str(tmp_path / "book" / "data" / "written_in=1"))
    assert book.latest_version() == 0
    assert rows(book.read()) == rows(orders)
    with pytest.raises(ValueError, match="no version 1"):
        book.read(1)
    book.delete("amount < 10")
    assert rows(book.read()) == rows(orders.where("amount >= 10"))


def test_second_writer_of_a_version_fails(book, orders):
    book.append(orders)
    state = book._version(0)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        book._commit(1, "WRITE", "", state.schema, state.folders, 0, 0, 0)


def test_a_lost_race_leaves_the_winner_readable(book, orders, spark, monkeypatch):
    loser = VersionedTable(spark, book.root, book.partition_by)
    monkeypatch.setattr(loser, "latest_version", lambda: 0)
    book.delete("amount < 10")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        loser.append(orders)
    assert rows(book.read()) == rows(orders.where("amount >= 10"))


def test_diff_across_a_schema_change(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "wider"))
    table.create(spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"))
    table.append(spark.createDataFrame([(3, "c", "new")], "id int, name string, note string"))
    table.update("id = 1", {"note": F.lit("late")})
    found = rows(table.diff(0, 2, ["id"], ["note"]), "id", "note_before", "note_after", "change")
    assert found == [(1, None, "late", "update"), (3, None, "new", "insert")]
