"""Day-by-day replay of the retail medallion against hand-derived tables."""

import pytest
from conftest import rows

from tallymill.operators import versioned
from tallymill.plans import medallion
from tallymill.plans.medallion import RetailLakehouse
from tallymill.streaming.loads import stream_medallion

HEADER = "transaction_id,transaction_timestamp,store_id,product_id,quantity,unit_price,discount,total_amount,currency\n"
PRODUCTS = """\
product_id,product_name,category,brand,standard_price
B10,Lamp,Lights,Glow,40
B20,Bell,Sound,Ding,10
B30,Chain,Drive,Link,25
B40,Saddle,Comfort,Sit,80
,Nameless,None,None,1
B30,Chain,Drive,Link,25
"""
STORES = """\
store_id,store_name,region,country
H1,Harbour,Coast,Freeland
H2,Station,Centre,Freeland
H3,Market,Centre,Oldland
"""
# Day 1 has an exact copy, wrong totals, an unknown store, a missing product and a zero quantity; day 2
# re-sends a sale changed; day 3 brings a late row; day 4 unknown stores and a row too late for the look-back.
DAYS = ["""\
A1,2024-06-10 10:00:00,H1,B10,2,40,5,0,EUR
A2,2024-06-10 10:30:00,H2,B20,4,10,0,40,EUR
A3,2024-06-10 11:00:00,H1,B30,1,25,0,25,EUR
A3,2024-06-10 11:00:00,H1,B30,1,25,0,25,EUR
A4,2024-06-10 11:30:00,H9,B10,1,40,0,40,EUR
A5,2024-06-10 12:00:00,H2,,1,10,0,10,EUR
A6,2024-06-10 12:30:00,H3,B99,0,5,0,0,EUR
A7,2024-06-10 13:00:00,H3,B20,3,10,2,99,EUR
""", """\
A8,2024-06-11 09:00:00,H3,B40,1,80,8,72,EUR
A9,2024-06-11 09:30:00,H1,B10,1,40,0,40,EUR
A2,2024-06-11 10:30:00,H2,B20,5,10,0,50,EUR
""", """\
A10,2024-06-12 08:00:00,H2,B30,2,25,10,40,EUR
A0,2024-06-10 08:00:00,H1,B20,1,10,0,10,EUR
""", """\
C1,2024-06-13 09:00:00,Z1,B10,5,12.5,1,0,EUR
C2,2024-06-13 09:05:00,Z2,B10,-4,7.5,2,0,EUR
C3,2024-06-01 09:00:00,H1,B10,1,40,0,40,EUR
"""]
SILVER_IDS = sorted(["A0", "A1", "A2", "A3", "A7", "A8", "A9", "A10"])


@pytest.fixture()
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for number, text in enumerate(DAYS, start=1):
        (folder / f"day{number}.csv").write_text(HEADER + text)
    (tmp_path / "products.csv").write_text(PRODUCTS)
    (tmp_path / "stores.csv").write_text(STORES)
    return folder


@pytest.fixture()
def house(spark, tmp_path, raw):
    made = RetailLakehouse(spark, str(tmp_path / "house"))
    made.create()
    made.load_products(str(tmp_path / "products.csv"))
    made.load_stores(str(tmp_path / "stores.csv"))
    return made


def test_years_are_written_without_a_shuffle(spark, tmp_path, raw, monkeypatch):
    """Bronze, silver and quarantine by year: no exchange gathers the folders, and the rows are those of a house by day."""
    found = []
    for period in ("day", "year"):
        made = RetailLakehouse(spark, str(tmp_path / period), period=period)
        made.create()
        made.load_products(str(tmp_path / "products.csv"))
        made.load_stores(str(tmp_path / "stores.csv"))
        for day in (1, 2, 3, 4):
            made.ingest(str(raw / f"day{day}.csv"))
            made.refresh_silver()
        found.append((rows(made.silver().drop("ingestion_timestamp")), rows(made.rejected().drop("ingestion_timestamp"))))
        for module in (medallion, versioned):
            monkeypatch.setattr(module, "sized_for_write", None)
    assert found[0] == found[1] and _ids(made.silver()) == SILVER_IDS


def test_masters_are_clean(house):
    assert rows(house.products(), "product_id") == [("B10",), ("B20",), ("B30",), ("B40",)]
    assert house.stores().count() == 3


def _ids(df):
    return sorted(row[0] for row in df.select("transaction_id").collect())


def test_replay_day_by_day(house, raw):
    seen = []
    for number in range(1, 5):
        loaded = house.ingest(str(raw / f"day{number}.csv"))
        valid, rejected = house.refresh_silver()
        seen.append((loaded, valid, rejected, house.silver().count(), house.rejected().count()))
    assert seen == [(8, 4, 3, 4, 3), (3, 6, 3, 6, 3), (2, 8, 3, 8, 3), (3, 8, 5, 8, 5)]
    assert _ids(house.silver()) == SILVER_IDS

    totals = dict(rows(house.silver(), "transaction_id", "total_amount"))
    assert (totals["A1"], totals["A7"], totals["A2"]) == (75.0, 28.0, 50.0)
    moved = house.silver().where("transaction_id = 'A2'").selectExpr("CAST(transaction_timestamp AS STRING)")
    assert moved.first()[0] == "2024-06-11 10:30:00"

    reasons = dict(rows(house.rejected(), "transaction_id", "reject_reasons"))
    assert reasons["A4"] == ["unknown_store_id"]
    assert reasons["A5"] == ["unknown_product_id"]
    assert reasons["A6"] == ["unknown_product_id", "quantity_not_positive"]
    assert reasons["C2"] == ["unknown_store_id", "quantity_not_positive"]

    _check_gold(house)

    # Same input again: nothing changes.
    before = rows(house.silver()), rows(house.rejected())
    assert house.refresh_silver() == (8, 5)
    assert (rows(house.silver()), rows(house.rejected())) == before

    log = house.log.read()
    assert log.where("status = 'SUCCESS'").count() == log.count() == 9


def _check_gold(house):
    house.build_gold()
    assert [(str(day), *rest) for day, *rest in rows(house.gold("daily_sales"))] == [
        ("2024-06-10", 138.0, 7, 4), ("2024-06-11", 162.0, 7, 3), ("2024-06-12", 40.0, 2, 1)]
    assert rows(house.gold("monthly_sales")) == [(2024, 6, 340.0, 16, 8)]
    assert rows(house.gold("monthly_region_sales")) == [
        (2024, 6, "Centre", "Freeland", 90.0, 7), (2024, 6, "Centre", "Oldland", 100.0, 4), (2024, 6, "Coast", "Freeland", 150.0, 5)]
    product = house.gold("product_performance")
    assert rows(product, "product_id", "total_revenue", "total_quantity", "avg_unit_price") == [
        ("B10", 115.0, 3, 40.0), ("B20", 88.0, 9, 10.0), ("B30", 65.0, 3, 25.0), ("B40", 72.0, 1, 80.0)]
    assert rows(house.gold("category_performance")) == [
        ("Comfort", 72.0, 1, 1), ("Drive", 65.0, 3, 2), ("Lights", 115.0, 3, 2), ("Sound", 88.0, 9, 3)]
    store = house.gold("store_performance")
    assert rows(store, "store_id", "total_revenue", "total_quantity", "total_transactions") == [
        ("H1", 150.0, 5, 4), ("H2", 90.0, 7, 2), ("H3", 100.0, 4, 2)]


def test_whole_folder_at_once_accepts_the_oldest_row_too(house, raw):
    assert house.ingest(str(raw)) == 16
    house.refresh_silver()
    assert _ids(house.silver()) == sorted([*SILVER_IDS, "C3"])


def test_gold_keeps_a_column_the_new_result_lacks(house, raw, spark):
    from pyspark.sql import functions as F

    house.ingest(str(raw / "day1.csv"))
    house.refresh_silver()
    house.build_gold()
    wider = house.gold("daily_sales").withColumn("note", F.lit("kept"))
    wider.write.mode("overwrite").parquet(f"{house.root}/gold/wide")
    spark.read.parquet(f"{house.root}/gold/wide").write.mode("overwrite").parquet(f"{house.root}/gold/daily_sales")
    house.build_gold()
    assert rows(house.gold("daily_sales"), "total_revenue", "note") == [(168.0, None)]


def test_folder_read_again_grows_bronze_but_not_silver(house, raw):
    house.ingest(str(raw))
    house.refresh_silver()
    before = rows(house.silver(), "transaction_id", "total_amount")
    house.ingest(str(raw))
    house.refresh_silver()
    assert house.bronze().count() == 32
    assert rows(house.silver(), "transaction_id", "total_amount") == before


def test_stream_takes_new_files_only(house, raw, tmp_path):
    late = raw / "day4.csv"
    text = late.read_text()
    late.unlink()
    checkpoint = str(tmp_path / "checkpoint")
    stream_medallion(house, str(raw), checkpoint)
    assert (house.bronze().count(), house.silver().count(), house.rejected().count()) == (13, 8, 3)
    stream_medallion(house, str(raw), checkpoint)
    assert house.bronze().count() == 13
    late.write_text(text)
    stream_medallion(house, str(raw), checkpoint, recheck=True)
    assert (house.bronze().count(), house.silver().count(), house.rejected().count()) == (16, 8, 5)
    assert _ids(house.silver()) == SILVER_IDS


def test_a_load_repeated_under_its_id_replaces_itself(house, spark, raw):
    from tallymill.schemas import RAW_SALES
    from tallymill.sources.readers import read_csv, with_load_metadata

    day = with_load_metadata(read_csv(spark, str(raw / "day1.csv"), RAW_SALES), "csv")
    house.write_bronze(day, "stream-0")
    house.write_bronze(day, "stream-0")
    assert house.bronze().count() == 8
    source = house.bronze().select("source_system", "source_file").distinct().first()
    assert source[0] == "csv" and source[1].endswith("/raw/day1.csv")


def test_create_keeps_state_unless_reset(house, raw):
    house.ingest(str(raw / "day1.csv"))
    house.refresh_silver()
    house.create()
    assert house.silver().count() == 4
    house.create(reset=True)
    assert house.silver().count() == 0 and house.log.read().count() == 0


def test_rows_without_id_are_quarantined_once(house, tmp_path):
    file = tmp_path / "no_id.csv"
    file.write_text(HEADER + ",2024-06-10 10:00:00,H1,B10,1,40,0,40,EUR\n" * 2)
    for _ in range(2):
        house.ingest(str(file))
        assert house.refresh_silver() == (0, 1)
    assert rows(house.rejected(), "transaction_id", "reject_reasons") == [(None, ["missing_transaction_id"])]
    assert house.silver().count() == 0


def test_failed_run_is_logged_and_raised(house, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        house.ingest(str(tmp_path / "absent"))
    record = house.log.read().first()
    assert (record["status"], record["records_processed"], record["records_rejected"]) == ("FAILED", 0, 0)
    assert "PATH_NOT_FOUND" in record["error_message"]


def test_different_rows_without_id_all_reach_the_quarantine(house, tmp_path):
    file = tmp_path / "no_ids.csv"
    file.write_text(HEADER + "".join(f",2024-06-10 1{n}:00:00,H1,B10,{n},40,0,40,EUR\n" for n in range(1, 5)))
    for _ in range(2):
        house.ingest(str(file))
        assert house.refresh_silver() == (0, 4)
        assert house.rejected().count() == 4


def _two_files(folder):
    folder.mkdir()
    for name, day in (("first", 9), ("second", 1)):
        (folder / f"{name}.csv").write_text(
            HEADER + f"T{day},2024-06-0{day} 10:00:00,H1,B10,1,40,0,40,EUR\nX{day},2024-06-0{day} 10:00:00,H9,B10,1,40,0,40,EUR\n")


@pytest.mark.parametrize("files", [None, 1])
def test_number_of_batches_changes_nothing(house, tmp_path, files):
    _two_files(tmp_path / "days")
    stream_medallion(house, str(tmp_path / "days"), str(tmp_path / "cp"), files_per_batch=files)
    assert (_ids(house.silver()), _ids(house.rejected())) == (["T1", "T9"], ["X1", "X9"])


def test_streamed_rows_older_than_the_look_back_are_quarantined(house, tmp_path):
    folder = tmp_path / "days"
    folder.mkdir()
    (folder / "one.csv").write_text(HEADER + "T9,2024-06-09 10:00:00,H1,B10,1,40,0,40,EUR\n")
    stream_medallion(house, str(folder), str(tmp_path / "cp"))
    (folder / "two.csv").write_text(HEADER + "T1,2024-06-01 10:00:00,H1,B10,1,40,0,40,EUR\n")
    stream_medallion(house, str(folder), str(tmp_path / "cp"))
    assert _ids(house.silver()) == ["T9"]
    assert rows(house.rejected(), "transaction_id", "reject_reasons") == [("T1", ["older_than_look_back"])]


def test_two_streams_keep_their_own_bronze_loads(house, tmp_path):
    for name in ("T1", "T2"):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "sales.csv").write_text(HEADER + f"{name},2024-06-10 10:00:00,H1,B10,1,40,0,40,EUR\n")
        stream_medallion(house, str(folder), str(tmp_path / f"cp-{name}"))
    assert _ids(house.bronze()) == _ids(house.silver()) == ["T1", "T2"]


def test_a_crash_between_the_two_upserts_loses_nothing(house, raw, monkeypatch):
    house.ingest(str(raw / "day1.csv"))
    for table in (house.sales, house.quarantine):
        with monkeypatch.context() as patched:
            patched.setattr(table, "upsert", lambda *args, **kwargs: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                house.refresh_silver()
        assert house.refresh_silver() == (4, 3)
        assert (house.silver().count(), house.rejected().count()) == (4, 3)
