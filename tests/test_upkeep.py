"""Gold kept up to date from changes, malformed lines, partition reloads, buckets and stateful streams."""

import random

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from tallymill.operators import maintained
from tallymill.operators.bucketed import BucketedTable
from tallymill.operators.dedup import latest_per_key
from tallymill.operators.maintained import Measures
from tallymill.operators.versioned import VersionedTable
from tallymill.schemas import table
from tallymill.sinks import writers
from tallymill.sources import readers
from tallymill.streaming import loads, stateful
from test_medallion import HEADER, house, raw  # noqa: F401

FACTS = table("id int, grp string, price double, n int")


def _measures():
    return {"grp": F.col("grp")}, Measures({"n": F.col("n").cast("long")}, {"priced": F.col("price")}, {"price": F.col("price")})


def _brute(data):
    out = {}
    for _, grp, price, n in data:
        prices, numbers, count = out.setdefault(grp, ([], [], 0))
        out[grp] = (prices + [price] * (price is not None), numbers + [n] * (n is not None), count + 1)
    return sorted(((g, c, sum(ns) if ns else None, len(ps), min(ps, default=None), max(ps, default=None)) for g, (ps, ns, c) in out.items()), key=str)


def test_state_follows_changes(spark, tmp_path):
    rand = random.Random(1)
    data = [(i, rand.choice(["a", "b", None, "hot", "hot", "hot"]), rand.choice([None, 1.0, 2.0, float(i)]), rand.choice([None, 1, i])) for i in range(120)]
    keys, measures = _measures()
    state = maintained.summary(spark.createDataFrame(data, FACTS), keys, measures)
    for step in range(4):
        # Some rows go, the lowest and highest prices among them; some come; some are in both sets.
        known = [r for r in data if r[2] is not None]
        gone = rand.sample(data, 15) + [min(known, key=lambda r: r[2]), max(known, key=lambda r: r[2])]
        gone = list({r[0]: r for r in gone}.values())
        new = [(1000 * step + 500 + i, rand.choice(["a", "new", None]), rand.choice([None, 0.5, 700.0]), rand.choice([None, 3])) for i in range(6)]
        carried = rand.sample([r for r in data if r not in gone], 10)
        if step == 3:  # a whole group goes
            gone += [r for r in data if r[1] == "b" and r not in gone]
            carried = [r for r in carried if r[1] != "b"]
        data = [r for r in data if r not in gone] + new
        frames = [spark.createDataFrame(x, FACTS) for x in (gone + carried, new + carried, data)]
        state = maintained.refreshed(state, *frames, keys, measures)
        state.write.parquet(str(tmp_path / str(step)))
        state = spark.read.parquet(str(tmp_path / str(step)))
        shown = maintained.plain_sums(state, measures)
        assert sorted(rows(shown, "grp", "_rows", "n", "priced", "least_price", "most_price"), key=str) == _brute(data), step


def test_facts_are_read_only_for_a_lost_extreme(spark):
    keys, measures = _measures()
    state = maintained.summary(spark.createDataFrame([(1, "a", 1.0, 1), (2, "a", 5.0, 1)], FACTS), keys, measures)
    unread = spark.createDataFrame([(0,)], "x int").select(F.lit(0).alias("id"), F.lit("a").alias("grp"), F.raise_error(F.lit("facts were read")).cast("double").alias("price"), F.lit(1).alias("n"))
    added = spark.createDataFrame([(3, "a", 9.0, 4)], FACTS)
    same = maintained.refreshed(state, added.limit(0), added, unread, keys, measures)
    assert rows(same, "_rows", "n", "least_price", "most_price") == [(3, 6, 1.0, 9.0)]
    gone = spark.createDataFrame([(1, "a", 1.0, 1)], FACTS)
    with pytest.raises(Exception, match="facts were read"):
        maintained.refreshed(state, gone, gone.limit(0), unread, keys, measures).collect()


def test_unchanged_partitions_are_not_read(spark, tmp_path):
    store = VersionedTable(spark, str(tmp_path / "t"), ("part",))
    store.create(spark.range(0, 100).select("id", (F.col("id") % 10).cast("string").alias("part")))
    store.upsert(spark.createDataFrame([(3, "3"), (203, "3")], "id long, part string"), ["id"])
    gone, new = store.changed_rows(0, 1)
    assert {r[0] for r in gone.select("part").distinct().collect()} == {r[0] for r in new.select("part").distinct().collect()} == {"3"}
    assert all("/part=3/" in name for name in [*gone.inputFiles(), *new.inputFiles()])


GOLD = ["daily_sales", "monthly_sales", "monthly_region_sales", "product_performance", "category_performance", "store_performance"]


def test_gold_from_changes_equals_gold_built_anew(house, raw, monkeypatch):  # noqa: F811
    for number in range(1, 5):
        house.ingest(str(raw / f"day{number}.csv"))
        house.refresh_silver()
        house.refresh_gold()
        kept = {name: rows(house.gold(name)) for name in GOLD}
        prices = rows(house.gold("product_prices"))
        house.build_gold()
        assert kept == {name: rows(house.gold(name)) for name in GOLD}, number
        by_product = house.silver().groupBy("product_id").agg(F.min("unit_price"), F.max("unit_price"))
        assert prices == rows(by_product), number
    # A run that breaks off before the end leaves the sums that the next one starts from.
    house.sales.delete("transaction_id = 'A7'")
    with monkeypatch.context() as patched:
        patched.setattr(house, "_write_gold", lambda *args: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            house.refresh_gold()
    house.refresh_gold()
    assert dict(rows(house.gold("daily_sales"), "sales_date", "total_transactions")) == dict(rows(house.silver().groupBy(F.to_date("transaction_timestamp").alias("d")).agg(F.count("*").alias("n")), "d", "n"))
    house.refresh_gold()  # nothing has changed


def test_malformed_lines_reach_the_quarantine_with_their_text(house, tmp_path):  # noqa: F811
    folder = tmp_path / "days"
    folder.mkdir()
    good = "G1,2024-06-10 10:00:00,H1,B10,1,40,0,40,EUR"
    broken = ["S1,2024-06-10 10:00:00,H1", good.replace("G1", "L1") + ",more,and more", good.replace("G1", "T1").replace(",1,40", ",one,40"), "D1,not a day,H1,B10,1,40,0,40,EUR"]
    (folder / "sales.csv").write_text(HEADER + "\n".join([good, *broken]) + "\n")
    assert house.ingest(str(folder)) == 1
    assert house.refresh_silver() == (1, 0)
    lines = house.rejected()
    assert rows(lines, "raw_line") == sorted((line,) for line in broken)
    assert {tuple(r["reject_reasons"]) for r in lines.collect()} == {("malformed_line",)}
    assert rows(lines.select(F.element_at(F.split("source_file", "/"), -1).alias("f")).distinct()) == [("sales.csv",)]
    assert rows(house.log.read().where("layer = 'bronze'"), "records_processed", "records_rejected") == [(1, 4)]
    loads_before = house.rejected().count()
    loads.run_available(loads.with_load_metadata(loads.stream_csv(house.spark, str(folder), loads.RAW_SALES, checked=True), "s"), str(tmp_path / "cp"), lambda batch, number: house.write_bronze(batch, f"stream-{number}"))
    assert house.rejected().count() == 2 * loads_before and house.bronze().count() == 2


def test_checked_csv_does_not_depend_on_the_columns_asked_for(spark, tmp_path):
    (tmp_path / "x.csv").write_text('id,n,k\n1,5,a\n2,1299.0,b\n3,7\n4,8,c,d\n5,9,"two\n6,1,e\n')
    checked = readers.read_csv_checked(spark, str(tmp_path), table("id int, n int, k string"))
    want = [(1, None), (2, "2,1299.0,b"), (3, "3,7"), (4, "4,8,c,d"), (5, None), (6, None)]
    assert rows(checked, "id", "raw_line") == want
    assert rows(readers.well_formed(checked), "id") == [(1,), (5,), (6,)]
    assert rows(readers.malformed(checked), "id") == [(2,), (3,), (4,)]
    with pytest.raises(ValueError):
        readers.read_csv_checked(spark, str(tmp_path), table("id int, raw_line string"))


def _files(folder):
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_ino) for p in folder.rglob("*.parquet")}


def test_partition_overwrite_leaves_other_partitions_alone(spark, tmp_path):
    rows_ = spark.createDataFrame([(i, f"d{i % 3}", None if i % 3 else "x") for i in range(12)], "id int, day string, note string")
    path = tmp_path / "t"
    writers.overwrite_partitions(rows_, str(path), ("day",))
    before = _files(path)
    part = spark.createDataFrame([(100, "d1", "n"), (101, "d9", "n")], rows_.schema)
    for _ in range(2):
        writers.overwrite_partitions(part, str(path), ("day",))
    after = _files(path)
    assert {k: v for k, v in before.items() if "day=d1" not in k} == {k: v for k, v in after.items() if "day=d0" in k or "day=d2" in k}
    assert rows(spark.read.parquet(str(path)).where("day in ('d1', 'd9')"), "id") == [(100,), (101,)]
    assert spark.read.parquet(str(path)).count() == 10


def test_partition_overwrite_of_a_managed_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS upkeep")
    writers.overwrite_table(spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string"), "upkeep.t", ("k",))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    writers.overwrite_table_partitions(spark.createDataFrame([("b", 20), ("c", 30)], "k string, id int"), "upkeep.t")
    assert rows(spark.table("upkeep.t"), "id", "k") == [(1, "a"), (20, "b"), (30, "c")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    writers.overwrite_table(spark.createDataFrame([(1,)], "id int"), "upkeep.plain")
    with pytest.raises(ValueError):
        writers.overwrite_table_partitions(spark.table("upkeep.plain"), "upkeep.plain")
    spark.sql("DROP DATABASE upkeep CASCADE")


@pytest.fixture()
def shuffled(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    for k in before:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_bucketed_upsert_shuffles_the_source_only(spark, shuffled):
    spark.sql("CREATE DATABASE IF NOT EXISTS buckets")
    store = BucketedTable(spark, "buckets.sales", ["id", "line"], 6)
    base = spark.createDataFrame([(i, 1, f"old{i}") for i in range(300)] + [(None, 1, "nobody's")], "id int, line int, v string")
    store.create(base)
    source = spark.createDataFrame([(7, 1, "new", 1.5), (7, 2, "other line", 2.5), (999, 1, "added", None), (None, 1, "also nobody's", 0.5)], "id int, line int, v string, extra double")
    plan = final_plan(store.merged(source))
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert plan.index("Exchange") > plan.index("SortMergeJoin")
    store.upsert(source)
    want = [(i, 1, f"old{i}", None) for i in range(300) if i != 7] + [(None, 1, "nobody's", None), (None, 1, "also nobody's", 0.5), (7, 1, "new", 1.5), (7, 2, "other line", 2.5), (999, 1, "added", None)]
    assert sorted(rows(store.read()), key=str) == sorted(want, key=str)
    store.upsert(source.limit(0))  # in the table's own buckets: still one shuffle, of no rows
    assert store.read().count() == len(want)
    with pytest.raises(ValueError):
        store.upsert(source.where("id = 7").unionAll(source.where("id = 7")))
    assert store.read().count() == len(want)
    assert len(spark.sql("SHOW TABLES IN buckets").where("tableName like 'sales_%'").collect()) == 1
    store.drop()
    assert spark.sql("SHOW TABLES IN buckets").isEmpty()
    spark.sql("DROP DATABASE buckets CASCADE")


def test_a_failed_upsert_changes_nothing(spark, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS buckets2")
    store = BucketedTable(spark, "buckets2.t", ["id"], 2)
    store.create(spark.createDataFrame([(1, "a")], "id int, v string"))
    monkeypatch.setattr(store, "_switch", lambda written: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.upsert(spark.createDataFrame([(1, "b")], "id int, v string"))
    assert rows(store.read()) == [(1, "a")]
    monkeypatch.undo()
    store.upsert(spark.createDataFrame([(1, "c")], "id int, v string"))
    assert rows(store.read()) == [(1, "c")]
    spark.sql("DROP DATABASE buckets2 CASCADE")


EVENTS = table("id int, k string, v double, ts timestamp")


def _event_files(spark, folder, batches):
    for n, batch in enumerate(batches):
        frame = spark.createDataFrame([(i, k, v) for i, k, v, _ in batch], "id int, k string, v double")
        stamps = spark.createDataFrame([(i, ts) for i, _, _, ts in batch], "id int, t string").select("id", F.col("t").cast("timestamp").alias("ts"))
        frame.join(stamps, "id").select(*EVENTS.names).coalesce(1).write.mode("append").option("header", True).csv(str(folder))


@pytest.mark.parametrize("files", [1, 5])
def test_stateful_latest_equals_the_batch_result(spark, tmp_path, files):
    rand = random.Random(2)
    batches = [[(100 * b + i, rand.choice("abcdef"), rand.random(), f"2024-06-{rand.randint(1, 9):02d} {rand.randint(0, 23):02d}:00:00") for i in range(20)] for b in range(5)]
    _event_files(spark, tmp_path / "in", batches)
    stream = loads.stream_csv(spark, str(tmp_path / "in"), EVENTS, files_per_batch=files)
    out, keys, newest = str(tmp_path / "out"), ["k"], ["ts", "id"]
    query = stateful.stream_latest_stateful(stream, out, str(tmp_path / "cp"), keys, newest, "ts", "30 days")
    want = latest_per_key(readers.read_csv(spark, str(tmp_path / "in"), EVENTS), keys, newest)
    assert rows(stateful.read_latest(spark, out, EVENTS, keys, newest)) == rows(want)
    # No batch scans anything but its new files: each input row is read once.
    assert sum(p["numInputRows"] for p in query.recentProgress) == 100
    again = loads.stream_csv(spark, str(tmp_path / "in"), EVENTS, files_per_batch=files)
    stateful.stream_latest_stateful(again, out, str(tmp_path / "cp"), keys, newest, "ts", "30 days")
    assert rows(stateful.read_latest(spark, out, EVENTS, keys, newest)) == rows(want)
    stateful.fold_latest(spark, out, str(tmp_path / "folded"), EVENTS, keys, newest)
    assert rows(spark.read.schema(EVENTS).parquet(str(tmp_path / "folded"))) == rows(want)


def test_old_periods_leave_the_state_and_late_rows_are_dropped(spark, tmp_path):
    days = [[(d, "a", float(d), f"2024-06-{d:02d} 12:00:00")] for d in (1, 10, 20)] + [[(99, "late", 0.0, "2024-06-02 12:00:00"), (98, "b", 0.0, "2024-06-19 12:00:00")]]
    for day in days:
        _event_files(spark, tmp_path / "in", [day])
        stream = loads.stream_csv(spark, str(tmp_path / "in"), EVENTS)
        query = stateful.stream_latest_stateful(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ["k"], ["ts"], "ts", "2 days")
    assert rows(stateful.read_latest(spark, str(tmp_path / "out"), EVENTS, ["k"], ["ts"]), "id", "k") == [(20, "a"), (98, "b")]
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held[-1] <= 2


def test_sums_without_extremes_are_not_written_on_the_way(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a scratch table")
    monkeypatch.setattr(maintained, "scratch_path", refuse)
    keys, measures = {"k": F.col("k")}, maintained.Measures({"total": F.col("v")}, {"some": F.col("v")})
    rows = spark.createDataFrame([(1, 5), (1, 7), (2, 1), (None, None)], "k long, v long")
    gone, new = rows.where("k = 1 and v = 5 or k = 2"), spark.createDataFrame([(3, 4)], "k long, v long")
    now = rows.exceptAll(gone).unionByName(new)
    got = maintained.refreshed(maintained.summary(rows, keys, measures), gone, new, now, keys, measures)
    assert sorted(map(tuple, got.select("k", "_rows", "some").collect()), key=str) == [(1, 1, 1), (3, 1, 1), (None, 1, 0)]
