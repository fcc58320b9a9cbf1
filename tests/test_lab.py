"""The sales lab: exploration figures and the mini ETL, on an eight-row file."""

import datetime as dt
import json

import pytest
from conftest import rows

from tallymill.fixed_values import HIGH_VALUE_TOTAL
from tallymill.operators import aggregate, clean, dedup
from tallymill.operators.describe import describe
from tallymill.plans import lab
from tallymill.schemas import LAB_SALES
from tallymill.sources.readers import read_csv

CSV = """\
transaction_id,store_id,store_name,date,product_id,product_name,quantity,unit_price,total,customer_id,promo_code
71,4,Harbour,2024-03-04,31,Lamp,1,12.25,12.25,900,
72,4,Harbour,2024-03-04,32,Bell,3,2.50,7.50,,SPRING
73,5,Station,2024-03-05,33,Chain,2,2.50,5.00,901,
74,5,Station,2024-03-06,31,Lamp,2,12.25,24.50,902,SPRING
75,6,Market,2024-03-06,32,Bell,1,2.50,2.50,900,
76,6,Market,2024-03-07,34,Tape,4,0.75,3.00,,
77,4,Harbour,2024-03-08,33,Chain,6,2.50,15.00,903,
78,6,Market,2024-03-09,32,Bell,1,2.50,2.50,904,LOYAL
"""


@pytest.fixture()
def path(tmp_path):
    file = tmp_path / "sales.csv"
    file.write_text(CSV)
    return str(file)


@pytest.fixture()
def sales(spark, path):
    return read_csv(spark, path, LAB_SALES)


def test_declared_types_equal_inferred_types_but_for_the_date(spark, path, sales):
    inferred = {f.name: f.dataType.typeName() for f in read_csv(spark, path).schema.fields}
    declared = {f.name: f.dataType.typeName() for f in sales.schema.fields}
    assert inferred.keys() == declared.keys()
    assert {n for n in declared if (inferred[n], declared[n]) != ("integer", "long") and inferred[n] != declared[n]} == {"date"}


def test_sums_and_mean(sales):
    assert rows(aggregate.sum_by_key(sales, "store_name", "total", "revenue")) == [
        ("Harbour", 34.75), ("Market", 8.0), ("Station", 29.5)]
    assert rows(aggregate.sum_by_key(sales, "product_name", "total", "revenue")) == [
        ("Bell", 12.5), ("Chain", 20.0), ("Lamp", 36.75), ("Tape", 3.0)]
    assert aggregate.mean_of(sales, "quantity", "mean").first()[0] == 2.5


def test_filters(sales):
    assert rows(clean.above(sales, "total", HIGH_VALUE_TOTAL), "transaction_id") == [(71,), (72,), (74,), (77,)]
    assert clean.slicer(sales, store_name=["Market"], promo_code=None).count() == 3


def test_distinct_stores(sales):
    assert rows(dedup.distinct_values(sales, "store_name")) == [("Harbour",), ("Market",), ("Station",)]


def test_null_counts(sales):
    counts = dict(rows(aggregate.null_counts(sales)))
    assert {name for name, n in counts.items() if n} == {"customer_id", "promo_code"}
    assert (counts["customer_id"], counts["promo_code"]) == (2, 5)


def test_describe(sales):
    result = {row["measure"]: row for row in describe(sales, ["quantity", "total", "unit_price"]).collect()}
    expected = {
        "quantity": (8, 2.5, 1.772811, 1, 1.0, 2.0, 3.25, 6),
        "total": (8, 9.03125, 7.797020, 2.5, 2.875, 6.25, 12.9375, 24.5),
        "unit_price": (8, 4.71875, 4.687440, 0.75, 2.5, 2.5, 4.9375, 12.25),
    }
    for measure, figures in expected.items():
        got = [result[measure][c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        assert got == pytest.approx(figures, abs=1e-6)


def test_mini_etl_writes_json_records(spark, path, tmp_path):
    out = tmp_path / "json"
    lab.run(spark, path, str(out))
    records = [json.loads(line) for file in out.glob("part-*") for line in file.read_text().splitlines()]
    assert len(records) == 8
    by_id = {record["transaction_id"]: record for record in records}
    midnight = dt.datetime(2024, 3, 7, tzinfo=dt.timezone.utc)
    assert by_id[76] == {
        "transaction_id": 76, "store_id": 6, "store_name": "Market", "date": int(midnight.timestamp() * 1000),
        "product_id": 34, "product_name": "Tape", "quantity": 4, "unit_price": 0.75, "total": 3.0,
        "customer_id": 0, "promo_code": "NO CODE",
    }
    assert by_id[78]["promo_code"] == "LOYAL"
