"""Retail medallion: raw CSV to bronze, validated silver with quarantine, gold tables.

The period is the date, the month or the year of sale, whichever gives partitions of a good size.
Everything lives below one root folder::

    bronze/sales/load=<id>/malformed=<b>/ingestion_date=<d>/transaction_period=<d>/
                                                 raw rows with load metadata; of malformed lines the text
    silver/{products,stores}                     cleansed masters (snapshots)
    silver/{sales,quarantine}                    versioned tables, partitioned like bronze
    gold/<name>                                  aggregates (snapshots)
    gold/state/<side>/<name>, gold/applied       sums that gold is kept up to date from, and the silver version in them
    logs                                         run log
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from tallymill.fixed_values import (
    BRONZE_LAYER, BRONZE_PIPELINE, LOOKBACK, SILVER_LAYER, SILVER_PIPELINE, SOURCE_SYSTEM,
)
from tallymill.functions.columns import first_of_month, first_of_year, holds, money
from tallymill.operators import gold
from tallymill.operators.clean import align_to, calibrate, normalise_sale_types
from tallymill.operators.dedup import latest_per_key, master_rows
from tallymill.operators.incremental import look_back_bound, not_before
from tallymill.operators.layout import COMPRESSION, open_folders, sized_for_write
from tallymill.operators.maintained import Measures, plain_sums, refreshed, summary
from tallymill.operators.validate import REASONS, VALID, flag_rows
from tallymill.operators.versioned import VersionedTable
from tallymill.plans.runlog import RunLog
from tallymill.schemas import BRONZE_SALES, PRODUCTS, RAW_SALES, SILVER_SALES, STORES, table
from tallymill.sinks.writers import overwrite_path, overwrite_path_keeping_columns
from tallymill.sources.readers import RAW_LINE, path_exists, read_csv, read_csv_checked, read_path, with_load_metadata

NEWEST_FIRST = ["ingestion_timestamp", "transaction_timestamp", "source_file"]
KEYS = ["transaction_id"]
_PERIOD = "transaction_period"
_LATE = "_late"
_PERIOD_FIELD = table(f"{_PERIOD} date").fields
_PERIODS = {"day": F.to_date, "month": first_of_month, "year": first_of_year}
_MALFORMED = "malformed"
_BRONZE = StructType(BRONZE_SALES.fields + _PERIOD_FIELD)
_BRONZE_STORED = StructType([*BRONZE_SALES.fields]).add(RAW_LINE, StringType()).add(_MALFORMED, "boolean").add(_PERIOD, "date")
_STORED_SALES = StructType(SILVER_SALES.fields + _PERIOD_FIELD)
_IDENTITY = "row_identity"
_STORED_REJECTS = StructType(SILVER_SALES.fields + _PERIOD_FIELD).add(REASONS, ArrayType(StringType())).add(_IDENTITY, "long")
TOO_LATE = "older_than_look_back"
MALFORMED_LINE = "malformed_line"


def _states() -> dict[str, tuple[dict[str, Column], Measures]]:
    """What gold is kept up to date from: sums that add up to every gold table's, and each product's price range."""
    sums = {"revenue": money("total_amount"), "quantity": F.col("quantity").cast("long"), "price_sum": money("unit_price")}
    counts = {"transactions": F.col("transaction_id"), "price_count": F.col("unit_price")}
    return {
        "store_day": ({"sales_date": F.to_date("transaction_timestamp"), "store_id": F.col("store_id")}, Measures(sums, counts)),
        "product": ({"product_id": F.col("product_id")}, Measures(sums, counts, {"price": F.col("unit_price")})),
    }


def flag_sales(sales: DataFrame, products: DataFrame, stores: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Mark each sale: known product, known store, positive quantity, an id to be known by."""
    return flag_rows(
        sales,
        {"product_id": products, "store_id": stores},
        {"missing_transaction_id": F.col("transaction_id").isNotNull(), "quantity_not_positive": F.col("quantity") > 0, **(rules or {})},
    )


class RetailLakehouse:
    def __init__(self, spark: SparkSession, root: str, lookback: str = LOOKBACK, period: str = "day"):
        self.spark = spark
        self.period_of = _PERIODS[period]
        self.root = root.rstrip("/")
        self.lookback = lookback
        self.log = RunLog(spark, f"{self.root}/logs")
        # Years are few and large: what a task holds of each is a file of its own, and no shuffle gathers them.
        self.few_folders = period == "year"
        self.sales = VersionedTable(spark, f"{self.root}/silver/sales", (_PERIOD,), self.few_folders)
        self.quarantine = VersionedTable(spark, f"{self.root}/silver/quarantine", (_PERIOD,), self.few_folders)

    def create(self, reset: bool = False) -> None:
        """Create absent tables; ``reset`` starts the silver tables and the log anew."""
        self.log.create(reset)
        self.sales.create_if_absent(_STORED_SALES, reset)
        self.quarantine.create_if_absent(_STORED_REJECTS, reset)

    # Masters ------------------------------------------------------------------------

    def load_products(self, csv_path: str) -> None:
        overwrite_path(master_rows(read_csv(self.spark, csv_path, PRODUCTS), "product_id"), self._silver("products"))

    def load_stores(self, csv_path: str) -> None:
        overwrite_path(master_rows(read_csv(self.spark, csv_path, STORES), "store_id"), self._silver("stores"))

    def products(self) -> DataFrame:
        return read_path(self.spark, self._silver("products"), PRODUCTS)

    def stores(self) -> DataFrame:
        return read_path(self.spark, self._silver("stores"), STORES)

    # Bronze -------------------------------------------------------------------------

    def ingest(self, raw: str | list[str]) -> int:
        """Read a CSV folder whole and add it to bronze: a re-run adds the rows again.  Returns the rows, without malformed lines.

        ``tallymill.streaming`` has the form that takes only files not seen before.
        """
        with self.log.run(BRONZE_PIPELINE, BRONZE_LAYER) as run:
            rows = with_load_metadata(read_csv_checked(self.spark, raw, RAW_SALES), SOURCE_SYSTEM)
            load_id = datetime.now(timezone.utc).strftime("batch-%Y%m%dT%H%M%S%f")
            run.processed, run.rejected = self.write_bronze(rows, load_id)
        return run.processed

    def write_bronze(self, rows: DataFrame, load_id: str) -> tuple[int, int]:
        """Store one load; returns the rows and the malformed lines.

        The load has a folder of its own, so repeating it replaces it.  Malformed lines lie in folders of their own,
        with what could be read of them, and reach the quarantine with their text (see :meth:`rejected`).
        """
        path = f"{self.root}/bronze/sales/load={load_id}"
        if RAW_LINE not in rows.columns:
            rows = rows.withColumn(RAW_LINE, F.lit(None).cast("string"))
        broken = F.col(RAW_LINE).isNotNull()
        folders = {
            _MALFORMED: broken,
            "ingestion_date": F.to_date("ingestion_timestamp"),
            _PERIOD: F.when(~broken, self.period_of(F.col("transaction_timestamp"))),
        }
        counter = Observation()
        counts = [F.count_if(~broken).alias("rows"), F.count_if(broken).alias("malformed")]
        placed = rows.withColumns(folders)
        sized = (placed if self.few_folders else sized_for_write(placed, tuple(folders))).observe(counter, *counts)
        with open_folders(sized.sparkSession):
            sized.write.mode("overwrite").option("compression", COMPRESSION).partitionBy(*folders).parquet(path)
        return counter.get["rows"], counter.get["malformed"]

    def _bronze_rows(self, path: str) -> DataFrame:
        return read_path(self.spark, path, _BRONZE_STORED).where(~F.col(_MALFORMED)).select(*_BRONZE.names)

    def malformed_lines(self) -> DataFrame:
        """The text of malformed lines of all loads, with where it came from."""
        path = f"{self.root}/bronze/sales"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], _BRONZE_STORED).drop(_MALFORMED, _PERIOD)
        return read_path(self.spark, path, _BRONZE_STORED).where(_MALFORMED).drop(_MALFORMED, _PERIOD)

    def bronze(self) -> DataFrame:
        """All loads, with the period of sale, by which a filter chooses among the folders."""
        path = f"{self.root}/bronze/sales"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], _BRONZE)
        return self._bronze_rows(path)

    def bronze_load(self, load_id: str) -> DataFrame:
        return self._bronze_rows(f"{self.root}/bronze/sales/load={load_id}")

    # Silver -------------------------------------------------------------------------

    def refresh_silver(self, batch: DataFrame | None = None, bound: str | None = None) -> tuple[int, int]:
        """Upsert the sales since the high-water mark; returns (valid, rejected).

        By default all bronze is looked at, and rows older than the look-back are done with.  ``batch``
        limits the input to given new bronze rows and ``bound`` (see :meth:`look_back`) is the caller's, so
        that several batches of one run share it; older rows are then new and go to the quarantine.
        """
        with self.log.run(SILVER_PIPELINE, SILVER_LAYER) as run:
            if batch is None:
                recent = not_before(self.bronze(), self.look_back(), "transaction_timestamp", _PERIOD, self.period_of)
                late = F.lit(False)
            else:
                recent = batch
                late = F.lit(False) if bound is None else holds(F.col("transaction_timestamp") < F.lit(bound).cast("timestamp"))
            # Rows without an id are told apart by what they say, so that only exact copies fold.
            told = F.when(F.col("transaction_id").isNull(), F.xxhash64(*[c for c in RAW_SALES.names]))
            newest = latest_per_key(recent.withColumns({_IDENTITY: told, _LATE: late}), [*KEYS, _IDENTITY], NEWEST_FIRST)
            flagged = flag_sales(newest, self.products(), self.stores(), {TOO_LATE: ~F.col(_LATE)}).drop(_LATE)
            run.processed, run.rejected = self._store(flagged)
        return run.processed, run.rejected

    def look_back(self) -> str | None:
        """The oldest time of sale that a refresh now accepts, or None for all."""
        return look_back_bound(self._newest_sales(), "transaction_timestamp", self.lookback)

    def _newest_sales(self) -> DataFrame:
        """Silver sales of the last period: the newest timestamp is among them."""
        periods = self.sales.partition_values(_PERIOD)
        last = F.lit(periods[-1] if periods else None).cast("date")
        return self.sales.read().where(F.col(_PERIOD) == last)

    def _store(self, flagged: DataFrame) -> tuple[int, int]:
        # Written once and read for both outputs, instead of classifying twice.
        staged = f"{self.root}/staging/classified-{uuid.uuid4().hex[:12]}"
        with open_folders(flagged.sparkSession):
            flagged.write.option("compression", COMPRESSION).partitionBy(VALID).parquet(staged)
        stored = self.spark.read.schema(flagged.schema).parquet(staged)
        valid, rejected = stored.where(F.col(VALID)), stored.where(~F.col(VALID))
        counts = {row[0]: row[1] for row in stored.groupBy(VALID).count().collect()}
        # The quarantine first: only silver moves the high-water mark, so after a crash in between the
        # same rows are looked at again.
        if counts.get(False):
            refused = normalise_sale_types(rejected)
            keys = [*KEYS, _IDENTITY]
            self.quarantine.upsert(align_to(refused, _STORED_REJECTS.names), keys, null_safe=True, stored=True, unique=True)
        if counts.get(True):
            accepted = normalise_sale_types(calibrate(valid))
            self.sales.upsert(align_to(accepted, _STORED_SALES.names), KEYS, stored=True, unique=True)
        return counts.get(True, 0), counts.get(False, 0)

    def silver(self, version: int | None = None) -> DataFrame:
        return align_to(self.sales.read(version), SILVER_SALES.names)

    def rejected(self) -> DataFrame:
        """Rejected sales with reasons, and malformed lines with their text in ``raw_line``."""
        refused = align_to(self.quarantine.read(), [*SILVER_SALES.names, REASONS]).withColumn(RAW_LINE, F.lit(None).cast("string"))
        lines = self.malformed_lines().withColumn(REASONS, F.array(F.lit(MALFORMED_LINE)))
        return refused.unionByName(lines.select(*refused.columns))

    # Gold ---------------------------------------------------------------------------

    def build_gold(self) -> None:
        """All six gold tables from two passes over the facts.

        The partial sums are written as tables of their own and rolled up from there.
        """
        sales = self.silver()
        overwrite_path(gold.by_store_and_day(sales), self._gold("partial_store_day"))
        overwrite_path(gold.by_product(sales), self._gold("partial_product"))
        store_days = self.spark.read.parquet(self._gold("partial_store_day"))
        product_sums = self.spark.read.parquet(self._gold("partial_product"))
        self._write_gold(store_days, product_sums)

    def refresh_gold(self) -> None:
        """Bring the gold tables up to date from what changed in silver since they were last refreshed.

        Only the folders that the silver versions do not share are read, and for a product that lost its lowest or highest price the
        product's sales.  Sums are kept on two sides in turn: one that is half written is not used.  The first call reads all.
        """
        now, (before, side) = self.sales.latest_version(), self._applied()
        if now == before:
            return
        gone, new = self.sales.changed_rows(before, now)
        states = _states()
        other = "b" if side == "a" else "a"
        for name, (keys, measures) in states.items():
            if before is None:
                state = summary(new, keys, measures)
            else:
                old = self.spark.read.parquet(self._gold(f"state/{side}/{name}"))
                state = refreshed(old, gone, new, self.sales.read(now), keys, measures)
            overwrite_path(state, self._gold(f"state/{other}/{name}"))
        store_days, product_sums = (
            plain_sums(self.spark.read.parquet(self._gold(f"state/{other}/{name}")), measures) for name, (_, measures) in states.items())
        self._write_gold(store_days, product_sums)
        prices = product_sums.select("product_id", F.col("least_price").alias("least_unit_price"), F.col("most_price").alias("most_unit_price"))
        overwrite_path_keeping_columns(prices, self._gold("product_prices"))
        # Written last: until then a next call starts from the side before.
        overwrite_path(self.spark.range(1).select(F.lit(now).cast("long").alias("version"), F.lit(other).alias("side")), self._gold("applied"))

    def _applied(self) -> tuple[int | None, str | None]:
        """The silver version that gold was last refreshed to, and the side that holds its sums."""
        if not path_exists(self.spark, self._gold("applied")):
            return None, None
        row = self.spark.read.schema("version long, side string").parquet(self._gold("applied")).first()
        return (row["version"], row["side"]) if row else (None, None)

    def _write_gold(self, store_days: DataFrame, product_sums: DataFrame) -> None:
        products, stores = self.products(), self.stores()
        results = {
            "daily_sales": gold.daily(store_days),
            "monthly_sales": gold.monthly(store_days),
            "monthly_region_sales": gold.monthly_region(store_days, stores),
            "product_performance": gold.product_performance(product_sums, products),
            "category_performance": gold.category_performance(product_sums, products),
            "store_performance": gold.store_performance(store_days, stores),
        }
        for name, result in results.items():
            overwrite_path_keeping_columns(result, self._gold(name))

    def gold(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._gold(name))

    def _silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def _gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"
