"""Table changes, versions, layout and streaming on the order book."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymill.operators import dml
from tallymill.operators.bucketed import BucketedTable
from tallymill.operators.versioned import VersionedTable
from tallymill.plans import order_book
from tallymill.queries.registry import BOOK, LATEST, kept, query, scratch_database
from tallymill.session import scratch_path
from tallymill.sinks import writers
from tallymill.sources import star
from tallymill.streaming import loads, stateful

_PARTITIONS = ("country", "order_year")
_BUCKETS = 8
_URGENT_PAID = "country = '1-URGENT' AND status = 'PAID'"
_SETTLED = "CASE WHEN order_timestamp >= TIMESTAMP '1999-11-02' THEN 'SETTLED' ELSE status END"


def _new_table(spark, label="orders", partition_by=_PARTITIONS):
    return VersionedTable(spark, scratch_path(spark, label), partition_by)


@query(f"WITH {BOOK} SELECT * REPLACE ({_SETTLED} AS status) FROM book")
def merge_upsert(spark, sf_dir):
    """Orders up to 2000 merged with a batch that overlaps them by two months."""
    book = star.order_book(spark, sf_dir)
    loaded = book.where("order_timestamp < TIMESTAMP_NTZ '2000-01-01'")
    batch = book.where("order_timestamp >= TIMESTAMP_NTZ '1999-11-02'").withColumn("status", F.lit("SETTLED"))
    return dml.upsert_rows(loaded, batch, ["order_id"])


@query(f"WITH {BOOK} SELECT * REPLACE ({_SETTLED} AS status) FROM book")
def versioned_upsert(spark, sf_dir):
    """The same merge on a stored table: only partitions with matched orders are rewritten."""
    book = star.order_book(spark, sf_dir)
    table = _new_table(spark)
    table.create(book.where("order_timestamp < TIMESTAMP_NTZ '2000-01-01'"))
    table.upsert(
        book.where("order_timestamp >= TIMESTAMP_NTZ '1999-11-02'").withColumn("status", F.lit("SETTLED")),
        ["order_id"],
    )
    return table.read()


@query(f"WITH {BOOK} SELECT * REPLACE ({_SETTLED} AS status) FROM book")
def bucketed_upsert(spark, sf_dir):
    """The same merge on a managed table in buckets by order: only the batch is shuffled."""
    book = star.order_book(spark, sf_dir)
    with scratch_database(spark) as database:
        table = BucketedTable(spark, f"{database}.orders", ["order_id"], _BUCKETS)
        table.create(book.where("order_timestamp < TIMESTAMP_NTZ '2000-01-01'"))
        table.upsert(book.where("order_timestamp >= TIMESTAMP_NTZ '1999-11-02'").withColumn("status", F.lit("SETTLED")))
        return kept(table.read())


@query(f"""WITH {BOOK} SELECT * REPLACE (CASE WHEN order_year IN (1998, 1999) THEN status ELSE 'OLD' END AS status) FROM book""")
def partition_reload(spark, sf_dir):
    """Two years of a partitioned table loaded again, twice; the other years keep their files."""
    book = star.order_book(spark, sf_dir)
    with scratch_database(spark) as database:
        name = f"{database}.orders"
        writers.overwrite_table(book.withColumn("status", F.lit("OLD")), name, ("order_year",))
        for _ in range(2):
            writers.overwrite_table_partitions(book.where("order_year IN (1998, 1999)"), name)
        return kept(spark.table(name).select(*book.columns))


@query(f"""WITH {BOOK} SELECT * REPLACE (
CASE WHEN {_URGENT_PAID} THEN 'CANCELLED' ELSE status END AS status) FROM book""")
def conditional_update(spark, sf_dir):
    return dml.update_rows(star.order_book(spark, sf_dir), F.expr(_URGENT_PAID), {"status": F.lit("CANCELLED")})


@query(f"WITH {BOOK} SELECT * FROM book WHERE NOT coalesce(amount < 10000, false)")
def conditional_delete(spark, sf_dir):
    return dml.delete_rows(star.order_book(spark, sf_dir), F.col("amount") < 10_000)


@query(f"WITH {BOOK} SELECT * FROM book")
def as_of_version(spark, sf_dir):
    """Version 0 after later changes."""
    table = _new_table(spark)
    table.create(star.order_book(spark, sf_dir))
    table.update(_URGENT_PAID, {"status": F.lit("CANCELLED")})
    table.delete("amount < 10000")
    return table.read(0)


@query(f"""WITH {BOOK} SELECT order_id, status AS status_before, 'CANCELLED' AS status_after, 'update' AS change
FROM book WHERE {_URGENT_PAID}""")
def version_diff(spark, sf_dir):
    table = _new_table(spark)
    table.create(star.order_book(spark, sf_dir))
    table.update(_URGENT_PAID, {"status": F.lit("CANCELLED")})
    return table.diff(0, 1, ["order_id"], ["status"])


@query(f"""WITH {BOOK} SELECT order_id, CAST(NULL AS VARCHAR) AS payment_method_before,
'CARD' AS payment_method_after, 'insert' AS change FROM book WHERE order_timestamp >= TIMESTAMP '2000-01-01'""")
def version_diff_wider(spark, sf_dir):
    """A diff on a column that the older version does not have."""
    earlier, later = _two_batches(spark, sf_dir)
    table = _new_table(spark)
    table.create(earlier)
    table.append(later)
    return table.diff(0, 1, ["order_id"], ["payment_method"])


@query(f"""WITH {BOOK} SELECT * REPLACE (CASE WHEN country = '5-LOW' THEN '4-MOVED' ELSE country END AS country) FROM book""")
def partition_update(spark, sf_dir):
    """An update of a partition column moves rows to other folders."""
    table = _new_table(spark)
    table.create(star.order_book(spark, sf_dir))
    table.update("country = '5-LOW'", {"country": F.lit("4-MOVED")})
    return table.read()


@query(f"""WITH {BOOK}, touched AS (SELECT DISTINCT country, order_year FROM book WHERE {_URGENT_PAID})
SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, CAST(0 AS BIGINT) AS rows_matched, count(*) AS rows_written,
       CAST(0 AS BIGINT) AS folders_rewritten FROM book
UNION ALL
SELECT 1, 'UPDATE', (SELECT count(*) FROM book WHERE {_URGENT_PAID}),
       (SELECT count(*) FROM book SEMI JOIN touched USING (country, order_year)), (SELECT count(*) FROM touched)""")
def version_history(spark, sf_dir):
    table = _new_table(spark)
    table.create(star.order_book(spark, sf_dir))
    table.update(_URGENT_PAID, {"status": F.lit("CANCELLED")})
    return table.history().select("version", "operation", "rows_matched", "rows_written", "folders_rewritten")


_WIDER = f"""WITH {BOOK} SELECT *, CASE WHEN order_timestamp >= TIMESTAMP '2000-01-01' THEN 'CARD' END AS payment_method
FROM book"""


def _two_batches(spark, sf_dir):
    book = star.order_book(spark, sf_dir)
    earlier = book.where("order_timestamp < TIMESTAMP_NTZ '2000-01-01'")
    later = book.where("order_timestamp >= TIMESTAMP_NTZ '2000-01-01'").withColumn("payment_method", F.lit("CARD"))
    return earlier, later


@query(_WIDER)
def schema_evolution_union(spark, sf_dir):
    return dml.append_rows(*_two_batches(spark, sf_dir))


@query(_WIDER)
def schema_evolution_append(spark, sf_dir):
    earlier, later = _two_batches(spark, sf_dir)
    table = _new_table(spark)
    table.create(earlier)
    table.append(later)
    return table.read()


@query(_WIDER)
def schema_evolution_files(spark, sf_dir):
    """Append of wider rows to a plain path table, read with merged schemas."""
    earlier, later = _two_batches(spark, sf_dir)
    path = scratch_path(spark, "evolving")
    writers.append_evolving(earlier, path, ("country",))
    writers.append_evolving(later, path, ("country",))
    return writers.read_evolving(spark, path)


@query(f"WITH {BOOK} SELECT * FROM book")
def compacted_rows(spark, sf_dir):
    table = _new_table(spark)
    table.create(star.order_book(spark, sf_dir))
    table.compact("customer_id")
    return table.read()


@query(f"WITH {BOOK} SELECT * FROM book WHERE country = '3-MEDIUM' AND order_year = 1998")
def partition_pruned(spark, sf_dir):
    table = _new_table(spark)
    table.create(star.order_book(spark, sf_dir))
    return table.read().where("country = '3-MEDIUM' AND order_year = 1998")


@query(f"""WITH {BOOK}, v AS (
  SELECT *, CAST(order_timestamp AS DATE) AS order_date, CASE WHEN order_year >= 2000 THEN 'CARD' END AS payment_method,
         CASE WHEN order_year < 2000 AND {_URGENT_PAID} THEN 'CANCELLED' ELSE status END AS status1
  FROM book)
SELECT * EXCLUDE (status, status1),
       CASE WHEN country = '5-LOW' AND status1 = 'PAID' AND amount < 50000 THEN 'CANCELLED' ELSE status1 END AS status
FROM v WHERE NOT coalesce(amount < 10000, false)""")
def order_book_life_cycle(spark, sf_dir):
    """Create, update, append wider rows, update, delete, compact."""
    earlier, later = _two_batches(spark, sf_dir)
    table = _new_table(spark)
    order_book.life_cycle(table, earlier, later, "1-URGENT", "5-LOW", low_value=50_000, cutoff=10_000)
    return table.read()


@query(f"WITH {LATEST} SELECT * FROM latest")
def stream_silver(spark, sf_dir):
    """All sales as CSV files, streamed file by file into a table of the latest row per sale."""
    sales = star.sales(spark, sf_dir)
    raw = scratch_path(spark, "stream-in")
    writers.write_csv(sales, raw)
    dated = loads.stream_csv(spark, raw, sales.schema, files_per_batch=2).withColumn(
        "sale_year", F.year("transaction_timestamp")
    )
    table = _new_table(spark, "stream-out", ("sale_year",))
    table.create_if_absent(dated.schema)
    loads.stream_latest(
        dated, table, scratch_path(spark, "stream-checkpoint"), star.SALE_KEYS, ["transaction_timestamp"]
    )
    return table.read().select(*sales.columns)


@query("""SELECT event_id, ts, user_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1""")
def stream_latest_stateful(spark, sf_dir):
    """The latest event of each user, from a stream of files in no order whose state holds what is known."""
    events = star.load(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    raw, out, checkpoint = (scratch_path(spark, f"state-{name}") for name in ("in", "out", "checkpoint"))
    writers.write_csv(events.repartition(4, "event_id"), raw)
    stream = loads.stream_csv(spark, raw, events.schema, files_per_batch=2)
    stateful.stream_latest_stateful(stream, out, checkpoint, ["user_id"], ["ts", "event_id"], "ts", "60 days")
    latest = stateful.read_latest(spark, out, events.schema, ["user_id"], ["ts", "event_id"])
    return latest.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT * FROM orders")
def stream_new_files(spark, sf_dir):
    """Two runs over the same folder: the second one finds nothing new."""
    orders = star.load(spark, sf_dir, "orders")
    raw, out, checkpoint = (scratch_path(spark, f"files-{name}") for name in ("in", "out", "checkpoint"))
    writers.write_csv(orders, raw)
    for _ in range(2):
        loads.append_available(loads.stream_csv(spark, raw, orders.schema), out, checkpoint)
    return spark.read.schema(orders.schema).parquet(out)
