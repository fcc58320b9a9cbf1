"""Structured Streaming forms of ingestion: only files not seen before are read."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallymill.fixed_values import BRONZE_LAYER, BRONZE_PIPELINE, SOURCE_SYSTEM
from tallymill.operators.dedup import latest_per_key
from tallymill.operators.dml import matched
from tallymill.operators.versioned import VersionedTable
from tallymill.plans.medallion import RetailLakehouse
from tallymill.schemas import RAW_SALES
from tallymill.sources.readers import checked_lines, checked_options, path_exists, with_load_metadata


def stream_csv(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None,
               checked: bool = False) -> DataFrame:
    """New CSV files; ``checked`` adds the text of malformed lines (see :func:`read_csv_checked`)."""
    options = {"header": "true"}
    if checked:
        schema, options = checked_options(schema)
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return checked_lines(reader.csv(path)) if checked else reader.csv(path)


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None],
                  output_mode: str = "append") -> StreamingQuery:
    """Process all files there are now, batch by batch, and stop.

    The checkpoint remembers the files done.  A batch that failed half way is handed over
    again with the same number, so ``handle`` must be repeatable.
    """
    query = (
        stream.writeStream.foreachBatch(handle).outputMode(output_mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def append_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Copy new files into a Parquet table, each row exactly once."""
    query = (
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def merge_latest(table: VersionedTable, batch: DataFrame, keys: Sequence[str], newest_first: Sequence[str], apart: str | None = None) -> int:
    """Upsert the newest row of each key, out of the batch and the table.

    The outcome does not depend on how rows are spread over batches.  ``apart`` names a column of the batch by which
    rows of equal keys are told apart; it is not stored.
    """
    columns = [c for c in batch.columns if c != apart]
    rows = batch if table.is_empty() else batch.unionByName(matched(table.read(), batch, keys).select(*columns), allowMissingColumns=True)
    newest = latest_per_key(rows, [*keys, *([apart] if apart else [])], newest_first)
    return table.upsert(newest.select(*columns), keys, unique=True)


_STREAM, _BATCH = "_stream", "_batch"


def stream_latest(stream: DataFrame, table: VersionedTable, checkpoint: str, keys: Sequence[str],
                  newest_first: Sequence[str]) -> StreamingQuery:
    """All files there are now, batch by batch, into a table of the newest row of each key.

    A batch is stored beside the table, each in a folder of its own, so one that is handed over again replaces itself.
    When all are there they are merged at once: the table is gone through once in a call, however many batches there are.
    What a call that failed has left is merged by the next one; merging rows again changes nothing.
    Rows with a null in the key are told apart by batch, as no key equals theirs.
    """
    spark, pending = stream.sparkSession, f"{table.root}/pending"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{pending}/{_STREAM}={_query_id(spark, checkpoint)}/{_BATCH}={number}")
    query = run_available(stream, checkpoint, keep)
    if path_exists(spark, pending):
        schema = StructType([*stream.schema.fields]).add(_STREAM, "string").add(_BATCH, "long")
        waiting = spark.read.schema(schema).parquet(pending)
        keyless = reduce(or_, [F.col(key).isNull() for key in keys])
        told = waiting.withColumn(_BATCH, F.when(keyless, F.concat_ws("-", _STREAM, _BATCH))).drop(_STREAM)
        if not waiting.isEmpty():
            merge_latest(table, told, keys, newest_first, _BATCH)
        # Only now: until the merge is committed the rows are needed.
        spark.createDataFrame([], schema).write.mode("overwrite").partitionBy(_STREAM, _BATCH).parquet(pending)
    return query


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint: loads of two streams have different folders."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def stream_medallion(house: RetailLakehouse, raw_dir: str, checkpoint: str, files_per_batch: int | None = None,
                     recheck: bool = False) -> StreamingQuery:
    """New sales files to bronze and on to silver, one micro-batch at a time.

    Rows older than the look-back, as it is when the call begins, go to the quarantine.  With ``recheck`` every batch validates the whole look-back period again, as the batch
    job does, so a sale rejected yesterday is accepted once its master row has arrived.
    """
    # One bound for all batches: how many there are does not change what is accepted.
    bound = house.look_back()

    def handle(batch: DataFrame, number: int) -> None:
        load_id = f"stream-{_query_id(house.spark, checkpoint)}-{number}"
        with house.log.run(BRONZE_PIPELINE, BRONZE_LAYER) as run:
            run.processed, run.rejected = house.write_bronze(batch, load_id)
        if recheck:
            house.refresh_silver()
        else:
            house.refresh_silver(house.bronze_load(load_id), bound)

    sales = with_load_metadata(stream_csv(house.spark, raw_dir, RAW_SALES, files_per_batch, checked=True), SOURCE_SYSTEM)
    return run_available(sales, checkpoint, handle)
