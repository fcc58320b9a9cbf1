"""The latest row of each key in a stream, held in the stream's own state.

The state has the newest row of each key and period that is not too old; a micro-batch compares its rows with the state and hands on
the keys that changed, so the table of results is never read while the stream runs.  Periods that lie wholly before the watermark
leave the state, and rows that arrive for them are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallymill.operators.dedup import latest_per_key
from tallymill.streaming.loads import run_available

_BATCH = "batch"


def latest_in_state(stream: DataFrame, keys: Sequence[str], newest_first: Sequence[str], timestamp: str, delay: str,
                    period: str = "1 day") -> DataFrame:
    """The newest row of each key and period of event time, as a streaming aggregation.

    Newest is the greatest by ``newest_first``, then by all other columns, as in :func:`latest_per_key`.  ``delay`` is how far behind
    the newest event time of earlier batches rows are still taken.  Rows without an event time belong to no period
    and are left out.
    """
    order = [*newest_first, *[c for c in stream.columns if c not in newest_first and c not in keys]]
    newest = F.max(F.struct(*[F.col(c) for c in order])).alias("_newest")
    grouped = stream.withWatermark(timestamp, delay).groupBy(F.window(F.col(timestamp), period).alias("_period"), *keys)
    return grouped.agg(newest).select(*keys, "_newest.*").select(*stream.columns)


def stream_latest_stateful(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], newest_first: Sequence[str],
                           timestamp: str, delay: str, period: str = "1 day") -> StreamingQuery:
    """Write what each micro-batch changed to its own folder of ``path``.

    A batch that is repeated replaces its folder.  Read with :func:`read_latest`; fold the folders with
    :func:`fold_latest` now and then.
    """
    def handle(changed: DataFrame, number: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/{_BATCH}={number}")

    changes = latest_in_state(stream, keys, newest_first, timestamp, delay, period)
    return run_available(changes, checkpoint, handle, output_mode="update")


def read_latest(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """One row per key: the newest of all that batches have written.

    Only changes are stored, so this reads as many rows as keys changed; the best row of each input
    partition is kept before the shuffle.
    """
    return latest_per_key(spark.read.schema(schema).parquet(path).select(*schema.names), keys, newest_first)


def fold_latest(spark: SparkSession, path: str, folded: str, schema: StructType, keys: Sequence[str], newest_first: Sequence[str]) -> None:
    """Write the newest rows as one table to another folder; the stream goes on writing to ``path``."""
    read_latest(spark, path, schema, keys, newest_first).write.mode("overwrite").parquet(folded)
