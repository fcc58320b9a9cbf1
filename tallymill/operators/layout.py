"""Physical layout of written tables: file sizing and clustering."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Stored tables are written once and read several times: smaller than Spark's default, at little more time.
COMPRESSION = "zstd"
# Folders that a task writes side by side; the rows of further ones it sorts.
OPEN_FOLDERS = 32


@contextmanager
def open_folders(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes within need not sort the rows of a task by folder, unless it meets more than ``OPEN_FOLDERS``.

    Writes take the number from the session, so it is set for the time of the call.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def sized_for_write(df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Gather the rows of each output folder into files of the advised size.

    The rebalance hint lets adaptive execution merge small outputs and split a folder
    that holds very many rows, so neither small files nor one huge task result.
    """
    if not partition_by:
        return df
    return df.hint("rebalance", *[F.col(name) for name in partition_by])


def clustered(df: DataFrame, cluster_by: str, partition_by: tuple[str, ...] = (), files: int | None = None) -> DataFrame:
    """Sort-cluster rows by one column within the table's partitions.

    Readers that filter on the column then skip row groups by their min and max.  A hash
    of the row is the last range key: the rows of one very frequent value are spread over
    several ranges instead of one.
    """
    spread = "_row_hash"
    keys = [*partition_by, cluster_by, spread]
    hashed = df.withColumn(spread, F.xxhash64(*df.columns))
    ranged = hashed.repartitionByRange(files, *keys) if files else hashed.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*partition_by, cluster_by).drop(spread)
