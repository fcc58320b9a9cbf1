"""Row numbers over a whole table without a task that holds it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallymill.session import scratch_path

# ``monotonically_increasing_id`` holds the partition above these bits and the row below.
_ROW_BITS = 33


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "numbered")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_numbers(df: DataFrame, name: str = "row_number", *order: str | Column) -> DataFrame:
    """``df`` with ``name``: 1, 2, ... without gaps, in the order given, or in any order if none is.

    Rows are dealt out by ranges of the order (by their present partitions without one) and numbered within each
    partition; a partition's first number follows from the counts of those before it.  Only these counts, one for each
    partition, pass through the driver.  Rows with equal order columns are told apart by a hash of the row, so that a frequent value
    is dealt to several tasks; which of them comes first is the hash's choice, the same in every run, and copies
    of one row get successive numbers.
    """
    spark = df.sparkSession
    by = [c if isinstance(c, Column) else F.col(c) for c in order]
    if by:
        by.append(F.xxhash64(*df.columns))
        df = df.repartitionByRange(*by).sortWithinPartitions(*by)
    # Written, as a second run could deal the rows out differently.
    placed = _stored(df.withColumn(name, F.monotonically_increasing_id()))
    part = F.shiftright(F.col(name), _ROW_BITS)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    starts, before = [], 0
    for row in counts:
        starts.append((row["part"], before))
        before += row["n"]
    offsets = spark.createDataFrame(starts, "_part long, _before long")
    # One row for each partition.
    joined = placed.join(F.broadcast(offsets), part == F.col("_part"))
    number = F.col("_before") + F.col(name).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return joined.withColumn(name, number).drop("_part", "_before")


def with_ranks(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """``df`` with ``rank``, the place of its ``keys`` among all rows, equal for equal keys, and ``row_number``.

    ``order`` is how rows are numbered and begins with the keys (ascending without it).  Equal keys are reduced to one row before they meet
    their rows again, and the join splits a frequent key's rows.
    """
    numbered = with_row_numbers(df, "row_number", *(order or keys))
    ties = numbered.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min("row_number").alias("rank"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return numbered.join(ties, same).drop(*[f"_{k}" for k in keys])


def in_key_order(grouped: DataFrame, *keys: str) -> DataFrame:
    """Grouped rows as they are shown: in the order of their keys, null first."""
    return grouped.orderBy(*keys)
