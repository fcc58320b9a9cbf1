"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallymill.session import scratch_path

_RANK = "_rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``newest_first``, then by all other columns.

    The order is total over the columns, so the winner does not depend on how rows are
    partitioned.  Null keys form one group.  Spark keeps only the best row of each key in
    every input partition before the shuffle, so a key with very many copies sends one
    row per task.
    """
    ordering = [*newest_first, *[c for c in df.columns if c not in newest_first and c not in keys]]
    best = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in ordering])
    return df.withColumn(_RANK, F.row_number().over(best)).where(F.col(_RANK) == 1).drop(_RANK)


def master_rows(df: DataFrame, key: str) -> DataFrame:
    """Cleansed master table: rows with a key, one of each, chosen by a total order."""
    return latest_per_key(df.where(F.col(key).isNotNull()), [key], [])


# Hashes of repeated rows that are broadcast at most (16 bytes each).
MOST_REPEATED = 500_000


def exact_dedup(df: DataFrame) -> DataFrame:
    """Drop rows equal in every column, moving few whole rows.

    First only 128-bit hashes of the rows are shuffled and counted.  Rows whose hash is there once have no equal and
    stay where they are; the others are compared in full, so a collision of hashes changes nothing.  Where very many
    hashes are repeated, whole rows are the shuffle key instead.  The table is read three times, so it must not differ
    from one reading to the next.
    """
    spark = df.sparkSession
    hashes = {_unused(df, f"hash_{k}"): F.xxhash64(F.lit(k), *[_named(c) for c in df.columns]) for k in (1, 2)}
    path = scratch_path(spark, "repeated")
    df.select(*[h.alias(name) for name, h in hashes.items()]).groupBy(*hashes).count().where("count > 1").drop("count").write.parquet(path)
    repeated = spark.read.schema(", ".join(f"`{name}` long" for name in hashes)).parquet(path)
    if repeated.limit(MOST_REPEATED + 1).count() > MOST_REPEATED:
        return df.dropDuplicates()
    hashed, some = df.withColumns(hashes), F.broadcast(repeated)
    single = hashed.join(some, list(hashes), "left_anti").select(*[_named(c) for c in df.columns])
    several = hashed.join(some, list(hashes), "left_semi").select(*[_named(c) for c in df.columns])
    return single.unionAll(several.dropDuplicates())


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _unused(df: DataFrame, name: str) -> str:
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct values, or tuples, of the columns; null counts as a value."""
    return df.select(*columns).distinct()


def first_distinct(df: DataFrame, *columns: str) -> DataFrame:
    """The smallest distinct tuple: a reproducible sample of the values present."""
    return distinct_values(df, *columns).orderBy(*columns).limit(1)
