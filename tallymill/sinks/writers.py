"""Sinks: CSV, JSON, path tables and managed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallymill.functions.columns import epoch_millis
from tallymill.operators.layout import sized_for_write
from tallymill.sources.readers import empty_table, path_exists, read_path


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV with a header line; timestamps keep their microseconds.

    A compressed file is read again by one task, so ``compression`` suits files of a task's size, as Spark writes them.
    """
    formats = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    df.write.mode("overwrite").options(header=True, compression=compression, **formats).csv(path)


def write_json_records(df: DataFrame, path: str) -> None:
    """JSON Lines; dates and timestamps become epoch milliseconds."""
    kinds = {field.name: field.dataType.typeName() for field in df.schema.fields}
    clock = {
        name: epoch_millis(name, zoned=kind == "timestamp")
        for name, kind in kinds.items() if kind in ("date", "timestamp", "timestamp_ntz")
    }
    frame = df.withColumns(clock) if clock else df
    frame.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_path(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_path(df: DataFrame, path: str) -> None:
    """Full snapshot; ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def overwrite_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> None:
    """Full snapshot of a managed table; ``df`` must not read from it."""
    writer = sized_for_write(df, partition_by).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").format("parquet").saveAsTable(name)


def overwrite_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Replace the partitions that ``df`` has rows of, and leave the others' files alone.

    So loading some days again, once or twice, gives what loading them once gives.  A partition all of whose rows are
    gone from the source is not in ``df`` and stays.  ``df`` must not read from ``path``.
    """
    writer = sized_for_write(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def overwrite_table_partitions(df: DataFrame, name: str) -> None:
    """The same for a managed table with partitions; columns are matched by name.

    Inserts take the mode from the session, so it is set for the time of the call.
    """
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    partition_by = tuple(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    if not partition_by:
        raise ValueError(f"{name} has no partitions")
    sized = sized_for_write(df.select(*spark.table(name).columns), partition_by)
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        sized.write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def overwrite_keeping_columns(df: DataFrame, name: str) -> None:
    """Overwrite that may add columns but never drops one: lost columns are filled with null."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        before = empty_table(spark, spark.table(name).schema)
        df = before.unionByName(df, allowMissingColumns=True)
    overwrite_table(df, name)


def overwrite_path_keeping_columns(df: DataFrame, path: str) -> None:
    """The same for a path table."""
    spark = df.sparkSession
    if path_exists(spark, path):
        before = empty_table(spark, read_path(spark, path).schema)
        df = before.unionByName(df, allowMissingColumns=True)
    overwrite_path(df, path)


def append_evolving(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append rows that may carry new columns.  Read back with ``read_evolving``."""
    writer = sized_for_write(df, partition_by).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path)


def create_if_absent(spark: SparkSession, path: str, schema: StructType, reset: bool = False) -> bool:
    """An empty path table where there is none; ``reset`` empties an existing one."""
    if not reset and path_exists(spark, path):
        return False
    empty_table(spark, schema).write.mode("overwrite").parquet(path)
    return True


def create_table_if_absent(spark: SparkSession, name: str, schema: StructType, reset: bool = False) -> bool:
    if not reset and spark.catalog.tableExists(name):
        return False
    overwrite_table(empty_table(spark, schema), name)
    return True


# Definitions and inspection: Spark's own commands behind one name each.

def use_database(spark: SparkSession, name: str) -> str:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.catalog.setCurrentDatabase(name)
    return spark.catalog.currentDatabase()


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def tables(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES")


def table_detail(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {name}")


def table_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """Any ``rows`` rows; which ones is left to Spark."""
    return df.limit(rows)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
