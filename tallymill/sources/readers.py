"""Scans: CSV files and folders, catalog tables, path tables, and rows given in code."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None) -> DataFrame:
    """A CSV file or folder with a header line.

    A field that does not fit its declared type becomes null.  Without a schema the
    types are inferred, which reads the data a second time.
    """
    reader = spark.read.option("header", True)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


RAW_LINE = "raw_line"


def checked_options(schema: StructType) -> tuple[StructType, dict[str, str]]:
    """The schema with ``raw_line`` behind it, and the options by which a CSV scan fills it (see :func:`checked_lines`)."""
    if RAW_LINE in schema.names:
        raise ValueError(f"the schema has a column {RAW_LINE} of its own")
    wider = StructType([*schema.fields, StructField(RAW_LINE, StringType())])
    return wider, {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW_LINE, "columnPruning": "false"}


def checked_lines(scan: DataFrame) -> DataFrame:
    """A scan with :func:`checked_options` whose ``raw_line`` does not depend on the columns that a query asks for.

    Spark converts only fields that are asked for, and would not notice others that do not fit.  The condition is
    always true; it asks for all of them.
    """
    fields = [F.col(c) for c in scan.columns if c != RAW_LINE]
    return scan.withColumn(RAW_LINE, F.when(F.xxhash64(*fields) >= F.lit(-(2**63)), F.col(RAW_LINE)))


def read_csv_checked(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """A CSV file or folder with ``raw_line``: the text of a malformed line, and null for the others.

    A line is malformed if it has too few or too many fields, or one that does not fit its type.  Fields of it that
    can be read are there, the others are null.
    """
    wider, options = checked_options(schema)
    return checked_lines(spark.read.options(**options).schema(wider).csv(path))


def well_formed(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(RAW_LINE).isNull()).drop(RAW_LINE)


def malformed(checked: DataFrame) -> DataFrame:
    return checked.where(F.col(RAW_LINE).isNotNull())


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_path(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def rows_to_table(spark: SparkSession, rows: Iterable, schema: StructType) -> DataFrame:
    """A table from a handful of rows built in code, such as log records."""
    return spark.createDataFrame(list(rows), schema)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def with_load_metadata(df: DataFrame, source_system: str) -> DataFrame:
    """Load time (one value per query), source system and the file each row came from.

    Must be applied directly on a file scan: ``_metadata`` is a hidden column of scans.
    """
    return df.withColumns({
        "ingestion_timestamp": F.current_timestamp(),
        "source_system": F.lit(source_system),
        "source_file": F.col("_metadata.file_path"),
    })
