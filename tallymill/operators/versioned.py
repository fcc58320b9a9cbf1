"""A table kept as numbered versions of ordinary Parquet folders.

A version is a list of folders.  A change rewrites only the folders (table partitions)
that hold affected rows and carries the other folders over by name, so its cost follows
the partitions touched and not the table.  Appends only add folders.  Old folders are
never modified: any version stays readable, with the schema it had.

Layout below the root::

    data/written_in=<n>-<try>/<partition folders>/   rows written by version n, each try in its own folder
    history/version=<n>/                       one row with the folders version n consists of;
                                               written last, it makes the version visible

One writer at a time.  A second writer that lost the race fails when it commits, and has touched nothing
of the version that won.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from tallymill.operators import dml
from tallymill.operators.layout import COMPRESSION, clustered, open_folders, sized_for_write
from tallymill.schemas import table
from tallymill.sources.readers import path_exists

_WRITTEN_IN = "written_in"
_FACTS = table(
    "committed_at timestamp, operation string, detail string, rows_matched long, rows_written long, "
    "folders_rewritten long"
)
_HISTORY = StructType([
    *_FACTS.fields, StructField("schema_json", StringType()), StructField("folders", ArrayType(StringType())),
])
_HISTORY_ARROW = pa.schema([
    ("committed_at", pa.timestamp("us", tz="UTC")), ("operation", pa.string()), ("detail", pa.string()),
    ("rows_matched", pa.int64()), ("rows_written", pa.int64()), ("folders_rewritten", pa.int64()),
    ("schema_json", pa.string()), ("folders", pa.list_(pa.string())),
])


@dataclass(frozen=True)
class _Version:
    number: int
    schema: StructType
    folders: frozenset[str]


class VersionedTable:
    """``few_folders`` says that partitions are few and large, so that rows are written where they are, without a shuffle."""

    def __init__(self, spark: SparkSession, root: str, partition_by: Sequence[str] = (), few_folders: bool = False):
        self.spark = spark
        self.few_folders = few_folders
        self.root = root.rstrip("/")
        self.partition_by = tuple(partition_by)

    # Reading ------------------------------------------------------------------------

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.root}/history")

    def history(self) -> DataFrame:
        """One row per committed version, with what was done and how much it touched."""
        entries = self.spark.read.schema(_FACTS).parquet(f"{self.root}/history")
        return entries.select(F.col("version").cast("long").alias("version"), *_FACTS.names)

    def latest_version(self) -> int:
        """Newest committed version, from the names of the history files alone."""
        names = self.spark.read.schema(_FACTS).parquet(f"{self.root}/history").inputFiles()
        return max(int(re.search(r"/version=(\d+)/", name).group(1)) for name in names)

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, the newest by default.

        Filters on partition columns choose among the version's folders.
        """
        state = self._version(version)
        return self._read(state, state.folders)

    def is_empty(self) -> bool:
        """Whether the newest version has no folders, so no rows."""
        return not self._version().folders

    def partition_values(self, column: str) -> list[str]:
        """Values of a partition column in the newest version, sorted as text, without null.

        Taken from the folder names; no data is read.
        """
        at = self.partition_by.index(column) + 1
        found = {_partition_key(folder)[at] for folder in self._version().folders}
        return sorted(found - {None})

    def changed_rows(self, before: int | None, after: int) -> tuple[DataFrame, DataFrame]:
        """Rows of the folders that only the older version has, and of those that only the newer one has.

        A row that was carried over by a rewrite of its folder is in both.  Without an older version all rows are new.
        """
        new = self._version(after)
        old = _Version(-1, new.schema, frozenset()) if before is None else self._version(before)
        both = self._widened(old.schema, new.schema)
        gone, came = self._read(old, old.folders - new.folders), self._read(new, new.folders - old.folders)
        return self._shaped(gone, both), self._shaped(came, both)

    def diff(self, before: int, after: int, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
        """Rows that differ between two versions.  Folders both versions share are not read.

        A column that one version lacks is null there.  Where the schemas differ, rows of shared folders
        are null in the new column on both sides, so leaving them out changes nothing.
        """
        return dml.row_diff(*self.changed_rows(before, after), keys, columns)

    # Changing -----------------------------------------------------------------------

    def create(self, df: DataFrame) -> int:
        """Full content as the next version: version 0, or an overwrite that keeps history."""
        number = self.latest_version() + 1 if self.exists() else 0
        written, folders = self._write(df, number)
        return self._commit(number, "WRITE", "", df.schema, folders, 0, written, 0)

    def create_if_absent(self, schema: StructType, reset: bool = False) -> None:
        if reset or not self.exists():
            self.create(self.spark.createDataFrame([], schema))

    def append(self, batch: DataFrame) -> int:
        """Add rows; new columns extend the schema and are null in older rows."""
        now = self._version()
        number = now.number + 1
        schema = self._widened(now.schema, batch.schema)
        written, folders = self._write(self._shaped(batch, schema), number)
        return self._commit(number, "APPEND", "", schema, now.folders | folders, 0, written, 0)

    def update(self, condition: Column | str, changes: Mapping[str, Column]) -> int:
        """Set columns where the condition holds; rows whose partition changes move to its folder."""
        test, moved = _column(condition), bool(set(changes) & set(self.partition_by))
        return self._rewrite("UPDATE", condition, test, lambda rows: dml.update_rows(rows, test, changes), arranged=not moved)

    def delete(self, condition: Column | str) -> int:
        test = _column(condition)
        return self._rewrite("DELETE", condition, test, lambda rows: dml.delete_rows(rows, test))

    def upsert(self, source: DataFrame, keys: Sequence[str], null_safe: bool = False, stored: bool = False,
               unique: bool = False) -> int:
        """Replace rows of matching key by the source's and add the rest.

        The source is used three times, so it is written out first unless it is already
        ``stored`` or, unique, the first content of an empty table.  Only the folders that hold a key of it are read in full.  A key that occurs twice in it is an error; who has just made the keys ``unique``
        says so and saves the check.
        """
        now = self._version()
        number = now.number + 1
        if not stored and not (unique and not now.folders):
            staged = f"{self.root}/staging/version={number}-{uuid.uuid4().hex[:12]}"
            source.write.parquet(staged)
            source = self.spark.read.schema(source.schema).parquet(staged)
        if not unique and not dml.repeated_keys(source, keys).isEmpty():
            raise ValueError(f"source repeats a key of {list(keys)}")
        schema = self._widened(now.schema, source.schema)
        touched: dict[str, int] = {}
        if now.folders:
            located = self._located(now).select(*keys, *self._place())
            touched = self._count_by_folder(now, dml.matched(located, source, keys, null_safe))
        merged = self._shaped(source, schema)
        if touched:
            kept = dml.unmatched(self._read(now, frozenset(touched)), source, keys, null_safe)
            merged = self._shaped(kept, schema).unionByName(merged)
        written, folders = self._write(merged, number)
        return self._commit(
            number, "MERGE", ", ".join(keys), schema, (now.folders - set(touched)) | folders,
            sum(touched.values()), written, len(touched),
        )

    def compact(self, cluster_by: str, files: int | None = None) -> int:
        """Rewrite the table in larger files, clustered by a column; the rows stay the same."""
        now = self._version()
        number = now.number + 1
        ranged = clustered(self._read(now, now.folders), cluster_by, self.partition_by, files)
        written, folders = self._write(ranged, number, arranged=True)
        return self._commit(
            number, "COMPACT", cluster_by, now.schema, folders, written, written, len(now.folders)
        )

    # Helpers ------------------------------------------------------------------------

    def _rewrite(self, operation: str, detail: Column | str, test: Column, change, arranged: bool = True) -> int:
        now = self._version()
        number = now.number + 1
        touched = self._count_by_folder(now, self._located(now).where(test))
        written = 0
        added: frozenset[str] = frozenset()
        if touched:
            # Input splits already follow the folders, so no shuffle is needed to write.
            written, added = self._write(change(self._read(now, frozenset(touched))), number, arranged)
        return self._commit(
            number, operation, str(detail), now.schema, (now.folders - set(touched)) | added,
            sum(touched.values()), written, len(touched),
        )

    def _version(self, number: int | None = None) -> _Version:
        if number is None:
            number = self.latest_version()
        path = f"{self.root}/history/version={number}"
        if not path_exists(self.spark, path):
            raise ValueError(f"no version {number} in {self.root}")
        # The list has one short string per live table partition, like Spark's own file index.
        entry = self.spark.read.schema(_HISTORY).parquet(path).select("schema_json", "folders").first()
        return _Version(number, StructType.fromJson(json.loads(entry[0])), frozenset(entry[1]))

    def _read(self, version: _Version, folders: frozenset[str] | set[str]) -> DataFrame:
        return self._located(version, folders).select(*version.schema.names)

    def _located(self, version: _Version, folders: frozenset[str] | set[str] | None = None) -> DataFrame:
        """Rows with the try that wrote them, taken from the folder name."""
        folders = version.folders if folders is None else folders
        schema = StructType([*version.schema.fields, StructField(_WRITTEN_IN, StringType())])
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/data/{folder}" for folder in sorted(folders)]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)

    def _place(self) -> list[Column]:
        """The folder of a row as columns: writing version and partition values as text."""
        parts = [F.col(name).cast("string").alias(f"_in_{name}") for name in self.partition_by]
        return [F.col(_WRITTEN_IN).cast("string").alias(f"_in_{_WRITTEN_IN}"), *parts]

    def _count_by_folder(self, version: _Version, rows: DataFrame) -> dict[str, int]:
        """Number of given rows in each folder of the version that has any."""
        place = [f"_in_{name}" for name in (_WRITTEN_IN, *self.partition_by)]
        located = rows if set(place) <= set(rows.columns) else rows.select(*self._place())
        names = {_partition_key(folder): folder for folder in version.folders}
        return {names[tuple(row)[:-1]]: row["count"] for row in located.groupBy(*place).count().collect()}

    def _write(self, df: DataFrame, number: int, arranged: bool = False) -> tuple[int, frozenset[str]]:
        """Write the rows of a version and count them on the way; the count and the folders."""
        counter, attempt = Observation(), f"{number}-{uuid.uuid4().hex[:12]}"
        frame = df if arranged or self.few_folders else sized_for_write(df, self.partition_by)
        writer = frame.observe(counter, F.count(F.lit(1)).alias("rows")).write.option("compression", COMPRESSION)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        # An arranged frame keeps its order within a folder.
        with nullcontext() if arranged else open_folders(frame.sparkSession):
            writer.parquet(f"{self.root}/data/{_WRITTEN_IN}={attempt}")
        return counter.get["rows"], self._folders_of(attempt)

    def _folders_of(self, attempt: str) -> frozenset[str]:
        """Folders a try has written, from its file names; no data is read."""
        written = self.spark.read.schema(_FACTS).parquet(f"{self.root}/data/{_WRITTEN_IN}={attempt}")
        start = f"{_WRITTEN_IN}={attempt}/"
        names = {unquote(name).rpartition("/")[0] + "/" for name in written.inputFiles()}
        return frozenset(name[name.rindex(start):].rstrip("/") for name in names)

    def _commit(self, number: int, operation: str, detail: str, schema: StructType, folders, matched: int,
                written: int, rewritten: int) -> int:
        entry = {
            "committed_at": datetime.now(timezone.utc), "operation": operation, "detail": detail,
            "rows_matched": matched, "rows_written": written, "folders_rewritten": rewritten,
            "schema_json": schema.json(), "folders": sorted(folders),
        }
        record = pa.Table.from_pylist([entry], schema=_HISTORY_ARROW)
        (
            self.spark.createDataFrame(record).coalesce(1)
            .write.mode("error").parquet(f"{self.root}/history/version={number}")
        )
        return number

    @staticmethod
    def _widened(now: StructType, batch: StructType) -> StructType:
        return StructType(now.fields + [field for field in batch.fields if field.name not in now.names])

    @staticmethod
    def _shaped(df: DataFrame, schema: StructType) -> DataFrame:
        """The columns of a schema in its order and types, absent ones as null."""
        return df.select(*[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ])


def _column(condition: Column | str) -> Column:
    return F.expr(condition) if isinstance(condition, str) else condition


def _partition_key(folder: str) -> tuple[str | None, ...]:
    """``written_in=3-ab/country=IN`` -> ("3-ab", "IN"); the name Spark gives to null becomes None."""
    values = [unquote(part.partition("=")[2]) for part in folder.split("/")]
    return tuple(None if value == "__HIVE_DEFAULT_PARTITION__" else value for value in values)
