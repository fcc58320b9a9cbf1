"""Managed tables bucketed by key: an upsert meets the table without shuffling it.

The table is stored in a fixed number of buckets by a hash of its key, each sorted by it.  Only the source of an
upsert is dealt to these buckets; the table's side of the join, and the write of the result, follow the buckets that
are there already.  What each call writes is a table of its own, and the view that readers use is switched to it in one
step, so a reader sees either state and a failed call changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallymill.operators.dml import repeated_keys
from tallymill.operators.joins import same_keys

_IN_SOURCE = "_in_source"


class BucketedTable:
    """A view ``name`` on the newest of the tables ``name_<try>``.

    ``buckets`` should be such that a bucket fits a task: it is the number of tasks of every join with the table.
    """

    def __init__(self, spark: SparkSession, name: str, keys: Sequence[str], buckets: int):
        self.spark, self.name, self.keys, self.buckets = spark, name, list(keys), buckets

    def create(self, df: DataFrame) -> None:
        """Store the whole content anew.  Null keys are kept and match nothing."""
        self._switch(self._write(df.repartition(self.buckets, *self.keys)))

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def merged(self, source: DataFrame) -> DataFrame:
        """The table with rows of matching key replaced by the source's and the others added.

        One outer join in the table's own buckets.  Columns that only one side has are null in rows of the other.  The
        source must hold each key once.
        """
        target, keys = self.read(), self.keys
        dealt = source.repartition(self.buckets, *keys).withColumn(_IN_SOURCE, F.lit(True)).alias("s")
        both = target.alias("t").join(dealt, same_keys("t", "s", keys), "full")
        from_source = F.col(f"s.{_IN_SOURCE}").isNotNull()
        names = [*target.columns, *[c for c in source.columns if c not in target.columns]]

        def value(name: str):
            old = F.col(f"t.{name}") if name in target.columns else F.lit(None)
            new = F.col(f"s.{name}") if name in source.columns else F.lit(None)
            kind = (target if name in target.columns else source).schema[name].dataType
            return F.when(from_source, new.cast(kind)).otherwise(old).alias(name)
        return both.select(*map(value, names))

    def upsert(self, source: DataFrame) -> None:
        """:meth:`merged`, stored.  A source that repeats a key is refused; it is read twice."""
        if not repeated_keys(source.dropna(subset=self.keys), self.keys).isEmpty():
            raise ValueError(f"source repeats a key of {self.keys}")
        self._switch(self._write(self.merged(source)))

    def drop(self) -> None:
        for table in [self._current(), *self._tries()]:
            if table:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name}")

    # Helpers ------------------------------------------------------------------------

    def _write(self, df: DataFrame) -> str:
        table = f"{self.name}_{uuid.uuid4().hex[:12]}"
        df.write.format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(table)
        return table

    def _current(self) -> str | None:
        if not self.spark.catalog.tableExists(self.name):
            return None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name}").where("key = 'stored_in'").collect()
        return rows[0]["value"] if rows else None

    def _tries(self) -> list[str]:
        """Tables of this name that calls have left: the current one and those that failed half way."""
        database, _, short = self.name.rpartition(".")
        found = self.spark.sql(f"SHOW TABLES {f'IN {database}' if database else ''} LIKE '{short}_*'").collect()
        return [f"{database}.{r['tableName']}" if database else r["tableName"] for r in found]

    def _switch(self, table: str) -> None:
        """Let readers see the new table, then drop the one before."""
        before = self._current()
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ('stored_in' = '{table}') AS SELECT * FROM {table}")
        if before:
            self.spark.sql(f"DROP TABLE IF EXISTS {before}")
