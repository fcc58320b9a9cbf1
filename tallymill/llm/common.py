"""What the operators share: input columns, scratch tables, per-document Python on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.session import scratch_path

# Rows turned into Python objects at a time.
ROWS_AT_A_TIME = 256
# A table of sums by label, language or the like is broadcast if it was counted and has at most so many rows.
MOST_BROADCAST_ROWS = 10_000
# The same for a table of single row keys (8 bytes each).
MOST_BROADCAST_KEYS = 500_000
# Seeds that are tried for row keys.
KEY_SEEDS = 3


def named(name: str):
    """A column by its exact name, dots and back quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``; a null text is the empty text.  Other columns are not read."""
    return docs.select(
        named(id_col).cast("long").alias("doc_id"),
        F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"),
    )


# Tables written inside each open ``scratch_cleared`` block, the innermost last.
_open_blocks: list[list[tuple]] = []


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    if _open_blocks:
        _open_blocks[-1].append((df.sparkSession, path))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_cleared():
    """Tables that are stored inside are emptied at the end, so nothing that needs them may be used behind it."""
    _open_blocks.append([])
    done = False
    try:
        yield
        done = True
    finally:
        written = _open_blocks.pop()
        for spark, path in written if done else []:
            spark.range(0).write.mode("overwrite").parquet(path)


def stored_alone(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` returns, stored; the tables that it stored on the way are emptied."""
    with scratch_cleared():
        out = stored(make(), label)
        _, path = _open_blocks[-1].pop()
    if _open_blocks:
        _open_blocks[-1].append((out.sparkSession, path))
    return out


def hinted(written: DataFrame, most: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """A stored table for a join: broadcast if it was counted and has at most ``most`` rows, else joined by shuffling."""
    return F.broadcast(written) if written.count() <= most else written


def small_side(df: DataFrame, most: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """The table, stored, for a join (see :func:`hinted`)."""
    return hinted(stored(df, "side"), most)


def row_keyed(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a unique long ``name`` that is the same whenever the table is read.

    A row of Parquet files is known by a hash of its file and its place there, and nothing is written.  The keys are
    counted to see that they differ; where they do not (a hash collision under every seed, or rows that a join or
    ``explode`` made of one), and for tables of another origin, the table is stored first.
    """
    try:
        place = docs.metadataColumn("_metadata")
        for seed in range(KEY_SEEDS):
            keyed = docs.withColumn(name, F.xxhash64(F.lit(seed), place["file_path"], place["row_index"]))
            if keyed.groupBy(named(name)).count().where("count > 1").isEmpty():
                return keyed
    except AnalysisException:  # not a scan of Parquet files
        pass
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "keyed")


def map_texts(
    docs: DataFrame, make: Callable[[], Callable[[list[str]], list[pa.Array]]], schema: str, id_col: str, text_col: str,
) -> DataFrame:
    """``doc_id`` and the columns of ``schema``, which a function makes from a list of texts.

    ``make`` runs once in each task.  One output row for each input row, in one pass without a shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, convert = None, make()
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part = batch.slice(start, ROWS_AT_A_TIME)
                columns = convert(part.column(1).to_pylist())
                names = names or ["doc_id", *(field.strip().split()[0] for field in schema.split(";"))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    fields = schema.replace(";", ",")
    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id long, {fields}")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have yet, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
