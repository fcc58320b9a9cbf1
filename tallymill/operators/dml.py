"""Table changes as DataFrame -> DataFrame operators.  A null condition changes nothing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallymill.functions.columns import holds
from tallymill.operators.joins import same_keys


def update_rows(df: DataFrame, condition: Column, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition holds; all new values see the old row."""
    hit = holds(condition)
    kinds = {field.name: field.dataType for field in df.schema.fields}
    return df.withColumns({
        name: F.when(hit, value.cast(kinds[name])).otherwise(F.col(name)) for name, value in changes.items()
    })


def delete_rows(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~holds(condition))


def unmatched(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Target rows whose key the source does not have."""
    condition = same_keys("t", "s", keys, null_safe)
    return target.alias("t").join(source.select(*keys).alias("s"), condition, "left_anti")


def matched(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    condition = same_keys("t", "s", keys, null_safe)
    return target.alias("t").join(source.select(*keys).alias("s"), condition, "left_semi")


def upsert_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Replace target rows by source rows of the same key and add the others.

    The source must hold each key once.  Columns only one side has are filled with null.
    """
    return unmatched(target, source, keys, null_safe).unionByName(source, allowMissingColumns=True)


def repeated_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return source.groupBy(*keys).count().where(F.col("count") > 1).drop("count")


def append_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Bag union by column name; a column missing on one side becomes null there."""
    return target.unionByName(batch, allowMissingColumns=True)


def row_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows whose compared columns differ between two tables, with both sets of values.

    ``keys`` must identify a row; null keys match each other.  ``change`` is ``insert``,
    ``update`` or ``delete``.  Rows equal on both sides cancel out in an aggregation, so
    that only changed rows are joined.
    """
    tagged = before.select(*keys, *columns, F.lit(-1).alias("_side")).unionByName(
        after.select(*keys, *columns, F.lit(1).alias("_side"))
    )
    changed = tagged.groupBy(*keys, *columns).agg(F.sum("_side").alias("_side")).where("_side != 0")
    old, new = changed.where("_side < 0").alias("old"), changed.where("_side > 0").alias("new")
    both = old.join(new, same_keys("old", "new", keys, null_safe=True), "full")
    no_old, no_new = F.col("old._side").isNull(), F.col("new._side").isNull()
    change = F.when(no_old, "insert").when(no_new, "delete").otherwise("update")
    return both.select(
        *[F.coalesce(F.col(f"old.{key}"), F.col(f"new.{key}")).alias(key) for key in keys],
        *[F.col(f"old.{c}").alias(f"{c}_before") for c in columns],
        *[F.col(f"new.{c}").alias(f"{c}_after") for c in columns],
        change.alias("change"),
    )
