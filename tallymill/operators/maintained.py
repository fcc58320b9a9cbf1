"""Grouped aggregates kept up to date from changes, without the facts that did not change.

A stored state has one row per group with the number of rows, sums, counts, and the least and most of some values.  A
change is given as rows gone and rows new (a row that is in both cancels out).  Signed sums of the change are
added to the state.  A least or most can only get lost if a row that held it is gone; such groups alone are
looked up in the facts again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tallymill.session import scratch_path

ROWS = "_rows"


@dataclass(frozen=True)
class Measures:
    """``sums`` of expressions, ``counts`` of their non-null values, ``extremes`` (least and most) by name.

    Sums must be exact (integers or decimals), as what is subtracted must be what was added.
    """

    sums: Mapping[str, Column] = field(default_factory=dict)
    counts: Mapping[str, Column] = field(default_factory=dict)
    extremes: Mapping[str, Column] = field(default_factory=dict)

    def added(self) -> list[str]:
        """State columns that add up.  A sum goes with the number of values in it: of none it is null."""
        return [ROWS, *self.sums, *[f"{name}_n" for name in self.sums], *self.counts]


def _signed(measures: Measures, sign: Column) -> list[Column]:
    """The added columns of rows, a row that is gone counting negative."""
    counted = {f"{name}_n": value for name, value in measures.sums.items()} | dict(measures.counts)
    return [
        F.sum(sign).alias(ROWS),
        *[F.sum(F.when(sign > 0, value).otherwise(-value)).alias(name) for name, value in measures.sums.items()],
        *[F.sum(F.when(value.isNotNull(), sign).otherwise(F.lit(0))).alias(name) for name, value in counted.items()],
    ]


def summary(facts: DataFrame, keys: Mapping[str, Column], measures: Measures) -> DataFrame:
    """The state of some facts.  Null keys are groups like any other."""
    return facts.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(
        *_signed(measures, F.lit(1).cast("long")),
        *[f(value).alias(f"{side}_{name}") for name, value in measures.extremes.items() for side, f in (("least", F.min), ("most", F.max))],
    )


def change_summary(gone: DataFrame, new: DataFrame, keys: Mapping[str, Column], measures: Measures) -> DataFrame:
    """Signed sums of a change, and the least and most of the rows gone and of those new."""
    sign = F.col("_sign")
    rows = gone.withColumn("_sign", F.lit(-1).cast("long")).unionByName(new.withColumn("_sign", F.lit(1).cast("long")), allowMissingColumns=True)
    bounds = []
    for name, value in measures.extremes.items():
        for when, of in (("gone", sign < 0), ("new", sign > 0)):
            bounds += [F.min(F.when(of, value)).alias(f"{when}_least_{name}"), F.max(F.when(of, value)).alias(f"{when}_most_{name}")]
    return rows.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(*_signed(measures, sign), *bounds)


def refreshed(state: DataFrame, gone: DataFrame, new: DataFrame, facts: DataFrame, keys: Mapping[str, Column], measures: Measures) -> DataFrame:
    """The state after a change.  ``facts`` are all rows after it; they are read only if some group lost a least or most."""
    change = change_summary(gone, new, keys, measures)
    # Both have a row per group at most, and one aggregation puts them together: null keys are equal in it.
    both = state.unionByName(change, allowMissingColumns=True)
    extremes = [f"{side}_{name}" for name in measures.extremes for side in ("least", "most")]
    met = both.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in measures.added()],
        *[_any(name).alias(name) for e in extremes for name in (e, f"gone_{e}", f"new_{e}")],
    ).where(F.col(ROWS) > 0)
    lost = F.lit(False)
    for e in extremes:
        old, left, came = F.col(e), F.col(f"gone_{e}"), F.col(f"new_{e}")
        held = came <= old if e.startswith("least") else came >= old
        lost = lost | (left.eqNullSafe(old) & old.isNotNull() & ~F.coalesce(held, F.lit(False)))
    now = [(F.least if e.startswith("least") else F.greatest)(e, f"new_{e}").alias(e) for e in extremes]
    if not extremes:  # nothing can get lost
        return met.select(*keys, *measures.added())
    spark = state.sparkSession
    path = scratch_path(spark, "refreshed")
    met.select(*keys, *measures.added(), *now, lost.alias("_lost")).write.parquet(path)
    written = spark.read.parquet(path)
    sure, unsure = written.where("not _lost").drop("_lost"), written.where("_lost").drop("_lost")
    if unsure.isEmpty():
        return sure
    again = summary(_of_groups(facts, unsure, keys), keys, measures)
    return sure.unionByName(again)


def _any(name: str) -> Column:
    """The one value that is there: the state and the change have different columns of this kind."""
    return F.max(name)


def _of_groups(facts: DataFrame, groups: DataFrame, keys: Mapping[str, Column]) -> DataFrame:
    """Facts of the given groups.  Where a key is a partition column, Spark reads only its values' folders."""
    marked = groups.select(*[F.col(k).alias(f"_group_{k}") for k in keys])
    same = F.lit(True)
    for k, column in keys.items():
        same = same & column.eqNullSafe(F.col(f"_group_{k}"))
    return facts.join(marked, same, "left_semi")


def plain_sums(state: DataFrame, measures: Measures) -> DataFrame:
    """The state with sums of no values as null, as ``sum`` has them."""
    return state.withColumns({name: F.when(F.col(f"{name}_n") > 0, F.col(name)) for name in measures.sums})
