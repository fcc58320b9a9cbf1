"""Exact descriptive statistics without collecting a column into one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallymill.session import scratch_path

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}

# Different values that one task orders at most.
MOST_ORDERED = 50_000
# In a round values are cut into _STEP * _STEP ranges, found by two searches of _STEP comparisons.
_STEP = 16


def describe(df: DataFrame, measures: Sequence[str], percentiles: Mapping[str, float] = QUARTILES) -> DataFrame:
    """count, mean, std (sample), min, interpolated percentiles and max of each measure."""
    return (
        _moments(df, measures).join(exact_percentiles(df, measures, percentiles), "measure", "left")
        .select("measure", "count", "mean", "std", "min", *percentiles, "max")
    )


def _moments(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    def summary(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("measure"), F.count(value).alias("count"), F.mean(value).alias("mean"),
            F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"),
        )
    rows = df.agg(F.array(*[summary(name) for name in measures]).alias("rows"))
    return rows.select(F.inline("rows"))


@dataclass(frozen=True)
class _Search:
    """Values of a measure from ``least`` to ``most`` (all, if None) among which some wanted ranks lie."""

    measure: str
    least: float | None
    most: float | None
    before: int
    distinct: int
    ranks: tuple[int, ...]

    def holds(self) -> Column:
        inside = F.col("measure") == F.lit(self.measure)
        if self.least is not None:
            inside = inside & (F.col("value") >= F.lit(self.least)) & (F.col("value") <= F.lit(self.most))
        return inside


def exact_percentiles(df: DataFrame, measures: Sequence[str], percentiles: Mapping[str, float]) -> DataFrame:
    """Linearly interpolated percentiles, one row per measure and one column per percentile.

    The columns are reduced to (measure, value, occurrences), written once.  A wanted rank is then searched for in
    rounds: the values left are cut into ranges at approximate quantiles, and the range that holds the rank is what is left for the
    next round, until at most ``MOST_ORDERED`` different values are, which are ordered.  The approximation decides how
    even the ranges are, not the result.  Only the ranges' counts and bounds pass through the driver.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "values")
    (
        df.select(*[F.col(name).cast("double").alias(name) for name in measures])
        .unpivot([], list(measures), "measure", "value")
        .where(F.col("value").isNotNull())
        .groupBy("measure", "value").agg(F.count(F.lit(1)).alias("occurs"))
        .write.parquet(path)
    )
    values = spark.read.schema("measure string, value double, occurs long").parquet(path)
    totals = values.groupBy("measure").agg(F.sum("occurs").alias("total"), F.count(F.lit(1)).alias("distinct")).collect()
    places = {row["measure"]: {name: p * (row["total"] - 1) for name, p in percentiles.items()} for row in totals}
    searches = [
        _Search(row["measure"], None, None, 0, row["distinct"], tuple(sorted({f(at) for at in places[row["measure"]].values() for f in (math.floor, math.ceil)})))
        for row in totals
    ]
    while any(s.distinct > MOST_ORDERED for s in searches):
        searches = [s for s in searches if s.distinct <= MOST_ORDERED] + _narrowed(values, [s for s in searches if s.distinct > MOST_ORDERED])
    wanted = [
        (k, rank, s.measure, name, float(at)) for k, s in enumerate(searches) for rank in s.ranks
        for name, at in places[s.measure].items() if rank in (math.floor(at), math.ceil(at))
    ]
    targets = spark.createDataFrame(wanted, "search int, rank long, measure string, name string, at double")
    upto = _before(searches) + F.sum("occurs").over(Window.partitionBy("search").orderBy("value"))
    ordered = _searched(values, searches).select("search", "value", "occurs", upto.alias("upto"))
    # As many rows as there are percentiles, twice at most.
    hits = ordered.join(F.broadcast(targets), "search").where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("occurs")))

    def interpolated(name: str) -> Column:
        value = F.when(F.col("name") == name, F.col("value"))
        share = F.max(F.when(F.col("name") == name, F.col("at") - F.floor("at")))
        return (F.min(value) + (F.max(value) - F.min(value)) * share).alias(name)
    return hits.groupBy("measure").agg(*[interpolated(name) for name in percentiles])


def _searched(values: DataFrame, searches: Sequence[_Search]) -> DataFrame:
    """The values of any search, with its number."""
    number, some = F.lit(None).cast("int"), F.lit(False)
    for k, search in enumerate(searches):
        number, some = F.when(search.holds(), k).otherwise(number), some | search.holds()
    return values.where(some).withColumn("search", number)


def _before(searches: Sequence[_Search]) -> Column:
    return F.element_at(F.array(*[F.lit(s.before) for s in searches] or [F.lit(0)]), F.col("search") + 1)


def _narrowed(values: DataFrame, searches: list[_Search]) -> list[_Search]:
    """The ranges of the searches' values that hold their ranks."""
    left = _searched(values, searches)
    steps = [i / _STEP**2 for i in range(1, _STEP**2)]
    # One row per search.
    cuts = left.groupBy("search").agg(F.percentile_approx("value", steps, 10_000).alias("cuts"))
    ranged = left.join(F.broadcast(cuts), "search").groupBy("search", _range("value", "cuts").alias("range"))
    found = ranged.agg(
        F.sum("occurs").alias("size"), F.count(F.lit(1)).alias("distinct"), F.min("value").alias("least"), F.max("value").alias("most"))
    out, before = [], {k: s.before for k, s in enumerate(searches)}
    for row in found.orderBy("search", "range").collect():  # at most _STEP**2 for each search
        search, start = searches[row["search"]], before[row["search"]]
        before[row["search"]] = end = start + row["size"]
        ranks = tuple(r for r in search.ranks if start <= r < end)
        if ranks:
            out.append(_Search(search.measure, row["least"], row["most"], start, row["distinct"], ranks))
    return out


def _range(value: str, cuts: str) -> Column:
    """Number of cut points below the value: first in steps of _STEP, then one by one."""
    below = lambda cut: cut < F.col(value)
    marks = F.array(*[F.element_at(cuts, i * _STEP) for i in range(1, _STEP)])
    block = F.size(F.filter(marks, below))
    return block * _STEP + F.size(F.filter(F.slice(cuts, block * _STEP + 1, _STEP), below))
