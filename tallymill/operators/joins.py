"""Key joins of a fact table with master tables.

Spark broadcasts a side whose estimated or measured size is below its threshold and otherwise shuffles,
splitting over-full partitions of the fact side at run time (left outer, semi and anti joins allow
that).  A master that is itself a join is over-estimated, and by the time it is measured the facts are
shuffled already.  ``enrich`` therefore counts such masters first and hints those that are proven small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def with_known_key(fact: DataFrame, master: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key the master has; a null key is unknown."""
    return fact.join(master.select(key), key, "left_semi")


def without_keys_of(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in the other table; null keys stay."""
    return df.join(other.select(*keys), list(keys), "left_anti")


# Rows up to which a counted master is broadcast.  A row of masters is well below 1 KB.
MOST_BROADCAST = 50_000
# The same for keys alone, which take some 100 bytes each.
MOST_KEYS_BROADCAST = 1_000_000


def proven_small(master: DataFrame, most: int | None = None) -> DataFrame:
    """The master with a broadcast hint if it has few rows: ``most``, by default ``MOST_BROADCAST``, and one more are counted.

    With broadcasting switched off in the session nothing is hinted.
    """
    spark, most = master.sparkSession, MOST_BROADCAST if most is None else most
    off = spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    few = not off and master.limit(most + 1).count() <= most
    return F.broadcast(master) if few else master


def enrich(fact: DataFrame, masters: Mapping[str, DataFrame]) -> DataFrame:
    """Star join: add each master's columns by its key; unknown keys get nulls."""
    return reduce(lambda left, item: left.join(proven_small(item[1]), item[0], "left"), masters.items(), fact)


def full_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right, list(keys), "full")


def same_keys(left: str, right: str, keys: Sequence[str], null_safe: bool = False) -> Column:
    """Equality of the keys of two aliased tables, optionally with null equal to null."""
    def equal(key: str) -> Column:
        a, b = F.col(f"{left}.{key}"), F.col(f"{right}.{key}")
        return a.eqNullSafe(b) if null_safe else a == b
    return reduce(lambda a, b: a & b, [equal(key) for key in keys])
