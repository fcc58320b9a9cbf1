"""Mixing sources to target weights by Poisson replication.

A document of a source whose target rate is r appears Poisson(r) times: a uniform number made from its
id by a hash is looked up in the distribution's cumulative table.  No document needs to know of
another; only the sources' sizes are summed.  Copies are then shuffled globally by a hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import free_name, named, stored

# A mean above this is drawn as the sum of several draws, as exp(-mean) would vanish.
MOST_MEAN = 300.0
SEED = 17
# With more sources than this their tables are not broadcast but joined by shuffling.
MOST_BROADCAST = 10_000


def target_rates(docs: DataFrame, source_col="source", text_col="text", weights: DataFrame | None = None, temperature=0.5) -> DataFrame:
    """``source``, ``rate``: how often a document of the source is to appear on average.

    A source's size is its texts' characters, a text counting one at least; null is a source of its
    own.  ``weights`` (``source``, ``weight``) are the wanted shares; without it they follow size to
    the power ``temperature``.  Sources without a positive weight get rate 0.  All copies together
    have the size of all documents on average.
    """
    size = F.greatest(F.length(F.coalesce(named(text_col).cast("string"), F.lit(""))), F.lit(1))
    sizes = docs.select(named(source_col).cast("string").alias("source"), size.alias("size")).groupBy("source").agg(F.sum("size").alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow("size", F.lit(temperature)))
    else:
        wanted = weights.groupBy(named("source").alias("wanted")).agg(F.sum("weight").alias("weight"))
        weighed = sizes.join(wanted, F.col("source").eqNullSafe(F.col("wanted")), "left").drop("wanted")
        weighed = weighed.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)))
    whole = weighed.agg(F.sum("size").alias("all_size"), F.sum("weight").alias("all_weight"))
    # One row, so the join only appends two numbers.
    rate = F.col("weight") / F.col("all_weight") * F.col("all_size") / F.col("size")
    return weighed.join(F.broadcast(whole)).select("source", F.when(F.col("all_weight") > 0, rate).otherwise(0.0).alias("rate"))


def poisson_table(mean: Column) -> Column:
    """P(count <= k) for k = 0, 1, ... until nothing is left that a double near 1 could show."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))

    def step(state, k):
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(state["c"], F.array(F.element_at(state["c"], -1) + p)).alias("c"))
    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["c"])


def uniform(*parts: Column) -> Column:
    """52 bits of a hash of the parts' texts, as a number from 0 to below 1."""
    digest = F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def mix(docs: DataFrame, rates: DataFrame, id_col="doc_id", source_col="source", seed: int = SEED) -> DataFrame:
    """All columns of ``docs`` with ``copy`` (int, from 1) and ``shuffle_key``, once for each copy, in shuffled order.

    Columns of these names are replaced.  Rows of equal id and source have equal numbers of copies; a
    null id is an id of its own.  Sources that ``rates`` lacks have no copies.
    """
    held = docs.drop("copy", "shuffle_key")
    at, table = free_name(held, "at"), free_name(held, "table")
    draws = F.greatest(F.ceil(F.col("rate") / MOST_MEAN), F.lit(1)).cast("int")
    tables = rates.where("rate > 0").select(
        F.struct(F.col("source").alias("source")).alias(at), F.struct(draws.alias("draws"), poisson_table(F.col("rate") / draws).alias("c")).alias(table))
    tables = stored(tables, "rates")
    if tables.count() <= MOST_BROADCAST:
        tables = F.broadcast(tables)
    joined = held.join(tables, named(source_col).cast("string").eqNullSafe(F.col(f"{at}.source")))

    def drawn(k):
        u = uniform(F.lit(seed), named(id_col), k)
        return F.size(F.filter(F.col(f"{table}.c"), lambda c: c <= u))
    n = F.aggregate(F.sequence(F.lit(1), F.col(f"{table}.draws")), F.lit(0), lambda total, k: total + drawn(k))
    copies = joined.withColumn(at, n).where(F.col(at) > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col(at))))
    key = F.md5(F.concat_ws(":", F.lit("order"), F.lit(seed), F.coalesce(named(id_col).cast("string"), F.lit("null")), F.col("copy")))
    keyed = copies.select(*[named(c) for c in held.columns], "copy", key.alias("shuffle_key"))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
