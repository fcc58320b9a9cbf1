"""Row validation: one pass marks every row, then valid and rejected rows are two filters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallymill.functions.columns import all_of, holds
from tallymill.operators import joins

REASONS = "reject_reasons"
VALID = "is_valid"


def flag_rows(df: DataFrame, masters: Mapping[str, DataFrame], rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reject_reasons`` (array) and ``is_valid`` to every row.

    ``masters`` maps a foreign-key column to the table that must know its values (reason
    ``unknown_<column>``); ``rules`` maps a reason to the condition that must hold, null
    meaning it does not.  Key sets are made distinct first, so a repeated master row
    cannot multiply facts.
    """
    columns = df.columns
    tests = {}
    for key, master in masters.items():
        mark = f"_known_{key}"
        known = master.select(key).where(F.col(key).isNotNull()).distinct().withColumn(mark, F.lit(True))
        df = df.join(joins.proven_small(known, joins.MOST_KEYS_BROADCAST), key, "left")
        tests[f"unknown_{key}"] = F.col(mark)
    tests.update(rules)
    # ``is_valid`` is a plain conjunction rather than "no reasons": a filter on it is split
    # into its terms, which turns the joins into inner ones and drops the reasons.
    reasons = [F.when(~holds(test), F.lit(reason)) for reason, test in tests.items()]
    return df.select(
        *columns,
        F.array_compact(F.array(*reasons)).alias(REASONS),
        all_of([holds(test) for test in tests.values()]).alias(VALID),
    )


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col(VALID)).drop(VALID, REASONS)


def rejected_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(~F.col(VALID)).drop(VALID)


def split_counts(flagged: DataFrame) -> DataFrame:
    """Rows checked, valid and rejected."""
    return flagged.agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(F.col(VALID)).alias("valid"),
        F.count_if(~F.col(VALID)).alias("rejected"),
    )


def reason_counts(flagged: DataFrame) -> DataFrame:
    return (
        flagged.select(F.explode(REASONS).alias("reason"))
        .groupBy("reason").agg(F.count(F.lit(1)).alias("rejected"))
    )
