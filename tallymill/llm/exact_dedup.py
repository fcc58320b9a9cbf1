"""Exact deduplication by content-defined chunk recipes.

A text without white space is cut after marks of its own content.  Its recipe is the ordered list of
its chunks' identifiers; texts are equal when their recipes are.  An identifier is a 128-bit
hash, verified: every different chunk is moved once, and if two of them shared an identifier, all would get
new ones from another seed.  After that only recipes move, never texts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import MOST_BROADCAST_KEYS, free_name, hinted, named, row_keyed, stored, stored_alone

# The characters that do not count.
SPACES = r"[\x20\x09-\x0D]+"
# A chunk ends after the first mark behind its 384th character, or after 2,048 characters.
CHUNKS = r"(?s).{384,2047}?[.,;:!?|)\]}。]|.{1,2048}"
SEEDS = 8

Identify = Callable[[Column, int], Column]


def identifier(chunk: Column, seed: int) -> Column:
    """128 bits of hash."""
    return F.struct(F.xxhash64(F.lit(seed), chunk).alias("a"), F.xxhash64(F.lit(~seed), chunk, F.length(chunk)).alias("b"))


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, "")


def chunks(text: Column) -> Column:
    """The chunks of a normalised text; joined they are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNKS), F.lit(0))


def verified_seed(texts: DataFrame, identify: Identify) -> int:
    """A seed for which no two different chunks of column ``norm`` share an identifier."""
    pieces = texts.select(F.explode(chunks(F.col("norm"))).alias("chunk"))
    for seed in range(SEEDS):
        different = pieces.select(identify(F.col("chunk"), seed).alias("id"), "chunk").distinct()
        if different.groupBy("id").count().where("count > 1").isEmpty():
            return seed
    raise RuntimeError(f"different chunks share identifiers under all of {SEEDS} seeds")


def groups(docs: DataFrame, id_col="doc_id", text_col="text", key_col: str | None = None, identify: Identify = identifier) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal if they are so without white space; null counts as empty, and empty texts are equal.
    Of a group stays the row with the most code points, then the smallest id (null ids last), then any
    one of repeated rows.  With ``key_col``, a unique column of ``docs``, the result has it as ``row_key``.
    """
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    texts = docs.select(normalised(text).alias("norm"))
    seed = verified_seed(texts, identify)
    key = named(key_col) if key_col else F.monotonically_increasing_id()
    cleaned = docs.select(
        key.alias("row_key"), named(id_col).cast("long").alias("doc_id"), F.length(text).alias("n"), normalised(text).alias("norm"),
    )
    recipes = stored(cleaned.select(
        "row_key", "doc_id", "n", F.sha2("norm", 256).alias("text_sha256"),
        F.transform(chunks(F.col("norm")), lambda c: identify(c, seed)).alias("recipe"),
    ), "recipes")
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
    # Written, so that the join has an exchange of its own and a hot group's rows can be split.
    found = stored(recipes.groupBy("recipe").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")), "groups")
    return recipes.join(found, "recipe").select(
        "row_key", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("row_key") == F.col("best.row_key")).alias("kept"), "text_sha256",
    ).select(*(["row_key"] if key_col else []), "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def exact_dedup(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one row of each group of equal texts.

    Only the keys of the rows to drop outlast the call in the scratch folder.
    """
    key = free_name(docs, "row_key")
    keyed = row_keyed(docs, key)
    dropped = stored_alone(lambda: groups(keyed, id_col, text_col, key).where(~F.col("kept")).select(F.col("row_key").alias(key)), "dropped")
    return keyed.join(hinted(dropped, MOST_BROADCAST_KEYS), key, "left_anti").select(*map(named, docs.columns))
