"""Line deduplication with a suffix array over line numbers.

Suffixes of the documents' line sequences are ranked by prefix doubling: lines that occur once end every
repeated run and are left out; the others get the rank of their line, and a rank of h lines becomes one
of up to 2h by sorting pairs of ranks.  Suffixes with the same rank after ``least`` lines are an interval of
the array whose common prefixes have at least so many lines.  Every repeated run of that or greater
length is a union of such windows, so doubling stops there.  All copies but the first lose their lines.
A line that is long by itself can be a run as well: with ``long_words``, later copies of such lines go whatever
their neighbours are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import free_name, named, stored

# Fewest lines of a repeated run that is deleted.
LEAST_LINES = 2
# Words of a line that queries treat as a run by itself.
LONG_WORDS = 50
PLACE = ["o", "k", "i"]


def _placed(docs: DataFrame, id_col: str, text_col: str):
    """The text, its lines, and what orders the documents: the id (null last), then a hash of the row."""
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    order = F.coalesce(named(id_col).cast("long"), F.lit(2**63 - 1))
    return F.split(text, "\n", -1), order, F.xxhash64(named(id_col).cast("long"), text)


def _ranked(groups: DataFrame, *keys: str) -> DataFrame:
    """Distinct keys that occur more than once, with their rank, ``new``: numbers that ascend as the keys do."""
    repeated = groups.groupBy(*keys).count().where("count > 1").drop("count")
    return stored(repeated.orderBy(*keys).withColumn("new", F.monotonically_increasing_id()), "ranks")


def _is_long(line, long_words: int):
    """Has the line so many words (parts between white space)?"""
    return F.size(F.filter(F.split(line, r"[\x09-\x0D\x20]+"), lambda word: word != "")) >= long_words


def repeated_windows(docs: DataFrame, least: int = LEAST_LINES, id_col="doc_id", text_col="text") -> DataFrame:
    """``o``, ``k``, ``i``, ``rank``: where a window of ``least`` lines begins that occurs elsewhere as well."""
    if least < 1:
        raise ValueError("a run has at least one line")
    lines, order, key = _placed(docs, id_col, text_col)
    placed = docs.select(order.alias("o"), key.alias("k"), F.posexplode(lines).alias("i", "line"))
    # 128 bits of hash stand for a line.
    ids = placed.select(*PLACE, F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line", F.length("line")).alias("b"))
    # Repeated rows are one document: its places are counted once.
    first = ids.join(_ranked(ids, "a", "b"), ["a", "b"]).select(*PLACE, F.col("new").alias("rank")).distinct()
    suffixes, length = stored(first, "suffixes"), 1
    while length < least:
        shift = min(length, least - length)
        behind = suffixes.select("o", "k", (F.col("i") - shift).alias("i"), F.col("rank").alias("next"))
        pairs = stored(suffixes.join(behind, PLACE), "pairs")
        suffixes = stored(pairs.join(_ranked(pairs, "rank", "next"), ["rank", "next"]).select(*PLACE, F.col("new").alias("rank")), "suffixes")
        length += shift
    return suffixes


def _later_long_lines(docs: DataFrame, long_words: int, id_col: str, text_col: str) -> DataFrame:
    """``o``, ``k``, ``i`` of the lines of so many words that an earlier place has as well."""
    lines, order, key = _placed(docs, id_col, text_col)
    placed = docs.select(order.alias("o"), key.alias("k"), F.posexplode(lines).alias("i", "line")).where(_is_long(F.col("line"), long_words))
    # 128 bits of hash stand for a line, as above; repeated rows are one document.
    ids = placed.select(*PLACE, F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line", F.length("line")).alias("b"))
    ids = stored(ids.distinct(), "long-lines")
    # Written for the same reason as ``first`` below.
    first = stored(ids.groupBy("a", "b").agg(F.min(F.struct(*PLACE)).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "first-long")
    return ids.join(first, ["a", "b"]).where(F.struct(*PLACE) != F.col("first")).select(*PLACE)


def delete_repeated_runs(docs: DataFrame, least: int = LEAST_LINES, id_col="doc_id", text_col="text", long_words: int | None = None) -> DataFrame:
    """All rows and columns of ``docs`` without the later copies of repeated runs of ``least`` or more lines.

    Two columns come behind (replacing such of the same name): ``n_lines`` before, and ``deleted``, the ascending
    numbers of the deleted lines from 0.  The copy that stays is the one of the smallest id (null last), there the
    earliest.  A null text is left null and counts as one empty line.  Repeated rows are one document: each
    is treated as the first of them.  With ``long_words`` a later copy of a single line of so many words goes
    too, also where the run about it is shorter than ``least``.
    """
    if long_words is not None and long_words < 1:
        raise ValueError("a long line has at least one word")
    windows = repeated_windows(docs, least, id_col, text_col)
    # Written, so that the join has an exchange of its own and a frequent run's places can be split.
    first = stored(windows.groupBy("rank").agg(F.min(F.struct(*PLACE)).alias("first")), "first")
    later = windows.join(first, "rank").where(F.struct(*PLACE) != F.col("first"))
    gone = later.select("o", "k", F.explode(F.sequence("i", F.col("i") + (least - 1))).alias("i"))
    if long_words is not None:
        gone = gone.select("o", "k", "i").unionByName(_later_long_lines(docs, long_words, id_col, text_col))
    held = docs.drop("n_lines", "deleted")
    o, k, d = (free_name(held, x) for x in ("o", "k", "d"))
    gone = gone.groupBy(F.col("o").alias(o), F.col("k").alias(k)).agg(F.sort_array(F.collect_set("i")).alias(d))
    lines, order, key = _placed(held, id_col, text_col)
    joined = held.withColumns({o: order, k: key}).join(gone, [o, k], "left")
    kept = F.array_join(F.filter(lines, lambda line, i: ~F.array_contains(F.col(d), i)), "\n")
    text = F.when(F.col(d).isNull(), named(text_col)).otherwise(kept)
    columns = [text.alias(c) if c == text_col else named(c) for c in held.columns]
    return joined.select(*columns, F.size(lines).alias("n_lines"), F.coalesce(d, F.array().cast("array<int>")).alias("deleted"))
