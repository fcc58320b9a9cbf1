"""Phrases whose words go together, from exact counts of n-grams in quotient filters.

Words that are frequent enough get numbers.  Texts become blocks of numbers, with a 0 wherever no phrase can
go on.  Counting then goes by length: an n-gram is packed as the number of the frequent n-gram one word shorter that it begins with and the number
of its last word, and counted only where both its shorter parts are frequent, as otherwise it cannot be.
A task counts its n-grams in a quotient filter (:mod:`quotient_filter`); filters are cut by leading
bits, parts of equal bits meet in one task and are merged, and what is frequent gets numbers in turn.

Numbers go to the blocks by broadcasting while they are few; beyond that each block asks for its own by a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymill.llm.common import ROWS_AT_A_TIME, named, small_side, stored
from tallymill.llm.quotient_filter import Filter
from tallymill.operators.ranking import with_row_numbers

LEAST, LONGEST, TOP = 100, 5, 2000
# What parts pieces (words are parted by space and tab).
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_TO_LINES = bytes.maketrans(PIECE_ENDS, b"\n" * len(PIECE_ENDS))

# Different words that a task counts before it passes them on.
WORDS_AT_ONCE = 400_000
# Numbers in a block, and keys that a task puts in one filter, at most.
BLOCK_NUMBERS = 1_000_000
KEYS_AT_ONCE = 4_000_000
# Keys that meet in one task on average.
SHARD_KEYS = 1_000_000
# Filters are cut by so many bits at a time, so that their parts stay large.
CUT_BITS = 8
# Frequent words and n-grams that are broadcast at most (of n-grams 16 bytes each).
MOST_WORDS, MOST_GRAMS = 500_000, 4_000_000


def pieces(text: str) -> list[list[bytes]]:
    """The words of each piece, A-Z as a-z."""
    return [piece.split() for piece in text.encode("utf-8").lower().translate(_TO_LINES).split(b"\n")]


def _texts(docs: DataFrame, text_col: str, lang_col: str | None) -> DataFrame:
    lang = F.coalesce(named(lang_col).cast("string"), F.lit("und")) if lang_col else F.lit("und")
    return docs.select(lang.alias("lang"), F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_A_TIME):
            yield from zip(*(c.to_pylist() for c in batch.slice(start, ROWS_AT_A_TIME).columns))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts by language and word; of all words of a language with word null."""
    counts: dict[str, Counter] = {}

    def passed_on():
        for lang, found in counts.items():
            words = [None, *found]
            numbers = [sum(found.values()), *found.values()]
            for k in range(0, len(words), 1 << 16):
                part = words[k:k + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part)), pa.array(part, pa.binary()).cast(pa.string()), pa.array(numbers[k:k + (1 << 16)], pa.int64())], names=["lang", "word", "n"])
        counts.clear()
    for lang, text in _rows(batches):
        own = counts.setdefault(lang, Counter())
        for piece in pieces(text):
            own.update(piece)
        if sum(map(len, counts.values())) > WORDS_AT_ONCE:
            yield from passed_on()
    yield from passed_on()


class _Blocks:
    """Gathers the numbers of texts into blocks; a text stays whole, so a very long one is a block of its own."""

    def __init__(self) -> None:
        self.task, self.made, self.parts, self.size = TaskContext.get().partitionId(), 0, [], 0

    def add(self, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
        if self.size + len(numbers) > BLOCK_NUMBERS:
            yield from self.close()
        self.parts.append(numbers)
        self.size += len(numbers)

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            yield _block(self.task << 24 | self.made, np.concatenate(self.parts), None)
            self.made, self.parts, self.size = self.made + 1, [], 0


BLOCKS = "block long, n long, words binary, grams binary"


def _squeezed(numbers: np.ndarray) -> bytes:
    return zstandard.compress(numbers.astype("<i4").tobytes(), 1)


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<i4").astype(np.int64)


def _block(block: int, words: np.ndarray, grams: np.ndarray | None) -> pa.RecordBatch:
    packed = [pa.array([None if x is None else _squeezed(x)], pa.binary()) for x in (words, grams)]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([len(words)], pa.int64()), *packed], names=["block", "n", "words", "grams"])


def _thinned(words: np.ndarray, grams: np.ndarray | None, size: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Without the words in no frequent n-gram of ``size`` words; a 0 stands for any number of them."""
    starts = words if grams is None else grams
    edges = np.zeros(len(words) + size, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + size, -1)
    inside = np.cumsum(edges)[:len(words)] > 0
    words = np.where(inside, words, 0)
    kept = inside | np.concatenate([[True], inside[:-1]])
    return words[kept], None if grams is None else grams[kept]


def _encoder(known: dict[str, dict[bytes, int]]) -> Callable[[str, str], np.ndarray]:
    """Numbers of a text's words, 0 for words that are not frequent and behind each piece."""
    def run(lang: str, text: str) -> np.ndarray:
        number, out = known.get(lang, {}).get, []
        for piece in pieces(text):
            out += [number(word, 0) for word in piece]
            out.append(0)
        return _thinned(np.array(out, np.int64), None, 1)[0]
    return run


def _by_lang(lang: list[str], words: list[str], numbers: list[int]) -> dict[str, dict[bytes, int]]:
    known: dict[str, dict[bytes, int]] = {}
    for of, word, number in zip(lang, words, numbers):
        known.setdefault(of, {})[word.encode("utf-8")] = number
    return known


def _encoded(texts: DataFrame, words: DataFrame, most: int) -> DataFrame:
    """Blocks of numbers of all texts."""
    if words.count() <= most:
        table = words.select("lang", "word", "id").toArrow()  # at most ``most`` words
        shared = texts.sparkSession.sparkContext.broadcast(_by_lang(*(c.to_pylist() for c in table.columns)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks, encode = _Blocks(), _encoder(shared.value)
            for lang, text in _rows(batches):
                yield from blocks.add(encode(lang, text))
            yield from blocks.close()
        return texts.mapInArrow(run, BLOCKS)

    keyed = stored(texts.withColumn("row", F.monotonically_increasing_id()), "texts")

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, lang, text in _rows(batches):
            found = sorted({word for piece in pieces(text) for word in piece})
            yield pa.RecordBatch.from_arrays([pa.array([row] * len(found), pa.int64()), pa.array([lang] * len(found), pa.string()), pa.array(found, pa.binary()).cast(pa.string())], names=["row", "lang", "word"])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks()
        for lang, text, found in _rows(batches):
            known = {lang: {x["word"].encode("utf-8"): x["id"] for x in found or []}}
            yield from blocks.add(_encoder(known)(lang, text))
        yield from blocks.close()

    asked = keyed.select("row", "lang", "text").mapInArrow(different, "row long, lang string, word string")
    # A text's list is as long as the text at most.
    found = asked.join(words, ["lang", "word"]).groupBy("row").agg(F.collect_list(F.struct("word", "id")).alias("found"))
    return keyed.join(found, "row", "left").select("lang", "text", "found").mapInArrow(own, BLOCKS)


def _keys(words: np.ndarray, grams: np.ndarray | None, size: int, word_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Where n-grams of ``size`` words with frequent shorter parts begin, and the keys that they are packed in."""
    if len(words) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = words if grams is None else grams
    at = np.flatnonzero((starts[:len(words) - size + 1] != 0) & (starts[1:len(words) - size + 2] != 0))
    return at, (starts[at] << word_bits) | words[at + size - 1]


PIECE = "shard long, filter binary"


def _cut(filters: Filter, more: int, shard: int = 0) -> Iterator[pa.RecordBatch]:
    for number, part in filters.split(more):
        yield pa.RecordBatch.from_arrays([pa.array([shard << more | number], pa.int64()), pa.array([part.pack()], pa.binary())], names=["shard", "filter"])


def count_keys(blocks: DataFrame, keys_of: Callable[[bytes, bytes | None], np.ndarray], bits: int, total: int, least: int) -> DataFrame:
    """``key``, ``n`` of the keys of all blocks that are there ``least`` times or more.

    ``total`` is how many keys there are at most; it decides into how many parts filters are cut.
    """
    lead = min(bits, max(0, (total // SHARD_KEYS).bit_length()))
    done = min(lead, CUT_BITS)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for words, grams in _rows(batches):
            found = keys_of(words, grams)
            for start in range(0, len(found), KEYS_AT_ONCE):
                part = found[start:start + KEYS_AT_ONCE]
                if size and size + len(part) > KEYS_AT_ONCE:
                    yield from _cut(Filter.of(np.concatenate(waiting), bits), done)
                    waiting, size = [], 0
                waiting.append(part)
                size += len(part)
        if size:
            yield from _cut(Filter.of(np.concatenate(waiting), bits), done)

    parts = blocks.select("words", "grams").mapInArrow(counted, PIECE)
    while done < lead:
        parts, done = _finer(parts, min(lead, done + CUT_BITS) - done), min(lead, done + CUT_BITS)

    def merged(table: pa.Table) -> pa.Table:
        whole = Filter.merged([Filter.unpack(x) for x in table.column("filter").to_pylist()])
        often = whole.counts >= least
        few = Filter(whole.bits, whole.lead, whole.mixed[often], whole.counts[often])
        return pa.table({"key": pa.array(few.keys(table.column("shard")[0].as_py())), "n": pa.array(few.counts)})
    return parts.groupBy("shard").applyInArrow(merged, "key long, n long")


def _finer(parts: DataFrame, more: int) -> DataFrame:
    """Filters of equal leading bits merged as far as a task may hold them, and cut by ``more`` bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, of = [], 0, None
        for shard, data in _rows(batches):
            part = Filter.unpack(data)
            if waiting and (shard != of or size + len(part.mixed) > KEYS_AT_ONCE):
                yield from _cut(Filter.merged(waiting), more, of)
                waiting, size = [], 0
            waiting.append(part)
            size, of = size + len(part.mixed), shard
        if waiting:
            yield from _cut(Filter.merged(waiting), more, of)
    return parts.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, PIECE)


def _with_grams(blocks: DataFrame, frequent: DataFrame, size: int, word_bits: int, most: int) -> DataFrame:
    """Blocks thinned to the frequent n-grams of ``size`` words, with the numbers of these."""
    def narrowed(block: int, words: np.ndarray, grams: np.ndarray | None, keys: np.ndarray, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
        at, wanted = _keys(words, grams, size, word_bits)
        place = np.searchsorted(keys, wanted).clip(0, max(len(keys) - 1, 0))
        there = keys[place] == wanted if len(keys) else np.zeros(len(wanted), bool)
        found = np.zeros(len(words), np.int64)
        found[at[there]] = numbers[place[there]]
        if there.any():
            yield _block(block, *_thinned(words, found, size))

    def unpacked(words: bytes, grams: bytes | None) -> tuple[np.ndarray, np.ndarray | None]:
        return _numbers(words), None if grams is None else _numbers(grams)

    if frequent.count() <= most:
        table = frequent.select("key", "id").orderBy("key").toArrow()  # at most ``most`` rows
        shared = blocks.sparkSession.sparkContext.broadcast(tuple(c.to_numpy() for c in table.columns))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, words, grams in _rows(batches):
                yield from narrowed(block, *unpacked(words, grams), *shared.value)
        return blocks.select("block", "words", "grams").mapInArrow(run, BLOCKS)

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, words, grams in _rows(batches):
            keys = np.unique(_keys(*unpacked(words, grams), size, word_bits)[1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), block)), pa.array(keys)], names=["block", "key"])

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, words, grams, found in _rows(batches):
            pairs = np.array(sorted((x["key"], x["id"]) for x in found), np.int64).reshape(-1, 2)
            yield from narrowed(block, *unpacked(words, grams), pairs[:, 0], pairs[:, 1])

    asked = blocks.select("block", "words", "grams").mapInArrow(different, "block long, key long")
    # A block's list is as long as the block at most.
    found = asked.join(frequent, "key").groupBy("block").agg(F.collect_list(F.struct("key", "id")).alias("found"))
    return blocks.join(found, "block").select("block", "words", "grams", "found").mapInArrow(own, BLOCKS)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_col="text", lang_col: str | None = "lang",
                     most_words: int = MOST_WORDS, most_grams: int = MOST_GRAMS) -> tuple[DataFrame, DataFrame]:
    """Phrases (``lang``, ``words``, ``f``) of up to ``longest`` words that are there ``least`` times or more, and ``lang``, ``n`` of all words.

    Repeated rows count as often as they are there; a null text has no words, a null language is ``und``.
    """
    texts = _texts(docs, text_col, lang_col)
    counts = texts.mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts = stored(counts.where(F.col("word").isNull() | (F.col("n") >= least)), "words")
    totals = counts.where("word is null").select("lang", "n")
    words = stored(with_row_numbers(counts.where("word is not null"), "id"), "numbered")
    named_by = words.select("lang", F.array("word").alias("words"), F.col("n").alias("f"), "id")
    phrases = named_by.drop("id")
    n_words = words.count()
    word_bits = n_words.bit_length()
    blocks, n_grams = stored(_encoded(texts, words, most_words), "blocks"), n_words
    for size in range(2, longest + 1):
        if not n_grams:
            break

        def keys_of(own: bytes, grams: bytes | None, size=size) -> np.ndarray:
            return _keys(_numbers(own), None if grams is None else _numbers(grams), size, word_bits)[1]

        total = blocks.agg(F.sum("n")).collect()[0][0] or 0
        found = count_keys(blocks, keys_of, n_grams.bit_length() + word_bits, total, least)
        frequent = stored(with_row_numbers(found, "id"), "grams")
        n_grams = frequent.count()
        parted = frequent.select("id", F.col("n").alias("f"), F.shiftright("key", word_bits).alias("before"), F.col("key").bitwiseAND(F.lit((1 << word_bits) - 1)).alias("last"))
        before = named_by.select(F.col("id").alias("before"), "lang", "words")
        last = words.select(F.col("id").alias("last"), "word")
        named_by = stored(parted.join(before, "before").join(last, "last").select("lang", F.concat("words", F.array("word")).alias("words"), "f", "id"), "phrases")
        phrases = phrases.unionByName(named_by.drop("id"))
        if size < longest and n_grams:
            blocks = stored(_with_grams(blocks, frequent.select("key", "id"), size, word_bits, most_grams), "blocks")
    return phrases, totals


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, text_col="text", lang_col: str | None = "lang",
                 most_words: int = MOST_WORDS, most_grams: int = MOST_GRAMS) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's first ``top`` phrases.

    Candidates are the phrases of two words or more.  A cut behind the first words gives ``l`` and ``r``, the counts of both parts, and
    floor(1000 * a * n / (l * r)); the lowest counts, of ties the earliest cut.  A phrase inside a longer one that is
    there as often is left out.  Phrases are ordered by score, then ``a`` (both descending), then by their bytes.
    Counts are exact; products are decimals of 38 digits.  Nulls, repeated rows: see :func:`frequent_phrases`.
    Texts without frequent phrases, or an empty table, give no rows.
    """
    phrases, totals = frequent_phrases(docs, least, longest, text_col, lang_col, most_words, most_grams)
    every = stored(phrases.select("lang", "words", F.array_join("words", " ").alias("phrase"), F.size("words").alias("size"), "f"), "every")
    found = every.where("size > 1")
    # Only phrases one word shorter need looking at: what lies between is as frequent.
    inner = found.where("size > 2").select("lang", "f", F.explode(F.array(
        F.expr("slice(words, 1, size - 1)"), F.expr("slice(words, 2, size - 1)"))).alias("words"))
    covered = inner.groupBy("lang", F.array_join("words", " ").alias("phrase")).agg(F.max("f").alias("longer"))
    open_ones = found.join(covered, ["lang", "phrase"], "left").where("longer is null or longer < f").drop("longer")
    cuts = open_ones.withColumn("cut", F.explode(F.expr("sequence(1, size - 1)"))).select(
        "lang", "phrase", F.col("f").alias("a"), "cut",
        F.expr("array_join(slice(words, 1, cut), ' ')").alias("first"), F.expr("array_join(slice(words, cut + 1, size - cut), ' ')").alias("rest"))
    cuts = stored(cuts, "cuts")  # so that the rows of a frequent part can be split in the joins
    part = every.select("lang", F.col("phrase").alias("part"), F.col("f").alias("of_part"))
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(part.select("lang", F.col("part").alias(side), F.col("of_part").alias(name)), ["lang", side])
    sums = small_side(totals.select(F.col("lang").alias("of"), "n"))
    cuts = cuts.join(sums, F.col("lang") == F.col("of")).withColumn("score", F.expr(
        "cast(1000 as decimal(4)) * cast(a as decimal(19)) * cast(n as decimal(19)) div (cast(l as decimal(19)) * cast(r as decimal(19)))"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
