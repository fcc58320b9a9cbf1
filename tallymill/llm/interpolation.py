"""Language-model scores by deleted interpolation of bigrams.

The probability of a word behind another is a mixture of the bigram's and the word's shares in the
training documents and an even share.  Mixture weights depend on how often the context occurred (by powers of two)
and are learned by expectation-maximisation on the held-out documents.

Counting at scale: documents are packed into blocks of bounded size.  A block gives the distinct n-grams that it
needs, as sorted hashes with its own training counts, in ranges of the hash.  A task adds up one range
over all blocks and gives each block its totals, in the block's own order.  So each distinct n-gram of a block
moves once, and totals need no names on their way back.  A block is cut into a bounded number of ranges; where more are
needed, the pieces that groups of blocks have in one range are merged into pieces of a block's size, which are cut
further and hand their totals down again.  So a block has as many pieces whatever the input's size is, once for each
such round, of which there are as many as the logarithm of the number of ranges to the base ``MOST_RANGES``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import ROWS_AT_A_TIME, id_and_text, stored
from tallymill.llm.shingles import mixed

# Characters of a block at most (a longer document is a block of its own).
BLOCK_CHARS = 4_000_000
# N-grams, counted once for each block, in one range of hashes on average.
RANGE_GRAMS = 600_000
# Ranges that a block is cut into at a time, at most, and so many blocks' pieces are merged where more are needed.
MOST_RANGES = 1024
# The base model's addend, and the share of documents (by crc32) that are held out.
ADDED, HELD_ONE_IN = 0.1, 10
LEVELS = 48
STEPS = 15
# No weight of the even share is below this, so that no text is impossible.
LEAST_EVEN = 1e-6

BEGIN, END = np.uint64(1), np.uint64(2)
DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])


def held_out(doc_id: int | None) -> bool:
    """Whether the document is held out; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % HELD_ONE_IN == 0


def _squeeze(data: bytes) -> bytes:
    return zstandard.compress(data, 1)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending hashes as differences, bytes of equal weight together."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _squeeze(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _pack_counts(counts: np.ndarray) -> bytes:
    return _squeeze(counts.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _unpack_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents in blocks, training and held-out ones apart."""
    task, made = TaskContext.get().partitionId(), 0
    open_blocks: dict[bool, tuple[list, list]] = {True: ([], []), False: ([], [])}
    chars = {True: 0, False: 0}

    def close(held: bool) -> pa.RecordBatch:
        nonlocal made
        ids, texts = open_blocks[held]
        batch = pa.record_batch([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], schema=DOCS)
        row = [[task << 24 | made], [held], [len(ids)], [sum(map(len, texts)) // 4], [_squeeze(batch.serialize().to_pybytes())]]
        made += 1
        open_blocks[held], chars[held] = ([], []), 0
        return pa.RecordBatch.from_arrays([pa.array(row[0], pa.int64()), pa.array(row[1]), pa.array(row[2], pa.int64()), pa.array(row[3], pa.int64()), pa.array(row[4], pa.binary())], names=["block", "held", "rows", "grams", "docs"])
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_A_TIME):
            part = batch.slice(start, ROWS_AT_A_TIME)
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                held = held_out(doc_id)
                if open_blocks[held][0] and chars[held] + len(text) > BLOCK_CHARS:
                    yield close(held)
                open_blocks[held][0].append(doc_id)
                open_blocks[held][1].append(text)
                chars[held] += len(text)
    for held in (True, False):
        if open_blocks[held][0]:
            yield close(held)


class Grams:
    """A block's tokens, and its distinct words and bigrams as ascending hashes."""

    def __init__(self, packed: bytes) -> None:
        batch = pa.ipc.read_record_batch(pa.py_buffer(zstandard.decompress(packed)), DOCS)
        self.ids = batch.column(0)
        codes: dict[bytes, int] = {}
        rows, ends = [], []
        for text in batch.column(1).to_pylist():
            words = text.encode("utf-8").lower().split()
            for word in set(words).difference(codes):
                codes[word] = xxhash.xxh3_64_intdigest(word) | 4  # differs from BEGIN and END
            rows.append(np.fromiter(map(codes.__getitem__, words), np.uint64, len(words)))
            rows.append(np.array([END]))
            ends.append(len(words) + 1)
        self.sizes = np.array(ends, np.int64)
        words = np.concatenate(rows)
        starts = np.cumsum(self.sizes) - self.sizes
        context = np.roll(words, 1)
        context[starts] = BEGIN
        self.starts = starts
        self.words, self.word_at = np.unique(mixed(words), return_inverse=True)
        pair = mixed(mixed(context + np.uint64(11)) * np.uint64(0x9E3779B97F4A7C15) + words)
        self.pairs, first, self.pair_at = np.unique(pair, return_index=True, return_inverse=True)
        self.pair_first = first

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        return np.bincount(self.word_at, minlength=len(self.words)), np.bincount(self.pair_at, minlength=len(self.pairs))

    def totals(self, words: np.ndarray, pairs: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token the training counts of its word, its context and its bigram."""
        of_word = words[self.word_at]
        of_context = np.roll(of_word, 1)
        of_context[self.starts] = documents
        return of_word, of_context, pairs[self.pair_at]


def _bounds(low: int, high: int, n: int) -> list[tuple[int, int]]:
    """Equal ranges of hashes from ``low`` to below ``high``."""
    cuts = [low + (k * (high - low)) // n for k in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


def _cut(keys: np.ndarray, counts: np.ndarray, low: int, high: int, n: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Low, high, keys and counts of the ascending keys in each of ``n`` equal ranges that has any."""
    ranges = _bounds(low, high, n)
    at = [0, *np.searchsorted(keys, np.array([a for a, _ in ranges[1:]], np.uint64)).tolist(), len(keys)]
    for (bottom, top), a, b in zip(ranges, at, at[1:]):
        if a < b:
            yield bottom, top, _pack_keys(keys[a:b]), _pack_counts(counts[a:b])


# A range is named by its bounds, as texts: they are numbers of 64 bits without a sign.  ``parent`` is the range that it was cut from.
PIECE = "kind int, parent string, low string, high string, owner long, keys binary, counts binary"
TOTALS = "kind int, parent string, low string, owner long, totals binary, n long, different long"
_KINDS = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _rows(rows: list[tuple], schema: str) -> pa.Table:
    fields = [c.split() for c in schema.split(", ")]
    return pa.table([pa.array([r[i] for r in rows], _KINDS[kind]) for i, (_, kind) in enumerate(fields)], names=[name for name, _ in fields])


def _wanted(n_ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, held, packed in zip(*(c.to_pylist() for c in batch.columns)):
                grams = Grams(packed)
                for kind, keys, counts in zip((1, 2), (grams.words, grams.pairs), grams.counts()):
                    counts = np.zeros_like(counts) if held else counts
                    rows = [(kind, "0", str(low), str(high), block, *part) for low, high, *part in _cut(keys, counts, 0, 1 << 64, n_ranges)]
                    yield from _rows(rows, PIECE).to_batches()
    return run


def _merged(pieces: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Ascending keys of several pieces, their counts added up, and where each piece's keys are among them."""
    own = [_unpack_keys(x) for x in pieces.column("keys").to_pylist()]
    keys, at = np.unique(np.concatenate(own), return_inverse=True)
    counts = np.concatenate([_unpack_counts(x) for x in pieces.column("counts").to_pylist()])
    return keys, np.bincount(at, counts, len(keys)).astype(np.int64), np.split(at, np.cumsum([len(k) for k in own])[:-1])


def _given(pieces: pa.Table, totals: np.ndarray, places: list[np.ndarray]) -> list[tuple]:
    """Rows of TOTALS: each piece's totals in its own order."""
    names = zip(*(pieces.column(c).to_pylist() for c in ("kind", "parent", "low", "owner")))
    return [(*name, _pack_counts(totals[at]), None, None) for name, at in zip(names, places)]


def _added(pieces: pa.Table) -> pa.Table:
    """One range over all owners: the totals for each piece, and in a row without owner what is there in all."""
    _, totals, places = _merged(pieces)
    kind, low = pieces.column("kind")[0].as_py(), pieces.column("low")[0].as_py()
    return _rows([*_given(pieces, totals, places), (kind, None, low, None, None, int(totals.sum()), int((totals > 0).sum()))], TOTALS)


def _handed_down(pieces: pa.Table, sums: pa.Table) -> pa.Table:
    """The totals of a merged piece, given to the pieces that it was merged of."""
    _, _, places = _merged(pieces)
    parts = sorted(sums.column("parts")[0].as_py(), key=lambda x: int(x["low"]))
    return _rows(_given(pieces, np.concatenate([_unpack_counts(x["totals"]) for x in parts]), places), TOTALS)


def add_up(pieces: DataFrame, n_ranges: int, owners: int) -> DataFrame:
    """The totals of each piece, in its own order, and rows without owner with what is there in all.

    Each range of the pieces is to be cut into ``n_ranges`` more; at most ``owners`` have pieces in one.
    """
    if n_ranges <= 1:
        return pieces.groupBy("kind", "low").applyInArrow(_added, TOTALS)
    groups, now = max(1, -(-owners // MOST_RANGES)), min(n_ranges, MOST_RANGES)

    def merge(table: pa.Table) -> pa.Table:
        """A group of owners' pieces as one, cut into finer ranges."""
        keys, counts, _ = _merged(table)
        kind, low, high, group = (table.column(c)[0].as_py() for c in ("kind", "low", "high", "grp"))
        return _rows([(kind, low, str(a), str(b), group, *part) for a, b, *part in _cut(keys, counts, int(low), int(high), now)], PIECE)

    pieces = stored(pieces.withColumn("grp", F.pmod(F.xxhash64("owner"), F.lit(groups))), "pieces")
    finer = stored(pieces.groupBy("kind", "low", "grp").applyInArrow(merge, PIECE), "finer")
    found = stored(add_up(finer, -(-n_ranges // now), groups), "found")
    # A merged piece was cut into MOST_RANGES at most.
    sums = found.where("owner is not null").groupBy("kind", "parent", "owner").agg(F.collect_list(F.struct("low", "totals")).alias("parts"))
    down = pieces.groupBy("kind", "low", "grp").cogroup(sums.groupBy("kind", "parent", "owner")).applyInArrow(_handed_down, TOTALS)
    return down.unionByName(found.where("owner is null"))


def _looked_up(row_docs: bytes, found: list, documents: int):
    grams = Grams(row_docs)
    parts = {1: [], 2: []}
    for item in sorted(found, key=lambda x: int(x["low"])):
        parts[item["kind"]].append(_unpack_counts(item["totals"]))
    return grams, grams.totals(*(np.concatenate(parts[k]) for k in (1, 2)), documents)


def _level(of_context: np.ndarray) -> np.ndarray:
    """Bucket of a context's frequency: 0, then by powers of two."""
    return np.ceil(np.log2(of_context + 1.0)).astype(np.int64).clip(0, LEVELS - 1)


def _shares(of_word, of_context, of_pair, n: int, different: int) -> np.ndarray:
    """The three estimates: bigram, word, even."""
    bigram = of_pair / np.maximum(of_context, 1)
    return np.stack([bigram, of_word / max(n, 1), np.full(len(bigram), 1.0 / (different + 1))])


def learn_weights(evidence: DataFrame, n: int, different: int) -> np.ndarray:
    """Mixture weights by level (level, 3) from a table of packed held-out counts.

    Levels that the held-out documents lack take the weights of all levels together.
    """
    weights = np.tile([0.4, 0.4, 0.2], (LEVELS + 1, 1))
    for _ in range(STEPS):
        def expected(batches: Iterator[pa.RecordBatch], now=weights) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((LEVELS, 3))
            for batch in batches:
                for packed in batch.column(0).to_pylist():
                    of_word, of_context, of_pair, times = _unpack_counts(packed).reshape(4, -1)
                    level = _level(of_context)
                    each = now[level].T * _shares(of_word, of_context, of_pair, n, different)
                    each *= times / each.sum(axis=0)
                    for part in range(3):
                        sums[:, part] += np.bincount(level, each[part], LEVELS)
            levels = np.flatnonzero(sums.sum(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(levels, pa.int32()), *(pa.array(sums[levels, i]) for i in range(3))], names=["level", "x", "y", "z"])
        sums = np.zeros((LEVELS + 1, 3))
        rows = evidence.select("counts").mapInArrow(expected, "level int, x double, y double, z double").groupBy("level").agg(F.sum("x"), F.sum("y"), F.sum("z"))
        for level, *row in rows.collect():  # LEVELS rows at most
            sums[level] = row
        if not sums.any():
            break
        sums[LEVELS] = sums.sum(axis=0)
        seen = sums.sum(axis=1) > 0
        before = weights
        weights = np.where(seen[:, None], sums / np.maximum(sums.sum(axis=1), 1e-300)[:, None], sums[LEVELS] / sums[LEVELS].sum())
        weights[:, 2] = np.maximum(weights[:, 2], LEAST_EVEN)
        weights /= weights.sum(axis=1, keepdims=True)
        if np.abs(weights - before).max() < 1e-4:
            break
    return weights


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """One row for each document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the words, A-Z as a-z, and one end; the model learns from documents that are not held
    out.  ``base_score`` is the sum of log10((c + 0.1) / (N + 0.1 * (V + 1))), ``score`` the log10 probability under the
    mixture.  Null and empty texts are an end alone.  Repeated rows count as often as they are there.  A null id is
    held out.  Without training documents all counts are 0.
    """
    spark = docs.sparkSession
    blocks = stored(id_and_text(docs, id_col, text_col).mapInArrow(_blocks, "block long, held boolean, rows long, grams long, docs binary"), "blocks")
    grams, documents, n_blocks = blocks.agg(F.sum("grams"), F.sum(F.when(~F.col("held"), F.col("rows")).otherwise(0)), F.count(F.lit(1))).collect()[0]
    if grams is None:
        return spark.createDataFrame([], RESULT)
    n_ranges = max(1, -(-grams // RANGE_GRAMS))
    now = min(n_ranges, MOST_RANGES)
    wanted = blocks.select("block", "held", "docs").mapInArrow(_wanted(now), PIECE)
    totals = stored(add_up(wanted, -(-n_ranges // now), n_blocks), "totals")
    whole = totals.where("owner is null and kind = 1").agg(F.sum("n"), F.sum("different")).collect()[0]
    n, different = int(whole[0] or 0), int(whole[1] or 0)
    # A block was cut into MOST_RANGES at most, for each kind.
    found = totals.where("owner is not null").groupBy(F.col("owner").alias("block")).agg(F.collect_list(F.struct("low", "kind", "totals")).alias("found"))
    ready = blocks.join(found, "block")

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for docs, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                block, counts = _looked_up(docs, items, documents)
                times = np.bincount(block.pair_at)
                rows = np.concatenate([*(c[block.pair_first] for c in counts), times])
                yield pa.RecordBatch.from_arrays([pa.array([_pack_counts(rows)], pa.binary())], names=["counts"])

    held = stored(ready.where("held").select("docs", "found").mapInArrow(evidence, "counts binary"), "evidence")
    weights = learn_weights(held, n, different)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held, docs, items in zip(*(c.to_pylist() for c in batch.columns)):
                block, (of_word, of_context, of_pair) = _looked_up(docs, items, documents)
                mixture = (weights[_level(of_context)].T * _shares(of_word, of_context, of_pair, n, different)).sum(axis=0)
                base = np.log10((of_word + ADDED) / (n + ADDED * (different + 1)))
                per_doc = [np.add.reduceat(x, block.starts) for x in ((of_word > 0).astype(np.int64), base, np.log10(mixture))]
                rows = len(block.ids)
                yield pa.RecordBatch.from_arrays([
                    block.ids, pa.array([held] * rows), pa.array(block.sizes), pa.array(per_doc[0]), pa.array([n] * rows, pa.int64()), pa.array(per_doc[1]), pa.array(per_doc[2]),
                ], names=[c.split()[0] for c in RESULT.split(", ")])
    return ready.select("held", "docs", "found").mapInArrow(scored, RESULT)
