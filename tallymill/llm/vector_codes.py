"""Compressed codes of vectors: a codebook for each part of the vector, searched by Orchard's method.

Components are integers, floor(256 * x), so that all distances and sums are exact.  Vectors are cut
into equal parts; a part is coded by the nearest entry of its position's codebook.  Codebooks start as the
parts of the first vectors and are moved to the means of their members in a few rounds; a round is one pass in
which every task adds up its own members, so only sums are shuffled.

The search holds for each entry a list of all entries by distance.  From a first entry on, the list of the best entry
so far is followed; a better entry's list takes over from its beginning; entries that were compared
are marked; and beyond twice the distance to the best entry the triangle inequality ends the search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import named, small_side, stored

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SCALE = 256
# Scaled components from here on are refused: squares and their sums are exact in 64 bits below it.
MOST_SCALED = 2**27
# Vectors that are searched for at once in a task.
ROWS = 4096


class Orchard:
    """Nearest entries of one codebook (entry, place), with the lists that the search follows."""

    def __init__(self, book: np.ndarray) -> None:
        self.book = book
        apart = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
        self.lists = np.argsort(apart, axis=1, kind="stable")
        self.apart = np.take_along_axis(apart, self.lists, axis=1)
        # The entry with the smallest sum of distances to the others.
        self.first = int(np.argmin(apart.sum(axis=1)))

    def nearest(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Index and squared distance of each row's nearest entry (ties: lower index), and how many were compared."""
        n, entries = len(wanted), len(self.book)
        best = np.full(n, self.first)
        gap = ((wanted - self.book[best]) ** 2).sum(axis=1)
        marked = np.zeros((n, entries), bool)
        marked[:, self.first] = True
        at, compared = np.zeros(n, np.int64), n
        open_rows = np.arange(n)
        while len(open_rows):
            own, place = best[open_rows], at[open_rows]
            # Distances are squared, so twice the distance is four times the square.
            within = self.apart[own, place] <= 4 * gap[open_rows]
            open_rows, entry = open_rows[within], self.lists[own, place][within]
            at[open_rows] += 1
            fresh = ~marked[open_rows, entry]
            row, entry = open_rows[fresh], entry[fresh]
            marked[row, entry] = True
            compared += len(row)
            away = ((wanted[row] - self.book[entry]) ** 2).sum(axis=1)
            better = (away < gap[row]) | ((away == gap[row]) & (entry < best[row]))
            row = row[better]
            best[row], gap[row], at[row] = entry[better], away[better], 0
            open_rows = open_rows[at[open_rows] < entries]
        return best, gap, compared


@dataclass(frozen=True)
class Codebooks:
    """Entries as integers: (part, entry, place within the part)."""

    entries: np.ndarray

    def digest(self) -> str:
        """SHA-256 of all components in order, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def search(self) -> list[Orchard]:
        return [Orchard(book) for book in self.entries]


def usable(rows: DataFrame, parts: int = PARTS, id_col="vec_id", vector_col="embedding", label_col="label") -> DataFrame:
    """``vec_id``, ``label``, ``vector`` (doubles) of the rows that take part.

    Left out are vectors that are null or empty, hold null or non-finite components, or have another
    dimension than most (of equally frequent ones the smallest).  It must be a multiple of ``parts``.  Null
    ids and labels take part.
    """
    vector = named(vector_col).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = named(label_col) if label_col else F.lit(None).cast("int")
    taken = rows.select(named(id_col).cast("long").alias("vec_id"), label.alias("label"), vector.alias("vector")).where(
        F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    sizes = taken.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), "dims").limit(1).collect()
    dims = sizes[0]["dims"] if sizes else 0
    if dims % parts:
        raise ValueError(f"vectors of {dims} components cannot be cut into {parts} equal parts")
    return taken.where(F.size("vector") == dims)


def scaled(vectors: pa.Array, parts: int) -> np.ndarray:
    """Components as integers: (row, part, place)."""
    flat = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False))
    if np.abs(flat).max(initial=0) >= MOST_SCALED:
        raise ValueError(f"a component is {MOST_SCALED // SCALE} or more")
    return flat.astype(np.int64).reshape(len(vectors), parts, -1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def first_codebooks(taken: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The vectors of the smallest ids (null last; of an id with several vectors the smallest)."""
    # At most ``entries`` ids, so the hint is for a side of known size.
    ids = F.broadcast(taken.select(F.col("vec_id").alias("first")).distinct().orderBy(F.col("first").asc_nulls_last()).limit(entries))
    chosen = taken.join(ids, F.col("vec_id").eqNullSafe(F.col("first"))).groupBy("first").agg(F.min("vector").alias("vector"))
    found = chosen.orderBy(F.col("first").asc_nulls_last()).collect()
    if not found:
        return None
    return Codebooks(scaled(pa.array([r["vector"] for r in found], pa.list_(pa.float64())), parts).transpose(1, 0, 2))


def moved(taken: DataFrame, books: Codebooks) -> Codebooks:
    """Entries at the means of the parts that they are nearest to, rounded down; unused ones stay."""
    parts, entries, width = books.entries.shape

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, counts = books.search(), np.zeros((parts, entries), np.int64)
        sums = np.zeros(books.entries.shape, np.int64)
        for batch in _slices(batches):
            vectors = scaled(batch.column(0), parts)
            for part in range(parts):
                best, _, _ = search[part].nearest(vectors[:, part])
                counts[part] += np.bincount(best, minlength=entries)
                np.add.at(sums[part], best, vectors[:, part])
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(part * entries + entry, width)), pa.array(np.tile(np.arange(width), len(part))),
            pa.array(np.repeat(counts[part, entry], width)), pa.array(sums[part, entry].ravel()),
        ], names=["entry", "place", "n", "total"])

    rows = taken.select("vector").mapInArrow(added, "entry long, place long, n long, total long")
    after = books.entries.copy()
    # One row for each component of the codebooks.
    for entry, place, n, total in rows.groupBy("entry", "place").agg(F.sum("n"), F.sum("total")).collect():
        after[entry // entries, entry % entries, place] = total // n
    return Codebooks(after)


def fit(taken: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks from the rows of :func:`usable`; None without rows.  An entry's number must fit a byte."""
    if entries > 256:
        raise ValueError("an entry's number must fit a byte")
    books = first_codebooks(taken, parts, entries)
    for _ in range(rounds if books else 0):
        books = moved(taken, books)
    return books


def encode(taken: DataFrame, books: Codebooks) -> DataFrame:
    """``vec_id``, ``label``, ``code`` (binary, a byte for each part), ``error`` (sum of squared distances)."""
    parts = len(books.entries)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = books.search()
        for batch in _slices(batches):
            vectors = scaled(batch.column(2), parts)
            codes, errors = np.zeros((len(vectors), parts), np.uint8), np.zeros(len(vectors), np.int64)
            for part in range(parts):
                codes[:, part], gap, _ = search[part].nearest(vectors[:, part])
                errors += gap
            packed = [row.tobytes() for row in codes]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary()), pa.array(errors)], names=["vec_id", "label", "code", "error"])

    label = taken.schema["label"].dataType.simpleString()
    return taken.select("vec_id", "label", "vector").mapInArrow(coded, f"vec_id long, label {label}, code binary, error long")


def compress(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             id_col="vec_id", vector_col="embedding", label_col="label") -> DataFrame:
    """``vec_id``, ``label``, ``code`` (binary), ``error``, ``label_error``, ``codebooks_sha256`` of each row that takes part.

    Which rows do says :func:`usable`.  ``label_error`` adds up the errors of all rows of the label, null being one.
    Repeated rows and ids are rows of their own, but an id gives one first entry.  With fewer different ids than
    ``entries`` codebooks are that much smaller.  An empty table gives no rows.
    """
    taken = usable(rows, parts, id_col, vector_col, label_col)
    books = fit(taken, parts, entries, rounds)
    if books is None:
        return taken.select("vec_id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"),
                            F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = stored(encode(taken, books), "codes")
    sums = small_side(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
