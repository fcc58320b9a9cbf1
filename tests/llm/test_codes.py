"""Vector codes against plain numpy."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill.llm import queries, vector_codes

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_codes(rows, parts, entries, rounds):
    """(vec_id, label, code, error, label_error, digest) of rows of whole vectors."""
    taken = np.array([np.floor(256 * np.float32(v).astype(float)) for _, v, _ in rows]).astype(np.int64).reshape(len(rows), parts, -1)
    firsts = {}
    for k, (i, v, _) in enumerate(rows):
        firsts[i] = min(firsts.get(i, (v, k)), (v, k))
    ids = sorted(firsts, key=lambda i: (i is None, i))[:entries]
    books = [[taken[firsts[i][1], p].tolist() for i in ids] for p in range(parts)]

    def nearest(p):
        away = [[sum((int(a) - b) ** 2 for a, b in zip(x, e)) for e in books[p]] for x in taken[:, p]]
        return [min((d, e) for e, d in enumerate(row)) for row in away]
    for _ in range(rounds):
        for p in range(parts):
            best = nearest(p)
            for e in range(len(ids)):
                own = [taken[k, p] for k, (_, at) in enumerate(best) if at == e]
                if own:
                    books[p][e] = [int(sum(map(int, column))) // len(own) for column in zip(*own)]
    found = [nearest(p) for p in range(parts)]
    errors = [sum(found[p][k][0] for p in range(parts)) for k in range(len(rows))]
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    sums = {}
    for (_, _, label), error in zip(rows, errors):
        sums[label] = sums.get(label, 0) + error
    return sorted(((i, label, "".join(f"{found[p][k][1]:02x}" for p in range(parts)), errors[k], sums[label], digest)
                   for k, (i, _, label) in enumerate(rows)), key=str)


def as_rows(df):
    return sorted(((r["vec_id"], r["label"], bytes(r["code"]).hex(), r["error"], r["label_error"], r["codebooks_sha256"]) for r in df.collect()), key=str)


def test_codes_equal_brute_force(spark):
    rand = random.Random(5)
    rows = [(i, [rand.choice([-2.0, -0.5, 0.0, 0.3, 1.0, rand.gauss(0, 3)]) for _ in range(8)], rand.choice([None, 1, 2])) for i in range(150)]
    rows += rows[:20] + [(7, [9.0] * 8, 1), (None, [0.1] * 8, None), (2**62, [0.25] * 8, 3)]
    bad = [(1000, None, 1), (1001, [], 1), (1002, [1.0] * 7 + [None], 1), (1003, [float("nan")] + [1.0] * 7, 1), (1004, [float("-inf")] * 8, 1), (1005, [1.0] * 4, 1)]
    frame = spark.createDataFrame(rows + bad, VECTORS)
    for name in ("of", "vector", "code", "error", "label_error", "first"):
        frame = frame.withColumn(name, F.lit("x"))
    got = vector_codes.compress(frame, parts=4, entries=16)
    assert as_rows(got) == brute_codes(rows, 4, 16, 2)
    assert got.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]


def test_labels_are_joined_by_shuffling_when_there_are_many(spark, monkeypatch):
    rows = [(i, [float(i % 5), i / 7, -float(i), 1.0], i % 40) for i in range(200)]
    monkeypatch.setattr("tallymill.llm.common.small_side.__defaults__", (3,))
    assert as_rows(vector_codes.compress(spark.createDataFrame(rows, VECTORS), parts=2, entries=8)) == brute_codes(rows, 2, 8, 2)


def test_search_finds_the_nearest_and_skips(monkeypatch):
    rand = np.random.default_rng(1)
    centres = rand.integers(-900, 900, (12, 4))
    book = centres[rand.integers(0, 12, 64)] + rand.integers(-20, 20, (64, 4))
    book[20] = book[9]  # equal entries: the lower index counts
    wanted = np.vstack([centres[rand.integers(0, 12, 3000)] + rand.integers(-30, 30, (3000, 4)), book])
    best, gap, compared = vector_codes.Orchard(book).nearest(wanted)
    away = ((wanted[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (best == away.argmin(axis=1)).all() and (gap == away.min(axis=1)).all()
    assert compared < 0.5 * away.size


def test_few_vectors_none_and_refused_ones(spark):
    rows = [(3, [1.0, 2.0], 1), (1, [1.0, 2.0], None)]
    assert as_rows(vector_codes.compress(spark.createDataFrame(rows, VECTORS), parts=2)) == brute_codes(rows, 2, 64, 2)
    empty = spark.createDataFrame([], VECTORS)
    out = vector_codes.compress(empty)
    assert out.isEmpty() and out.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    with pytest.raises(ValueError):
        vector_codes.compress(spark.createDataFrame(rows, VECTORS), parts=3)
    with pytest.raises(Exception, match="a component is"):
        vector_codes.compress(spark.createDataFrame([(1, [1e9, 0.0], 1)], VECTORS), parts=2).collect()


def test_query_has_the_agreed_columns(spark, sf_dir):
    out = queries.op11_vector_codes(spark, sf_dir)
    assert dict(out.dtypes) == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
    assert {len(r["code"]) for r in out.select("code").distinct().collect()} == {32}
