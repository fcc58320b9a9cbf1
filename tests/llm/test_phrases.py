"""Quotient filters, and collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import make_docs  # noqa: F401
from tallymill.llm import collocations
from tallymill.llm.quotient_filter import Filter, permuted, restored


@pytest.mark.parametrize("bits", [1, 2, 7, 31, 52, 63])
def test_permutation_is_one_to_one(bits):
    rand = np.random.default_rng(bits)
    keys = np.arange(2**bits) if bits < 8 else rand.integers(0, 2**bits - 1, 5000)
    mixed = permuted(keys, bits)
    assert (restored(mixed, bits) == keys).all() and int(mixed.max()) < 2**bits
    assert len(np.unique(mixed)) == len(np.unique(keys))


@pytest.mark.parametrize("bits", [1, 5, 20, 45, 63])
def test_filters_keep_all_counts_when_packed_cut_and_merged(bits):
    rand = np.random.default_rng(bits)
    keys = rand.integers(0, min(2**bits, 3000), 9000)
    keys[:700] = keys[0]  # a counter beyond a byte
    want = Counter(keys.tolist())
    parts = [Filter.of(keys[a:a + 2500], bits) for a in range(0, len(keys), 2500)]
    cut: dict[int, list[Filter]] = {}
    for part in parts:
        for number, piece in Filter.unpack(part.pack()).split(min(bits, 3)):
            for more, finer in Filter.unpack(piece.pack()).split(min(bits - piece.lead, 2)):
                cut.setdefault(number << min(bits - piece.lead, 2) | more, []).append(Filter.unpack(finer.pack()))
    got = Counter()
    for number, pieces in cut.items():
        whole = Filter.merged(pieces)
        assert (np.diff(whole.mixed.astype(object)) > 0).all()
        got.update(dict(zip(whole.keys(number).tolist(), whole.counts.tolist())))
    assert got == want


def test_an_empty_filter():
    none = Filter.unpack(Filter.of(np.zeros(0, np.int64), 20).pack())
    assert len(none.mixed) == 0 and none.split(4) == [] and len(Filter.merged([none, none]).mixed) == 0


def brute(rows, least, longest=5, top=2000):
    """The contract, word by word."""
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang or "und"] += len(words)
            own = counts.setdefault(lang or "und", Counter())
            for k in range(1, longest + 1):
                own.update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        often = {p: a for p, a in own.items() if a >= least}
        inside = {q[i:i + k] for q, a in often.items() for k in range(2, len(q)) for i in range(len(q) - k + 1) if a >= often[q[i:i + k]]}
        found = []
        for p, a in often.items():
            if len(p) > 1 and p not in inside:
                score, cut = min((1000 * a * sizes[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), own[p[:cut]], own[p[cut:]]))
        out += [(lang, k, p.decode(), -a, x, y, sizes[lang], -score) for k, (score, a, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def some_rows(n, seed):
    rand = random.Random(seed)
    words = ["New", "york", "NEW", "York", "city", "of", "the", "é", "É", "naïve", "a-b", "$5", "中文", "\U0001f642", "x\x85y", "\xa0", "K", "İ"]
    rows = []
    for _ in range(n):
        text = "".join(rand.choice(["new york city ", "of the ", "to be or not to be ", rand.choice(words) + rand.choice([" ", "\t", "  ", ". ", ",", "\n", "\x0b", "\r", ";", "!?"])]) for _ in range(rand.choice([0, 1, 3, 30])))
        rows.append((rand.choice(["en", "de", None, "und"]), text))
    return [*rows, ("en", None), (None, ""), ("fr", "the end"), ("en", "a b " * 40000), ("de", " \t \n.,;")]


@pytest.fixture(scope="module")
def rows():
    return some_rows(250, 8)


def as_docs(spark, rows):
    frame = spark.createDataFrame([(i, t, lang, "s", 0) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumn("word", F.lit("x")).withColumn("block", F.lit(1)).withColumn("n", F.lit(2)).repartition(5)


def test_collocations_equal_brute_force(spark, rows):
    got = collocations.collocations(as_docs(spark, rows), least=6)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 6)


def test_shuffled_numbers_small_blocks_and_many_cuts_give_the_same(spark, rows, monkeypatch):
    for name, value in (("BLOCK_NUMBERS", 500), ("KEYS_AT_ONCE", 300), ("SHARD_KEYS", 200), ("CUT_BITS", 2), ("WORDS_AT_ONCE", 20)):
        monkeypatch.setattr(collocations, name, value)
    got = collocations.collocations(as_docs(spark, rows), least=6, top=40, most_words=3, most_grams=2)
    assert sorted(map(tuple, got.collect())) == brute(rows, 6, top=40)


def test_nothing_frequent_and_an_empty_table(spark, make_docs):
    docs = make_docs([(1, "a b c"), (2, None)])
    assert collocations.collocations(docs).isEmpty()
    assert collocations.collocations(docs.limit(0)).isEmpty()


def test_products_beyond_64_bits(spark):
    docs = spark.createDataFrame([("x", "a b ")], "lang string, text string")
    phrases = spark.createDataFrame([("x", ["a"], 4 * 10**15), ("x", ["b"], 3 * 10**15), ("x", ["a", "b"], 10**15 + 7)], "lang string, words array<string>, f long")
    totals = spark.createDataFrame([("x", 9 * 10**15 + 1)], "lang string, n long")
    real = collocations.frequent_phrases
    try:
        collocations.frequent_phrases = lambda *a, **b: (phrases, totals)
        (row,) = collocations.collocations(docs).collect()
    finally:
        collocations.frequent_phrases = real
    assert row["score"] == 1000 * (10**15 + 7) * (9 * 10**15 + 1) // (4 * 10**15 * 3 * 10**15)
