"""Operators that compare documents, against plain Python on small tables."""

import collections
import hashlib
import random

import numpy as np
import pytest
from llm_fixtures import make_docs  # noqa: F401
from pyspark.sql import functions as F

from tallymill.llm import components, exact_dedup, jaccard, line_runs

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def some_text(rand, n):
    return " ".join(rand.choice(WORDS) + str(rand.randint(0, 60)) for _ in range(n))


def clash(docs):
    """Further columns with names that the operators use themselves."""
    names = ("row_key", "k", "o", "i", "c", "a", "b", "n", "recipe", "norm", "label", "order", "token", "rep", "best", "kept", "d")
    return docs.withColumns({x: F.lit(7) for x in names})


# Exact ---------------------------------------------------------------------------------

def brute_exact(rows):
    found = collections.defaultdict(list)
    for i, text in rows:
        found["".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")].append((i, text or ""))
    out = []
    for norm, group in found.items():
        keep = min(group, key=lambda r: (-len(r[1]), r[0] is None, r[0] or 0))
        out += [(i, keep[0], len(group), hashlib.sha256(norm.encode()).hexdigest()) for i, _ in group]
    return sorted(out, key=str)


def exact_rows():
    rand = random.Random(5)
    rows = [(i, some_text(rand, rand.choice([1, 5, 900]))) for i in range(60)]
    rows += [(100 + i, rows[i % 7][1].replace(" ", rand.choice(["\n", "  ", ""]))) for i in range(40)]
    rows += [(200, None), (201, ""), (202, " \n"), (None, "x y"), (203, "xy"), (204, "x y"), (205, "é" * 9000), (206, "é" * 9000)]
    return rows


def test_exact_groups_equal_brute_force(spark, make_docs):
    rows = exact_rows()
    got = exact_dedup.groups(clash(make_docs(rows)))
    cells = [(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got.collect()]
    assert sorted(cells, key=str) == brute_exact(rows)
    assert got.where("kept").count() == got.select("text_sha256").distinct().count()


def test_exact_keeps_whole_rows_and_one_of_repeated_ones(spark, make_docs):
    docs = clash(make_docs([(1, "a b"), (1, "a b"), (2, "ab"), (3, "ab "), (None, None), (None, None)]))
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in kept.where("text is not null").collect()) == [(1, "a b")]
    assert kept.count() == 2
    assert exact_dedup.exact_dedup(docs.limit(0)).isEmpty()


def test_chunks_join_to_the_text(spark):
    texts = ["", "a", "x" * 5000, ("word. " * 999).strip(), "中。" * 3000, "\U0001f642" * 4100, "a b" * 900]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert frame.where(F.array_join(exact_dedup.chunks(F.col("t")), "") != F.col("t")).isEmpty()


def test_colliding_identifiers_are_found_and_replaced(spark, make_docs):
    def weak(chunk, seed):  # all chunks of one length are alike under the first seed
        good = exact_dedup.identifier(chunk, seed)
        return F.struct(F.length(chunk).cast("long").alias("a"), F.lit(0).cast("long").alias("b")) if seed == 0 else good

    rows = [(1, "aa"), (2, "bb"), (3, "aa")]
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup.groups(make_docs(rows), identify=weak).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    with pytest.raises(RuntimeError):
        exact_dedup.groups(make_docs(rows), identify=lambda c, seed: weak(c, 0))


# Near ----------------------------------------------------------------------------------

def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for x in range(len(rows)):
        for y in range(x):
            common = len(sets[x] & sets[y])
            if sets[x] and sets[y] and 100 * common >= 80 * len(sets[x] | sets[y]):
                parent[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return sorted([(i, len(sets[x]), least.get(find(x))) for x, (i, _) in enumerate(rows)], key=str)


def near_rows(seed, n_groups=6, copies=12):
    """Groups of copies with changes around the threshold, chains, a shared passage and short texts."""
    rand = random.Random(seed)
    shared, texts = some_text(rand, 55), []
    for _ in range(n_groups):
        words = some_text(rand, rand.choice([9, 14, 30, 120])).split()
        for _ in range(copies):
            new = list(words)
            for _ in range(rand.choice([0, 1, 1, 2, 3])):
                new[rand.randrange(len(new))] = rand.choice(WORDS)
            if rand.random() < 0.4:
                words = new  # the next is a copy of this copy
            texts.append(" ".join(new) + (" " + rand.choice(WORDS)) * rand.choice([0, 0, 1]))
    texts += [shared + " " + some_text(rand, rand.choice([3, 8, 12, 60])) for _ in range(25)]
    texts += ["", " \n", None, "one", "one", "ONE", "a b c", "A b\tc", "a b c d e", "a b c d e f", "É x", "é x", "x y z " * 3000, "x y z " * 3001]
    rand.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_equal_brute_force(spark, make_docs, seed):
    rows = near_rows(seed)
    got = jaccard.components(clash(make_docs(rows)))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_components(rows)


@pytest.mark.parametrize("seed", [2, 3])
def test_signatures_in_every_list_lose_no_link(spark, make_docs, monkeypatch, seed):
    monkeypatch.setattr(jaccard, "CROWDED", 0)
    rows = near_rows(seed)
    got = jaccard.components(clash(make_docs(rows)))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_components(rows)


def test_signatures_differ_in_no_more_bits_than_sets(spark):
    rand = np.random.default_rng(4)
    for size, changed in ((3, 1), (60, 7), (900, 100), (40_000, 3)):
        one = np.unique(rand.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2))
        two = np.unique(np.concatenate([one[changed:], rand.integers(0, 2**63, changed, dtype=np.uint64)]))
        bits = np.unpackbits((jaccard.signature(one) ^ jaccard.signature(two)).view(np.uint8)).sum()
        assert bits <= len(np.setxor1d(one, two))


def test_template_documents_give_few_pairs(spark, make_docs, monkeypatch):
    rand, counts = random.Random(1), {}
    sentences = [" ".join(f"w{rand.randint(0, 5000)}" for _ in range(15)) for _ in range(50)]
    real = jaccard.stored
    monkeypatch.setattr(jaccard, "stored", lambda df, label: counts.setdefault(label, []).append((out := real(df, label)).count()) or out)
    monkeypatch.setattr(jaccard, "CROWDED", 0)
    docs = make_docs([(i, " ".join(rand.choice(sentences) for _ in range(4))) for i in range(2500)])
    jaccard.components(docs).count()
    # The lists hold leaders that share a sentence or two and hardly more; members are compared with one leader of each list.
    assert counts["star-pairs"][0] < 250 and counts["pairs"][1] < 250 and sum(counts["pairs"]) < 12 * 2500


def test_small_lists_and_all_shuffle_joins(spark, make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "MOST_BROADCAST", 0)
    monkeypatch.setattr(jaccard, "MOST_KNOWN", 0)
    rows = near_rows(4)
    got = jaccard.components(make_docs(rows))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_components(rows)


def test_cut_lists_give_the_same(spark, make_docs):
    """Every list is cut into lists of its own: links are found across them."""
    rows = near_rows(5)
    docs = make_docs(rows)
    texts = jaccard.id_and_text(docs).select("text", "doc_id", F.xxhash64("doc_id", "text").alias("row"))
    sized = texts.mapInArrow(jaccard._profiles, jaccard.PROFILE).where("part is null").select("doc_id", "row", "n", "a", "b")
    sketch = spark.sparkContext.broadcast((np.zeros(jaccard.COUNTERS, np.uint8), dict.fromkeys(range(jaccard.COUNTERS), 5)))
    index = jaccard.stored(texts.mapInArrow(jaccard._index(sketch), "a long, b long, n int, tokens array<long>, salts array<short>").dropDuplicates(["a", "b"]).withColumn("c", F.monotonically_increasing_id()), "index")
    classes = jaccard.stored(index.select("c", "a", "b", "n").join(sized.groupBy("a", "b").agg(F.min("row").alias("rep"), F.min("doc_id").alias("first_id")), ["a", "b"]), "classes")
    entries = index.select("c", "n", F.posexplode(F.arrays_zip("tokens", "salts")).alias("at", "e")).select(F.col("e.tokens").alias("token"), F.col("e.salts").alias("salt"), "c", "n", (F.col("at") + 1).alias("at"))
    got = jaccard._labelled(sized, jaccard._join(entries, classes, texts))
    assert sorted([tuple(r) for r in got.collect()], key=str) == brute_components(rows)


def test_null_ids_repeated_rows_and_empty_tables(spark, make_docs):
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (None, text), (3, text + " eight"), (None, "other words")]
    got = sorted([tuple(r) for r in jaccard.components(make_docs(rows)).collect()], key=str)
    assert got == brute_components(rows)
    assert jaccard.components(make_docs([])).isEmpty()
    kept = jaccard.keep_one(clash(make_docs(rows)))
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == [("3", text + " eight"), ("5", text), ("None", "other words")]


def test_components_of_a_long_chain_and_a_hub(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(7, 200 + k) for k in range(300)] + [(900, 900)]
    frame = spark.createDataFrame(links, "x long, y long")
    got = {r["c"]: r["label"] for r in components.connected(frame).collect()}
    assert {got[k] for k in range(100, 161)} == {100} and {got[200 + k] for k in range(300)} == {7}


# Lines ---------------------------------------------------------------------------------

def brute_lines(rows, least):
    """By (id, null last): the texts left of distinct rows."""
    order = sorted({(i is None, i or 0, t or "") for i, t in rows})
    seen, gone = set(), collections.defaultdict(set)
    for doc in order:
        lines = doc[2].split("\n")
        for k in range(len(lines) - least + 1):
            window = tuple(lines[k:k + least])
            if window in seen:
                gone[doc] |= set(range(k, k + least))
            seen.add(window)
    return {doc: ("\n".join(x for k, x in enumerate(doc[2].split("\n")) if k not in gone[doc]), sorted(gone[doc])) for doc in order}


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_line_runs_equal_brute_force(spark, make_docs, least):
    rand = random.Random(least)
    rows = [(i, "\n".join(rand.choice("abcdefgh") * rand.choice([1, 1, 2]) for _ in range(rand.randint(1, 9)))) for i in range(80)]
    rows += [(500, None), (501, ""), (502, "\n\n\n"), (None, "a\na\na\na\na\na"), (503, "z\n" * 3000), (3, rows[3][1])]
    got = line_runs.delete_repeated_runs(clash(make_docs(rows)).withColumn("deleted", F.lit("clash")), least).collect()
    want = brute_lines(rows, least)
    assert len(got) == len(rows)
    for r in got:
        source = next(t for i, t in rows if i == r["doc_id"])
        text, deleted = want[(r["doc_id"] is None, r["doc_id"] or 0, source or "")]
        assert (r["text"] or "", r["deleted"], r["n_lines"]) == (text, deleted, len((source or "").split("\n")))


def test_long_single_lines_go_between_other_neighbours(spark, make_docs):
    long, short = " ".join(f"w{k}" for k in range(50)), " ".join(f"v{k}" for k in range(49))
    rows = [(1, f"a\n{long}\nb\n{short}"), (2, f"c\n{long}\nd"), (3, long), (4, f"{short}\nx\n{long}\n{long}"), (5, "b\nc"), (3, long)]
    got = line_runs.delete_repeated_runs(make_docs(rows), long_words=50)
    assert sorted((r["doc_id"], r["text"], r["deleted"]) for r in got.collect()) == [
        (1, rows[0][1], []), (2, "c\nd", [1]), (3, "", [0]), (3, "", [0]), (4, f"{short}\nx", [2, 3]), (5, "b\nc", [])]
    without = line_runs.delete_repeated_runs(make_docs(rows))
    assert without.where(F.size("deleted") > 0).isEmpty()


def test_line_runs_of_an_empty_table(spark, make_docs):
    assert line_runs.delete_repeated_runs(make_docs([])).isEmpty()
