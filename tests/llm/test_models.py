"""Searches, mixing and models, against brute force or held-out rows."""

import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import make_docs  # noqa: F401
from tallymill.llm import interpolation, mixing, rp_forest, toxicity

# Vectors -------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_nearest(rows, k):
    """Rows of finite, non-zero vectors of the usual dimension."""
    taken = {(i, tuple(np.float32(v).tolist())) for i, v in rows}
    out = []
    for q, qv in taken:
        if q % 100 == 0:
            away = {}
            for i, v in taken:
                if i != q:
                    d = math.sqrt(sum((a - b) ** 2 for a, b in zip(v, qv)))
                    away[i] = min(d, away.get(i, d))
            best = sorted(away.items(), key=lambda x: (x[1], x[0]))[:k]
            out += [(q, r + 1, i) for r, (i, _) in enumerate(best)]
    return sorted(out)


def test_nearest_is_exact_when_all_leaves_are_visited(spark):
    rand = random.Random(3)
    rows = [(i, [rand.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, rows[100][1]) for i in range(30)] + [(i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(2000, 2500, 25)]
    bad = [(5000, None), (5100, []), (5200, [0.0] * 6), (5300, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (5400, [float("nan")] * 6), (5500, [1.0] * 5), (None, [1.0] * 6), (5600, [float("inf")] * 6)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows + rows[:9] + bad], VECTORS).withColumn("p", F.lit(1)).withColumn("rank", F.lit(1))
    got = rp_forest.nearest(frame, frame.where("vec_id % 100 = 0"), visits=10**6)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()) == brute_nearest(rows, 10)


def test_recall_of_the_test_table(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    got = {(r["query_id"], r["vec_id"]) for r in rp_forest.nearest(frame, frame.where("vec_id % 100 = 0")).collect()}
    want = {(q, i) for q, _, i in brute_nearest([(r["vec_id"], r["embedding"]) for r in frame.collect()], 10)}
    assert len(got & want) >= 0.9 * len(want)


def clustered(n, seed=0, centres=500, spread=0.35):
    rand = np.random.default_rng(seed)
    middle = rand.standard_normal((centres, 32))
    return middle[rand.integers(0, centres, n)] + spread * rand.standard_normal((n, 32))


def searched(points, queries=60, k=10):
    """Recall, and the share of different points compared, of a planned search."""
    rand = np.random.default_rng(5)
    search = rp_forest.Search.plan(points[rand.permutation(len(points))[:rp_forest.SAMPLE]], len(points), k)
    members = rp_forest._members(search.forest.leaves(points), search.forest.depth)
    hits = compared = 0
    for q in rand.choice(len(points), queries, replace=False):
        away = ((points - points[q]) ** 2).sum(axis=1)
        away[q] = np.inf
        seen = set()
        for tree, leaf in search.visited(points[q]):
            own = members[tree][leaf]
            seen.update(own[search.rows(points[own]).near(points[q])].tolist() if len(own) else ())
        hits += len(seen.intersection(np.argpartition(away, k - 1)[:k].tolist()))
        compared += len(seen)
    return hits / queries / k, compared / queries / len(points)


def test_search_of_clustered_vectors_compares_few():
    points = clustered(50_000)
    recall, share = searched(points)
    assert recall >= 0.9 and share <= 0.1
    # Comparisons grow slower than the table.
    _, share_of_fewer = searched(points[:12_500])
    assert share <= 0.7 * share_of_fewer


def test_leaves_beyond_the_sample_are_split_on(monkeypatch):
    monkeypatch.setattr(rp_forest, "SAMPLE", 2000)
    recall, share = searched(clustered(40_000, centres=40))
    assert recall >= 0.9 and share <= 0.1


def test_a_test_table_is_not_wholly_visited(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("embedding").collect()
    recall, share = searched(np.array([r["embedding"] for r in rows]), 40)
    assert recall >= 0.9 and share < 0.9


def test_few_vectors_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], 0), (100, [1.0, 0.0], 0), (3, [2.0, 0.0], 0)], VECTORS)
    got = rp_forest.nearest(frame, frame.where("vec_id % 100 = 0"))
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 100, 0.0), (0, 2, 3, 1.0), (100, 1, 0, 0.0), (100, 2, 3, 1.0)]
    assert rp_forest.nearest(frame.limit(0), frame.limit(0)).isEmpty()
    alone = frame.where("vec_id = 0")
    assert rp_forest.nearest(alone, alone).isEmpty()


def test_blocks_give_the_same(spark, monkeypatch):
    rand = random.Random(4)
    rows = [(i, [rand.gauss(0, 1) for _ in range(4)]) for i in range(300)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    monkeypatch.setattr(rp_forest, "BLOCK", 30)
    monkeypatch.setattr(rp_forest, "QUERY_BLOCK", 1)
    got = rp_forest.nearest(frame, frame.where("vec_id % 100 = 0"), visits=10**6)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got.collect()) == brute_nearest(rows, 10)


# Mixing --------------------------------------------------------------------------------

def test_copies_follow_the_weights(spark, make_docs):
    docs = make_docs([(i, "x" * 100, "big" if i % 3 else "small") for i in range(6000)])
    weights = spark.createDataFrame([("big", 1.0), ("small", 1.0), ("absent", 5.0)], "source string, weight double")
    rates = {r["source"]: r["rate"] for r in mixing.target_rates(docs, weights=weights).collect()}
    assert rates == pytest.approx({"big": 0.5 * 1.5, "small": 0.5 * 3.0})
    mixed = mixing.mix(docs, mixing.target_rates(docs, weights=weights))
    counts = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    for source, n in (("big", 4000), ("small", 2000)):
        mean = rates[source] * n
        assert abs(counts[source] - mean) < 5 * math.sqrt(mean)
    assert mixed.columns == [*docs.columns, "copy", "shuffle_key"]
    again = mixing.mix(docs, mixing.target_rates(docs, weights=weights))
    assert mixed.exceptAll(again).isEmpty()


def test_counts_are_poisson(spark, make_docs):
    docs = make_docs([(i, "x") for i in range(20000)])
    for rate in (0.3, 2.5, 700.0):
        rows = docs if rate < 100 else docs.limit(300)
        rates = spark.createDataFrame([("s", rate)], "source string, rate double")
        counts = [r["count"] for r in mixing.mix(rows.select("doc_id", "source"), rates).groupBy("doc_id").count().collect()]
        n = rows.count()
        counts += [0] * (n - len(counts))
        assert abs(np.mean(counts) - rate) < 5 * math.sqrt(rate / n)
        assert abs(np.var(counts) - rate) < 6 * rate * math.sqrt(2 / n) + 5 * math.sqrt(rate / n)


def test_mixing_edge_cases(spark, make_docs):
    docs = make_docs([(1, None, None), (1, None, None), (None, "abc", None), (2, "", "t"), (3, "y" * 50, "t")]).withColumns({"copy": F.lit("clash"), "at": F.lit(1), "table": F.lit(2)})
    rates = mixing.target_rates(docs)
    assert {r["source"] for r in rates.collect()} == {None, "t"}
    many = spark.createDataFrame([(None, 40.0), ("t", 0.0)], "source string, rate double")
    got = mixing.mix(docs, many)
    assert set(got.columns) == set(docs.columns) | {"shuffle_key"}
    counts = collections.Counter(r["doc_id"] for r in got.collect())
    assert 2 not in counts and 3 not in counts and counts[1] % 2 == 0 and counts[None] > 5
    assert mixing.mix(docs.limit(0), mixing.target_rates(docs.limit(0))).isEmpty()


# Language model ------------------------------------------------------------------------

def brute_scores(rows):
    """Base scores, and the mixture learned with plain dictionaries."""
    words, pairs, docs = collections.Counter(), collections.Counter(), 0
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in rows]
    for i, w in tokens:
        if not interpolation.held_out(i):
            words.update(w)
            pairs.update(zip([0, *w], w))
            docs += 1
    n, v = sum(words.values()), len(words)

    def parts(w):
        for before, word in zip([0, *w], w):
            context = docs if before == 0 else words[before]
            shares = (pairs[before, word] / context if context else 0.0, words[word] / n if n else 0.0, 1 / (v + 1))
            yield math.ceil(math.log2(context + 1)), shares
    weights = collections.defaultdict(lambda: [0.4, 0.4, 0.2])
    for _ in range(interpolation.STEPS):
        sums = collections.defaultdict(lambda: [0.0] * 3)
        for i, w in tokens:
            if interpolation.held_out(i):
                for level, shares in parts(w):
                    each = [a * b for a, b in zip(weights[level], shares)]
                    for key in (level, "all"):
                        sums[key] = [s + e / sum(each) for s, e in zip(sums[key], each)]
        if not sums:
            break
        new = {}
        for level in [*range(interpolation.LEVELS), "all"]:
            row = sums[level] if level in sums else sums["all"]
            row = [x / sum(row) for x in row]
            row[2] = max(row[2], interpolation.LEAST_EVEN)
            new[level] = [x / sum(row) for x in row]
        moved = max(abs(a - b) for k in new for a, b in zip(new[k], weights[k]))
        weights = collections.defaultdict(lambda: [0.4, 0.4, 0.2], new)
        if moved < 1e-4:
            break
    for i, w in tokens:
        base = sum(math.log10((words[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        score = sum(math.log10(sum(a * b for a, b in zip(weights[level], shares))) for level, shares in parts(w))
        yield i, zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0, len(w), sum(words[x] > 0 for x in w), n, base, score


@pytest.mark.parametrize("block, ranges", [(200, 1024), (10**6, 1024), (200, 4)])
def test_scores_equal_brute_force(spark, make_docs, monkeypatch, block, ranges):
    monkeypatch.setattr(interpolation, "BLOCK_CHARS", block)
    monkeypatch.setattr(interpolation, "MOST_RANGES", ranges)
    monkeypatch.setattr(interpolation, "RANGE_GRAMS", 150)
    rand = random.Random(6)
    vocabulary = [f"w{int(rand.expovariate(0.05))}" for _ in range(500)]
    rows = [(i, " ".join(rand.choice(vocabulary) for _ in range(rand.randint(0, 40)))) for i in range(150)]
    rows += [(200, None), (201, ""), (None, "W1 w2\tW3"), (202, "w1 " * 3000), (7, rows[7][1]), (203, "É é")]
    docs = make_docs(rows).withColumns({"block": F.lit(1), "held": F.lit(True)})
    got = sorted([tuple(r) for r in interpolation.score(docs).collect()], key=str)
    want = sorted(brute_scores(rows), key=str)
    assert len(got) == len(want)
    for mine, theirs in zip(sorted(got, key=lambda r: (str(r[:5]), r[5])), sorted(want, key=lambda r: (str(r[:5]), r[5]))):
        assert mine[:5] == theirs[:5]
        assert mine[5:] == pytest.approx(theirs[5:], rel=1e-9, abs=1e-9)


def test_pieces_of_a_block_do_not_grow_with_the_input(spark, make_docs, monkeypatch):
    monkeypatch.setattr(interpolation, "BLOCK_CHARS", 2000)
    monkeypatch.setattr(interpolation, "RANGE_GRAMS", 100)
    monkeypatch.setattr(interpolation, "MOST_RANGES", 8)
    rand, counts = random.Random(7), {}
    real = interpolation.stored
    monkeypatch.setattr(interpolation, "stored", lambda df, label: counts.setdefault(label, []).append(out := real(df, label)) or out)
    moved = []
    for n in (40, 400):
        counts.clear()
        rows = [(i, " ".join(f"w{rand.randint(0, 3000)}" for _ in range(60))) for i in range(n)]
        assert interpolation.score(make_docs(rows)).count() == n
        # Each round of cutting keeps a block's number of pieces: at most two kinds of eight ranges.
        blocks = counts["blocks"][0].count()
        sizes = [df.count() / blocks for label in ("pieces", "finer") for df in counts.get(label, [])]
        moved.append(max(sizes))
        assert max(sizes) <= 2 * 8 * 8
    assert moved[1] <= 1.5 * moved[0]


def test_scores_without_training_or_held_out_documents(spark, make_docs):
    held = next(i for i in range(100) if interpolation.held_out(i))
    trained = next(i for i in range(100) if not interpolation.held_out(i))
    for i in (held, trained):
        (row,) = interpolation.score(make_docs([(i, "a b a")])).collect()
        assert row["held_out"] == (i == held) and math.isfinite(row["score"]) and math.isfinite(row["base_score"])
    assert interpolation.score(make_docs([])).isEmpty()


def test_model_beats_the_base_on_held_out_documents(spark, sf_dir):
    got = interpolation.score(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out")
    base, score = got.agg(F.sum("base_score"), F.sum("score")).collect()[0]
    assert score > base


# Toxicity ------------------------------------------------------------------------------

def toxic_docs(n, seed):
    rand = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = rand.random() < 0.3
        words = [f"word{rand.randint(0, 200)}" for _ in range(rand.randint(5, 60))]
        if toxic:
            words += rand.sample(["vileone", "foultwo", "nasty", "rotten"], rand.randint(1, 4))
        rand.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_ordinal_model_on_held_out_rows(spark, make_docs):
    rows, labels = toxic_docs(900, 8)
    docs = make_docs(rows)
    frame = spark.createDataFrame(labels + [(1, None), (99999, 1), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, frame.where("doc_id < 600"))
    assert list(model.thresholds) == sorted(model.thresholds) and len(model.thresholds) == toxicity.MOST_SEVERE
    rated = toxicity.severity(docs.withColumn("severity", F.lit("clash")), model)
    got = {r["doc_id"]: r for r in rated.where("doc_id >= 600").collect()}
    wrong = [i for i, t in labels[600:] if got[i]["is_toxic"] != bool(t)]
    assert len(wrong) <= 6
    grade = [len({"vileone", "foultwo", "nasty", "rotten"} & set(rows[i][1].split())) for i in got]
    assert np.corrcoef(grade, [r["severity"] for r in got.values()])[0, 1] > 0.9


def test_ordinal_gradient_reaches_the_best(spark):
    """The fitted likelihood is not improved by small changes."""
    rand = np.random.default_rng(2)
    present = [np.flatnonzero(rand.random(3) < 0.5) for _ in range(200)]
    grades = np.array([min(2, len(p)) if rand.random() < 0.8 else int(rand.integers(0, 3)) for p in present])
    share = np.where(grades == 0, 0.5 / (grades == 0).sum(), 0.5 / (grades > 0).sum())

    def loss(w, cuts):
        s = np.array([w[p].sum() for p in present])
        above = np.hstack([np.ones((200, 1)), 1 / (1 + np.exp(cuts - s[:, None])), np.zeros((200, 1))])
        k = np.arange(200)
        return -(share * np.log(above[k, grades] - above[k, grades + 1])).sum() + 0.5 * 0.5 / 200 * (w**2).sum()
    w, cuts = toxicity.fit_ordinal(present, grades, 3, steps=4000, rate=0.02)
    best = loss(w, cuts)
    for k in range(3):
        for step in (-0.05, 0.05):
            assert loss(w + step * np.eye(3)[k], cuts) >= best - 1e-5
    for k in range(2):
        for step in (-0.05, 0.05):
            assert loss(w, cuts + step * np.eye(2)[k]) >= best - 1e-5


def test_toxicity_edge_cases(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (None, "x"), (3, "word " * 30000), (3, "y"), (3, "y")])
    one_sided = spark.createDataFrame([(1, 0), (3, 0)], "doc_id long, toxic int")
    for labels in (one_sided, one_sided.limit(0)):
        model = toxicity.fit(docs, labels)
        rated = toxicity.severity(docs, model)
        assert rated.count() == 6 and rated.where("is_toxic or severity != 0").isEmpty()
    assert toxicity.severity(docs.limit(0), toxicity.fit(docs.limit(0), one_sided)).isEmpty()


def test_few_labels_find_their_toxic_documents(spark, make_docs):
    rows, labels = toxic_docs(40, 8)
    docs = make_docs(rows)
    for n in (6, 12, 40):
        toxic = {i for i, t in labels[:n] if t}
        model = toxicity.fit(docs, spark.createDataFrame(labels[:n], "doc_id long, toxic int"))
        found = {r["doc_id"] for r in toxicity.severity(docs, model).where("is_toxic").collect()}
        assert toxic and found & set(range(n)) == toxic, n


def test_labelled_toxic_documents_of_the_smallest_table_are_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    rated = toxicity.severity(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    got = [tuple(r) for r in rated.join(labels, "doc_id").where("toxic is not null").select("toxic", "is_toxic").collect()]
    assert (1, True) in got and all(bool(toxic) == found for toxic, found in got)
