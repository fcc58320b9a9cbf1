"""The pipeline and the queries against plain Python, and what the rest must not depend on."""

import hashlib
import math

import oracle
import pytest
import tokenizers
from pyspark.sql import functions as F
from test_groups import brute_components, brute_exact
from test_texts import brute_secrets

import corpus_pipeline
from tallymill.llm import byte_bpe, exact_dedup, mixing, queries, toxicity, unigram
from tallymill.llm.common import stored as queries_stored


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").collect()


def poisson(mean, u):
    p = c = math.exp(-mean)
    k = 0
    while c <= u:
        k += 1
        p *= mean / k
        c += p
    return k


def copies(rows):
    """(doc_id, text) of the copies that mixing makes."""
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + max(1, len(r["text"] or ""))
    weights = {s: math.sqrt(n) for s, n in sizes.items()}
    for r in rows:
        rate = weights[r["source"]] / sum(weights.values()) * sum(sizes.values()) / sizes[r["source"]]
        u = int(hashlib.md5(f"{mixing.SEED}:{r['doc_id']}:1".encode()).hexdigest()[:13], 16) / 2**52
        assert rate <= mixing.MOST_MEAN
        yield from [(r["doc_id"], r["text"])] * poisson(rate, u)


def test_pipeline_equals_plain_python(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    rows = [r for r in documents if not model.score(r["text"] or "")[1]]
    kept = {c[1] for c in brute_exact([(r["doc_id"], r["text"]) for r in rows])}
    rows = [r for r in rows if r["doc_id"] in kept]
    kept = {c[2] for c in brute_components([(r["doc_id"], r["text"]) for r in rows])}
    rows = [r for r in rows if r["doc_id"] in kept]
    library = tokenizers.Tokenizer.from_file(byte_bpe.default_tokenizer())
    want = sorted((i, library.encode(t, add_special_tokens=False).ids) for i, t in copies(rows))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in got) == want
    texts = {r["doc_id"]: r["text"] for r in documents}
    assert all(r["n_tokens"] == len(r["ids"]) and r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in got)


def test_stages_keep_the_columns_and_take_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "jaccard_join", "mixing", "bpe"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs.limit(0), sf_dir)
        assert out.isEmpty()
        if name != "bpe":
            assert out.columns == docs.columns


def test_stages_take_nulls_and_repeated_rows(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/documents.parquet").schema
    rows = [(None, None, None, None, None), (1, "a b", "en", "s", 3), (1, "a b", "en", "s", 3), (2, "", None, "s", 0), (3, "word " * 20000, "en", None, 100000)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = exact_dedup.stored(stage(spark, docs, sf_dir), "stage")
    assert {r["doc_id"] for r in docs.collect()} <= {None, 1, 2, 3}
    assert corpus_pipeline.to_tokens(spark, docs, sf_dir).count() == docs.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_equal_their_sql(name, spark, sf_dir):
    oracle.compare(queries.QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), queries.ORACLES[name])


def test_text_queries_equal_brute_force(spark, sf_dir, documents):
    library = tokenizers.Tokenizer.from_file(byte_bpe.default_tokenizer())
    coded = {r["doc_id"]: r for r in queries.op3_byte_bpe(spark, sf_dir).collect()}
    secret = {r["doc_id"]: r for r in queries.op2_secrets(spark, sf_dir).collect()}
    counted = {r["doc_id"]: r["n_tokens"] for r in queries.op7_token_counts(spark, sf_dir).collect()}
    counter = unigram.Counter(unigram.read_vocabulary())
    assert len(documents) == len(coded) == len(secret) == len(counted)
    for r in documents:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        row = coded[r["doc_id"]]
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest())
        base = ",".join(f"{k}:{a}:{b}" for a, b, k in brute_secrets(r["text"]))
        row = secret[r["doc_id"]]
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert sum(row[f"n_{k}"] for k in ("assign", "access", "hex")) == (base.count(",") + 1 if base else 0)
        assert counted[r["doc_id"]] == counter.count(r["text"])


def test_near_query_equals_brute_force(spark, sf_dir, documents):
    got = [tuple(r) for r in queries.op9_jaccard(spark, sf_dir).collect()]
    assert sorted(got, key=str) == brute_components([(r["doc_id"], r["text"]) for r in documents])


def test_native_operators_run_no_python(spark, sf_dir):
    for name in ("op4_mixing", "op5_line_runs", "op8_exact_dedup"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan, name


def test_toxicity_query_covers_every_document(spark, sf_dir, documents):
    got = queries.op10_toxicity(spark, sf_dir)
    assert got.count() == len(documents) and got.where(F.col("severity").isNull()).isEmpty()


def test_mixing_query_moves_whole_rows(spark, sf_dir, documents, monkeypatch):
    written = []
    monkeypatch.setattr(queries, "stored", lambda df, label: written.append(queries_stored(df, label)) or written[-1], raising=False)
    got = queries.op4_mixing(spark, sf_dir)
    (mixed,) = written
    assert set(mixed.columns) == {*spark.read.parquet(f"{sf_dir}/documents.parquet").columns, "copy", "shuffle_key"}
    texts = {r["doc_id"]: r["text"] for r in documents}
    rows = mixed.select("doc_id", "text").collect()
    assert len(rows) == got.count() and all(texts[r["doc_id"]] == r["text"] for r in rows)
