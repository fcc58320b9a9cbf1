"""From raw documents to token ids: five operators, each on all that the one before kept.

A stage gets the rows that the stage before wrote, and returns a table: all but the last return the
columns of ``documents``.  Nulls, empty tables, repeated rows and further columns are treated as the
operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm import byte_bpe, exact_dedup, jaccard, mixing, toxicity
from tallymill.llm.common import named, stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model, fitted on the labelled ones, does not reject."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rated = toxicity.severity(docs, model)
    return rated.where(~F.col("is_toxic")).select(*map(named, docs.columns))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies by source, shuffled; sources get shares after the square root of their sizes."""
    return mixing.mix(docs, mixing.target_rates(docs)).select(*map(named, docs.columns))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``decoded_sha256`` (of the text that the ids decode to) of each copy."""
    coded = byte_bpe.encode_and_decode(docs)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", to_tokens),
]

# A fitted classifier and a tokenizer have no SQL form: tests compare the pipeline with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
