"""The named queries of these operators over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm import (
    byte_bpe, collocations, exact_dedup, interpolation, jaccard, line_runs, mixing, quality_rules, rp_forest, secrets, toxicity, unigram, vector_codes,
)
from tallymill.llm.common import stored

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole document encoded and decoded."""
    coded = byte_bpe.encode_and_decode(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _listed(spans, kinds=None):
    """Spans as ``kind:start:end`` joined by commas."""
    if kinds:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of all vectors for every hundredth."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return rp_forest.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole document."""
    base = [rule.kind for rule in secrets.BASE_RULES]
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *map(count, base),
        F.sha2(_listed(F.col("spans"), base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The copies of all documents when sources are to have shares after the square root of their sizes."""
    docs = table(spark, sf_dir, "documents")
    # Whole rows are shuffled and written; the result names the copies.
    mixed = stored(mixing.mix(docs, mixing.target_rates(docs)), "mixed")
    return mixed.select("doc_id", "source", "copy", "shuffle_key")


OP4_SQL = """
WITH RECURSIVE sizes AS (
  SELECT source, sum(greatest(length(coalesce(text, '')), 1))::BIGINT AS size FROM documents GROUP BY source),
whole AS (SELECT sum(size)::DOUBLE AS all_size, sum(pow(size, 0.5)) AS all_weight FROM sizes),
means AS (
  SELECT source, rate, greatest(ceil(rate / 300.0), 1)::INTEGER AS draws, rate / greatest(ceil(rate / 300.0), 1)::INTEGER AS mean
  FROM (SELECT source, pow(size, 0.5) / all_weight * all_size / size AS rate FROM sizes, whole)),
below AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM means
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM below WHERE k < ceil(mean + 12 * sqrt(mean) + 24)),
draws AS (
  SELECT doc_id, d.source, unnest(generate_series(1, draws)) AS draw
  FROM (SELECT DISTINCT doc_id, source FROM documents) d JOIN means m ON d.source IS NOT DISTINCT FROM m.source),
numbers AS (
  SELECT *, CAST('0x' || substr(md5('17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || draw), 1, 13) AS BIGINT)::DOUBLE / pow(2.0, 52) AS u
  FROM draws),
drawn AS (
  SELECT n.doc_id, n.source, n.draw, count(*) FILTER (WHERE c <= u) AS n
  FROM numbers n JOIN below b ON n.source IS NOT DISTINCT FROM b.source GROUP BY ALL),
totals AS (SELECT doc_id, source, sum(n)::BIGINT AS n FROM drawn GROUP BY ALL),
copies AS (
  SELECT d.doc_id, d.source, unnest(generate_series(1, n))::INTEGER AS copy
  FROM documents d JOIN totals t ON d.doc_id IS NOT DISTINCT FROM t.doc_id AND d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, copy, md5('order:17:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy) AS shuffle_key FROM copies
"""


def op5_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of runs of lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.delete_repeated_runs(docs).select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("deleted").cast("long").alias("n_deleted"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP5_SQL = """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
places AS (SELECT doc_id, lines, unnest(range(len(lines))) AS i FROM split),
windows AS (SELECT doc_id, i, lines[i + 1] AS line, lines[i + 2] AS next FROM places WHERE i + 1 < len(lines)),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, i) AS copy FROM windows)
  WHERE copy > 1),
gone AS (SELECT doc_id, i FROM later UNION SELECT doc_id, i + 1 FROM later),
marked AS (SELECT p.doc_id, p.i, p.lines[p.i + 1] AS line, g.i IS NOT NULL AS deleted
           FROM places p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE deleted) AS n_deleted,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT deleted), '')) AS text_sha256
FROM marked GROUP BY doc_id
"""


def op5_long_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the later copies of runs of lines and of single long lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.delete_repeated_runs(docs, long_words=line_runs.LONG_WORDS).select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"), F.size("deleted").cast("long").alias("n_deleted"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


OP5_LONG_SQL = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
places AS (SELECT doc_id, i, lines[i + 1] AS line, lines[i + 2] AS next, i + 1 < len(lines) AS has_next
           FROM (SELECT doc_id, lines, unnest(range(len(lines))) AS i FROM split)),
later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, i) AS copy FROM places WHERE has_next)
  WHERE copy > 1),
later_long AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS copy FROM places
    WHERE len(list_filter(regexp_split_to_array(line, '[\x09-\x0D\x20]+'), lambda word: word <> '')) >= 50)
  WHERE copy > 1),
gone AS (SELECT doc_id, i FROM later UNION SELECT doc_id, i + 1 FROM later UNION SELECT doc_id, i FROM later_long),
marked AS (SELECT p.doc_id, p.i, p.line, g.i IS NOT NULL AS deleted
           FROM places p LEFT JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE deleted) AS n_deleted,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT deleted), '')) AS text_sha256
FROM marked GROUP BY doc_id
"""


def op6_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under the mixture and under the base model."""
    return interpolation.score(table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram tokens of every whole document."""
    return unigram.count_tokens(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its group of equal texts."""
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH cleaned AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
ranked AS (
  SELECT doc_id, norm, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
         row_number() OVER w AS place
  FROM cleaned WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST ROWS UNBOUNDED PRECEDING))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM ranked
"""


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near copies."""
    return jaccard.components(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity of every document, from a model fitted on the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.severity(docs.select("doc_id", "text"), model).select("doc_id", "severity", "is_toxic")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every vector, its error, and the codebooks' digest."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", "codebooks_sha256")


def _round_sql(k: int) -> str:
    """Nearest entries under the codebooks of round ``k``."""
    return f"""
near{k} AS (
  SELECT row, p, min(d * 64 + e) % 64 AS e, min(d) AS d FROM (
    SELECT row, p, e, list_sum(list_transform(range(1, len(q) + 1), lambda i: (q[i] - c[i]) * (q[i] - c[i])))::BIGINT AS d
    FROM parts JOIN book{k} USING (p)) GROUP BY row, p)"""


def _moved_sql(k: int) -> str:
    """The codebooks of round ``k`` from the members of the round before."""
    return f"""
sums{k} AS (
  SELECT p, e, place, sum(q[place])::BIGINT AS s, count(*) AS n
  FROM (SELECT p, e, q, unnest(range(1, len(q) + 1)) AS place FROM parts JOIN near{k - 1} USING (row, p)) GROUP BY ALL),
book{k} AS (
  SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k - 1} b LEFT JOIN (
    SELECT p, e, list((s - (s % n + n) % n) // n ORDER BY place) AS c FROM sums{k} GROUP BY p, e) m USING (p, e))"""


OP11_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER () AS row, vec_id, label, embedding AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (
  SELECT row, vec_id, p, list_transform(v[p * w + 1 : (p + 1) * w], lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM (SELECT *, len(v) // 16 AS w, unnest(range(16)) AS p FROM kept)),
ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM (SELECT DISTINCT vec_id FROM kept ORDER BY vec_id LIMIT 64)),
book0 AS (SELECT p, e, min(q) AS c FROM parts JOIN ids USING (vec_id) GROUP BY p, e),
{_round_sql(0)},{_moved_sql(1)},{_round_sql(1)},{_moved_sql(2)},{_round_sql(2)},
coded AS (SELECT row, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near2 GROUP BY row),
digest AS (
  SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY p, e, place)) AS codebooks_sha256
  FROM (SELECT p, e, unnest(c) AS x, unnest(range(len(c))) AS place FROM book2))
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (row), digest
"""


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, perplexity and verdict of every whole document."""
    return quality_rules.rate(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "perplexity")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents")).withColumn("rank", F.col("rank").cast("long"))


OP13_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
sized AS (SELECT lang, w, unnest([1, 2, 3, 4, 5]) AS size FROM pieces),
phrases AS (
  SELECT lang, size, array_to_string(words, ' ') AS phrase, words, f FROM (
    SELECT lang, size, words, count(*) AS f FROM (
      SELECT lang, size, w[i : i + size - 1] AS words FROM (SELECT lang, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM sized))
    GROUP BY lang, size, words HAVING count(*) >= 100)),
covered AS (
  SELECT DISTINCT lang, phrase FROM (
    SELECT lang, f, array_to_string(words[i : i + part - 1], ' ') AS phrase FROM (
      SELECT *, unnest(range(1, size - part + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS part FROM phrases)))
  JOIN (SELECT lang, phrase, f AS a FROM phrases) USING (lang, phrase) WHERE 100 * f >= 100 * a),
cuts AS (SELECT lang, phrase, words, f AS a, size, unnest(range(1, size)) AS cut FROM phrases ANTI JOIN covered USING (lang, phrase) WHERE size > 1),
scored AS (
  SELECT c.lang, c.phrase, a, cut, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN phrases x ON x.lang = c.lang AND x.words = c.words[1 : cut] JOIN phrases y ON y.lang = c.lang AND y.words = c.words[cut + 1 : c.size]),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


QUERIES: dict[str, Query] = {
    "op1_rp_forest": op1_rp_forest,
    "op2_secrets": op2_secrets,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_mixing": op4_mixing,
    "op5_line_runs": op5_line_runs,
    "op5_long_lines": op5_long_lines,
    "op6_interpolation": op6_interpolation,
    "op7_token_counts": op7_token_counts,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_jaccard": op9_jaccard,
    "op10_toxicity": op10_toxicity,
    "op11_vector_codes": op11_vector_codes,
    "op12_quality_rules": op12_quality_rules,
    "op13_collocations": op13_collocations,
}

ORACLES: dict[str, str] = {
    "op4_mixing": OP4_SQL,
    "op5_line_runs": OP5_SQL,
    "op5_long_lines": OP5_LONG_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op11_vector_codes": OP11_SQL,
    "op13_collocations": OP13_SQL,
}
