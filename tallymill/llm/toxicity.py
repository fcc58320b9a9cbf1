"""Toxicity by cumulative-link ordinal regression on words.

Severity grades 0 to K-1 are cut by ordered thresholds on one linear score that all share:
P(grade > k) = sigmoid(w.x - threshold_k).  x marks which of the chosen words a document has.
The expected severity is the sum of these probabilities.

Fitting uses a bounded sample of the labelled rows (``SAMPLE_PER_LABEL`` of each label); scoring
covers every whole text in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.common import ROWS_AT_A_TIME, free_name, id_and_text, named, stored

# Labelled rows of each label that the model is fitted on, at most: those with the smallest hash of their id.
SAMPLE_PER_LABEL = 3000
# Words the model may weigh at most: those of greatest evidence.
MOST_WORDS = 1024
# A word is weighed if so many toxic texts of the sample have it (all, if there are fewer), and its share of them is
# so many times that of the clean ones, whatever the sample's size.
LEAST_TOXIC = 2
LEAST_RATIO = 20
# So many times as many toxic as clean texts of the sample must have a word's beginning.
CLEAN_TO_TOXIC = 200
# Severity grades of the labelled rows: 0 is clean; a toxic text has the number of its indicative words with
# different beginnings, from 1 up to this.
MOST_SEVERE = 3

_WORDS = re.compile(r"[^\W\d_]+").findall


def words(text: str) -> set[str]:
    """The text's words, and their beginnings of four and five letters, marked by a star, for other endings."""
    whole = set(_WORDS(text.lower()))
    return whole | {w[:4] + "*" for w in whole if len(w) > 4} | {w[:5] + "*" for w in whole if len(w) > 5}


@dataclass(frozen=True)
class Model:
    """Weights by word, and ascending thresholds between the grades."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def score(self, text: str) -> tuple[float, bool]:
        """Expected severity, and whether a grade above 0 is likelier than not."""
        total = sum(self.weights[w] for w in words(text) & self.weights.keys())
        above = [1.0 / (1.0 + np.exp(min(t - total, 700.0))) for t in self.thresholds]
        return float(sum(above)), bool(above) and above[0] >= 0.5


def fit_ordinal(present: list[np.ndarray], grades: np.ndarray, n_words: int, steps=800, rate=0.05, shrink: float | np.ndarray = 0.5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of greatest penalised likelihood (Adam on all rows).

    ``present`` holds each row's word numbers.  Thresholds are a first one and positive steps, so they
    stay ordered.  Rows of grade 0 and the others weigh one half together each.  ``shrink`` is one number or
    one for each word.
    """
    top = int(grades.max())
    row = np.repeat(np.arange(len(present)), [len(x) for x in present])
    word = np.concatenate([*present, np.zeros(0, np.int64)]).astype(np.int64)
    clean = grades == 0
    share = np.where(clean, 0.5 / max(clean.sum(), 1), 0.5 / max((~clean).sum(), 1))
    values = np.zeros(n_words + top)
    first, second = np.zeros_like(values), np.zeros_like(values)
    ranks = np.arange(top)
    for step in range(1, steps + 1):
        weights, raw = values[:n_words], values[n_words:]
        gaps = np.exp(raw[1:])
        cuts = raw[0] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(row, weights[word], len(present))
        above = 1.0 / (1.0 + np.exp(np.clip(cuts - score[:, None], -500, 500)))  # P(grade > k)
        bounds = np.hstack([np.ones((len(score), 1)), above, np.zeros((len(score), 1))])
        slopes = bounds * (1 - bounds)
        at = np.arange(len(score))
        likely = np.maximum(bounds[at, grades] - bounds[at, grades + 1], 1e-12)
        by_score = share * (slopes[at, grades] - slopes[at, grades + 1]) / likely
        by_cut = np.zeros((len(score), top + 2))
        by_cut[at, grades] -= share * slopes[at, grades] / likely
        by_cut[at, grades + 1] += share * slopes[at, grades + 1] / likely
        cut_slope = by_cut[:, 1:-1].sum(axis=0)
        slope = np.concatenate([
            np.bincount(word, by_score[row], n_words) - shrink * weights / len(present),
            [cut_slope.sum()], gaps * np.array([cut_slope[k:].sum() for k in ranks[1:]]),
        ])
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        values = values + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    raw = values[n_words:]
    return values[:n_words], raw[0] + np.concatenate([[0.0], np.cumsum(np.exp(raw[1:]))])


def _listed(sample: DataFrame, find: Callable[[str, bool], list], kind: str) -> DataFrame:
    """``toxic``, ``found``: what ``find`` makes of each row, a few rows at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_A_TIME):
                part = batch.slice(start, ROWS_AT_A_TIME)
                found = [find(*row) for row in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                kinds = pa.list_(pa.string() if kind == "string" else pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array(found, kinds)], names=["toxic", "found"])
    return sample.select("text", "toxic").mapInArrow(run, f"toxic boolean, found array<{kind}>")


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic") -> Model:
    """Fit on labelled documents.

    Labels that are null, or of ids that no document has, are left out; of repeated labels of an id the
    greater counts.  Without documents of both labels the model has no thresholds and finds nothing.
    Words are chosen by counts that hold at every size; a word's evidence is its smoothed log-odds between the
    labels in standard errors, and the weaker it is beside the strongest, the more its weight is shrunk: words
    met by chance count only where nothing better explains the labels.
    The driver gets at most ``2 * SAMPLE_PER_LABEL`` lists of word numbers and ``MOST_WORDS`` words.
    """
    texts = id_and_text(docs, id_col, text_col)
    known = labels.select(named(id_col).cast("long").alias("doc_id"), (named(label_col).cast("int") > 0).alias("toxic")).dropna()
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for value in (True, False):
        part = known.where(F.col("toxic") == F.lit(value)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_LABEL)
        chosen = part if chosen is None else chosen.unionByName(part)
    # Bounded by the sample's size, whatever the tables hold.
    sample = stored(texts.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("text", "toxic"), "sample")
    sizes = dict(sample.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_clean:
        return Model({}, ())
    listed = _listed(sample, lambda text, toxic: sorted(words(text)), "string")
    counted = listed.select("toxic", F.explode("found").alias("word")).groupBy("word").agg(
        F.count_if("toxic").alias("t"), F.count_if(~F.col("toxic")).alias("c"))
    t, c = F.col("t"), F.col("c")
    cells = [t + 0.5, F.lit(n_toxic) - t + 0.5, c + 0.5, F.lit(n_clean) - c + 0.5]
    odds = F.log(cells[0]) - F.log(cells[1]) - F.log(cells[2]) + F.log(cells[3])
    evidence = odds / F.sqrt(sum(1.0 / x for x in cells[1:]) + 1.0 / cells[0])
    often = (t >= min(LEAST_TOXIC, n_toxic)) & (t * n_clean >= c * (LEAST_RATIO * n_toxic)) & (evidence > 0)
    # A beginning stands for words not seen yet, so it must hardly occur in clean texts.
    sure = ~F.col("word").endswith("*") | (c * CLEAN_TO_TOXIC <= t)
    best = counted.where(often & sure).withColumn("evidence", evidence).orderBy(F.desc("evidence"), "word").limit(MOST_WORDS)
    found = [(r["word"], r["evidence"]) for r in best.select("word", "evidence").collect()]
    if not found:
        return Model({}, ())
    number = {word: k for k, (word, _) in enumerate(found)}
    strength = np.array([value for _, value in found])

    def graded(text: str, toxic: bool) -> list[int]:
        """The grade, then the numbers of the words."""
        found = words(text)
        grade = min(max(len({w[:4] for w in found & number.keys()}), 1), MOST_SEVERE) if toxic else 0
        return [grade, *sorted(number[w] for w in found & number.keys())]

    rows = [r["found"] for r in _listed(sample, graded, "int").collect()]
    grades = np.array([r[0] for r in rows])
    _, grades = np.unique(grades, return_inverse=True)  # grades that occur
    weights, cuts = fit_ordinal([np.array(r[1:], np.int64) for r in rows], grades, len(number), shrink=0.5 * (strength.max() / strength) ** 2)
    return Model({w: float(weights[k]) for w, k in number.items()}, tuple(map(float, cuts)))


def severity(docs: DataFrame, model: Model, text_col="text") -> DataFrame:
    """All rows and columns of ``docs`` with ``severity`` (double) and ``is_toxic`` (boolean) behind them.

    Columns of these names are replaced.  A null or empty text has no words and the severity of such.
    """
    @F.pandas_udf("severity double, is_toxic boolean")
    def rated(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.score(t or "") for t in column], columns=["severity", "is_toxic"])

    held = docs.drop("severity", "is_toxic")
    both = free_name(held, "rated")
    out = held.withColumn(both, rated(named(text_col).cast("string")))
    return out.select(*[named(c) for c in held.columns], f"{both}.severity", f"{both}.is_toxic")
