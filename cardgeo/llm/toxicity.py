"""Toxicity by non-negative positive-unlabelled (PU) learning.

Confirmed toxic texts are the positive examples; the labelled rows with their
labels hidden are the unlabelled texts; the class prior is the share of toxic
rows among them. A linear classifier in numpy minimises

    prior * E_p[l(z)] + max(0, E_u[l(-z)] - prior * E_p[l(-z)])

with the logistic loss l: the negative part of the risk, corrected for the
positives hidden among the unlabelled, may not fall below zero; where it
would, the step is taken the other way.

Features are rates of single words (letter runs, lower-cased) that occur in
positives far more often than in unlabelled texts; their document frequencies
are counted by Spark. Fitting uses a bounded sample: at most ``POSITIVES`` and
``UNLABELLED`` rows, those of smallest hash. Every text is scored whole.

Labels, language, source and id are never inputs of a score. Defined results:
null text scores like the empty text; a null id counts as not held out but has
no label; without positive examples every score is the prior (0 without
labels). Repeated rows score alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_batches
from .lm import held_out

POSITIVES, UNLABELLED = 4096, 8192
FEATURES = 512
#: A feature word occurs in at least so many positives, and so many times as
#: often in them as in unlabelled texts, by so many standard errors.
LEAST, RATIO, ERRORS = 3, 2.5, 4.0
STEPS, RATE, DECAY = 400, 0.05, 1e-4
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def rate(count: float, n: int) -> float:
    """A word's weight in a text of ``n`` words."""
    return float(np.log1p(200.0 * count / (n + 20)))


class Classifier:
    """Weights of feature words and an offset."""

    def __init__(self, weights: dict[str, float], offset: float):
        self.weights, self.offset = weights, offset

    def score(self, text: str | None) -> float:
        words = words_of(text)
        hits = Counter(filter(self.weights.__contains__, words))
        z = self.offset + sum(self.weights[w] * rate(c, len(words)) for w, c in hits.items())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit_pu(x: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and offset minimising the non-negative PU risk over the rows of
    ``x``; the flags say which are positive and which count as unlabelled
    (both, for a positive row of the unlabelled sample)."""
    in_p, in_u = positive / positive.sum(), unlabelled / unlabelled.sum()
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    falling = lambda z: 1 / (1 + np.exp(np.clip(z, -30, 30)))  # noqa: E731  -l'(z)
    loss = lambda z: np.logaddexp(0, -z)
    for step in range(1, STEPS + 1):
        z = x @ w[:-1].astype(x.dtype) + w[-1]
        plus = -prior * falling(z) * in_p
        minus = falling(-z) * (in_u - prior * in_p)
        below = loss(-z) @ (in_u - prior * in_p) < 0
        c = -minus if below else plus + minus
        g = np.r_[c.astype(x.dtype) @ x, c.sum()] + DECAY * np.r_[w[:-1], 0]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def _bag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        bags = [Counter(words_of(t)) for t in pdf["text"]]
        yield pd.DataFrame({"positive": pdf["positive"], "unlabelled": pdf["unlabelled"],
                            "n": [sum(b.values()) for b in bags], "words": [list(b) for b in bags],
                            "counts": [list(b.values()) for b in bags]})


def train(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Fit on the labelled rows of ``labels`` (``doc_id, toxic``) that are not
    held out."""
    labelled = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
                .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"), 5))
                .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    prior = labelled.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    by_hash = F.xxhash64("doc_id")
    positive = labelled.where("toxic = 1").orderBy(by_hash).limit(POSITIVES)
    unlabelled = labelled.orderBy(by_hash).limit(UNLABELLED)
    sample = (positive.select("doc_id", F.lit(1).alias("positive"), F.lit(0).alias("unlabelled"))
              .unionByName(unlabelled.select("doc_id", F.lit(0).alias("positive"), F.lit(1).alias("unlabelled")))
              .groupBy("doc_id").agg(F.max("positive").alias("positive"), F.max("unlabelled").alias("unlabelled")))
    sample = materialize(sample, "op8-sample")  # at most POSITIVES + UNLABELLED rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    bags = materialize(text_batches(texts).mapInPandas(_bag, "positive int, unlabelled int, n long, words array<string>, "
                                               "counts array<int>"), "op8-bags")
    size = bags.agg(F.sum("positive"), F.sum("unlabelled")).first()
    n_p, n_u = size[0] or 0, size[1] or 0
    if not n_p or not 0 < prior < 1:
        return Classifier({}, -30.0 if prior <= 0 else float(np.log(prior / max(1 - prior, 1e-12))))
    found = (bags.select("positive", "unlabelled", F.explode("words").alias("word"))
             .groupBy("word").agg(F.sum("positive").alias("p"), F.sum("unlabelled").alias("u"))
             .where(F.col("p") >= LEAST))
    base = (F.col("u") + 0.5) / (n_u + 1)
    ahead = F.col("p") / n_p - base
    found = (found.where(F.col("p") / n_p >= RATIO * base)
             .withColumn("errors", ahead / F.sqrt(base * (1 - F.least(base, F.lit(0.99))) / n_p))
             .where(F.col("errors") >= ERRORS).orderBy(F.desc("errors"), "word").limit(FEATURES))
    names = sorted(r["word"] for r in found.collect())
    if not names:
        return Classifier({}, float(np.log(prior / (1 - prior))))
    pairs = F.arrays_zip("words", "counts")
    chosen = F.array(*map(F.lit, names))
    hits = F.filter(pairs, lambda h: F.array_contains(chosen, h["words"]))
    rows = (bags.withColumn("hits", hits)
            .select("positive", "unlabelled", "n", F.col("hits.words").alias("words"), F.col("hits.counts").alias("counts"))
            .toPandas())
    at = {w: i for i, w in enumerate(names)}
    x = np.zeros((len(rows), len(names)), np.float32)
    for i, (n, words, counts) in enumerate(zip(rows["n"], rows["words"], rows["counts"])):
        for w, c in zip(words, counts):
            x[i, at[w]] = rate(c, n)
    weights, offset = fit_pu(x, rows["positive"].to_numpy(float), rows["unlabelled"].to_numpy(float), float(prior))
    return Classifier({w: float(v) for w, v in zip(names, weights)}, offset)


def score(docs: DataFrame, model: Classifier, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with the score of a text column, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.score(t) for t in texts], dtype=float)

    return text_batches(docs).withColumn(score_col, of(F.col(text_col)))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = train(docs, labels)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return (score(docs, model).select("doc_id", held_out(F.col("doc_id"), 5).alias("held_out"), "score",
                                      (F.col("score") >= 0.5).cast("int").alias("predicted")))
