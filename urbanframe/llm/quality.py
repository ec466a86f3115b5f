"""Quality classifier: regularised quadratic discriminant on document statistics.

Each text becomes a short vector of transformed statistics. Each class gets its
mean and a covariance shrunk towards the pooled diagonal; the score is the
logistic of the difference of the two Gaussian log densities, each from a
Mahalanobis distance with the inverse Cholesky factor computed once.

The model is fitted on a sample of labelled documents bounded by ``rows`` and
is a few hundred numbers. Scoring is one pass over the documents.

Defined results: null and empty texts have all statistics at their value for
no words and get a score like any text; with no labels of one class every
score is the share of class 1 (0.5 with no labels at all); repeated rows get
equal scores; other columns stay as they are.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanframe.llm.common import documents, fresh, id_fold, labelled_sample, labels, small_batches

SAMPLE_ROWS = 20_000


def _byte_class(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


UPPER = _byte_class(bytes(range(65, 91)))
LOWER = _byte_class(bytes(range(97, 123)))
DIGIT = _byte_class(bytes(range(48, 58)))
BLANK = _byte_class(b" \t\n\r\x0b\x0c")
STOPS = _byte_class(b".,;:'\"?-()")
CONTROL = _byte_class(bytes([*range(9), *range(14, 32), 127]))
HIGH = _byte_class(bytes(range(128, 256)))
SYMBOL = ~(UPPER | LOWER | DIGIT | BLANK | STOPS | CONTROL | HIGH)
CLASSES = np.stack([UPPER, LOWER, DIGIT, BLANK, STOPS, CONTROL, HIGH, SYMBOL], 1).astype(np.float64)


def _logit(share: float) -> float:
    return math.log((share + 0.002) / (1.002 - share))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of one whole text."""
    text = text or ""
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    upper, lower, digit, blank, stops, control, high, symbol = (counts @ CLASSES).tolist()
    letters = upper + lower + high or 1.0
    inked = max(1.0, float(counts.sum()) - blank)
    words = text.split()
    n = len(words) or 1
    seen = Counter(words)
    again = sum(map(str.__eq__, words, words[1:]))
    most = max(seen.values(), default=0)
    lines = text.split("\n")
    short = sum(map((4).__gt__, map(len, words)))
    return [
        math.log1p(len(words)),
        math.log((inked + 1) / (n + 1)),
        _logit(upper / letters),
        _logit(digit / inked),
        _logit(stops / inked),
        _logit(symbol / inked),
        _logit(control / inked),
        _logit(float(counts[33]) / inked),
        _logit(min(1.0, float(counts[124]) / n)),
        _logit(math.log1p(len(seen)) / math.log1p(n + 1)),
        _logit(again / n),
        _logit(most / n),
        _logit(1 - len(set(lines)) / len(lines)),
        _logit(min(1.0, len(lines) / (n + 1))),
        _logit(short / n),
    ]


@dataclass
class Discriminant:
    """Two Gaussians with cached inverse Cholesky factors."""

    prior: float  # log odds of class 1
    means: np.ndarray | None = None  # (2, k)
    inverse_factors: np.ndarray | None = None  # (2, k, k)
    log_dets: np.ndarray | None = None  # (2,)
    temperature: float = 1.0

    def score(self, x: np.ndarray) -> np.ndarray:
        odds = np.full(len(x), self.prior)
        if self.means is not None:
            log_density = []
            for c in (0, 1):
                white = (x - self.means[c]) @ self.inverse_factors[c].T
                log_density.append(-0.5 * (np.einsum("ij,ij->i", white, white) + self.log_dets[c]))
            odds = odds + (log_density[1] - log_density[0]) / self.temperature
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def fit_discriminant(x: np.ndarray, y: np.ndarray, shrinkage: float = 0.1) -> Discriminant:
    """Class means and shrunk covariances of rows ``x`` with labels ``y``."""
    n1 = int((y == 1).sum())
    n0 = len(y) - n1
    prior = math.log((n1 + 0.5) / (n0 + 0.5)) if len(y) else 0.0
    if min(n0, n1) < 2:
        return Discriminant(prior)
    pooled = np.concatenate([x[y == c] - x[y == c].mean(0) for c in (0, 1)])
    target = np.diag(pooled.var(0) + 1e-3)
    means, factors, log_dets = [], [], []
    for c, n in ((0, n0), (1, n1)):
        weight = max(shrinkage, x.shape[1] / (x.shape[1] + n))  # small classes lean on the pooled diagonal
        covariance = (1 - weight) * np.cov(x[y == c].T, bias=True) + weight * target
        lower = np.linalg.cholesky(covariance)
        means.append(x[y == c].mean(0))
        factors.append(np.linalg.inv(lower))
        log_dets.append(2 * np.log(np.diag(lower)).sum())
    return Discriminant(prior, np.array(means), np.array(factors), np.array(log_dets), temperature=float(np.sqrt(x.shape[1])))


def statistics_column(text: str = "text") -> Column:
    """Statistics of a text column as an array."""

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return run(F.col(text))


def fit(docs: DataFrame, labels: DataFrame, keep: Column | None = None, rows: int = SAMPLE_ROWS, shrinkage: float = 0.1) -> Discriminant:
    """Learn from labelled documents for which ``keep`` holds, ``rows`` of them at most (about)."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(labels, "quality", keep, rows)
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "label", statistics_column("text").alias("x")).collect()
    found.sort(key=lambda r: (r.doc_id, r.x))
    x = np.array([r.x for r in found]).reshape(len(found), len(statistics("")))
    return fit_discriminant(x, np.array([r.label for r in found]), shrinkage)


def score_column(model: Discriminant, text: str = "text") -> Column:
    """Probability of good quality of a text column."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.array([statistics(t) for t in texts])))

    return score(F.col(text))


def learnable() -> Column:
    """Rows that the query may learn labels from."""
    return id_fold(3) != 1


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, labels(spark, sf_dir), learnable())
    scored = docs.select("doc_id", (id_fold(3) == 1).alias("held_out"), score_column(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = fit(docs, labels(spark, sf_dir), learnable())
    score = fresh("_score", docs)
    return docs.withColumn(score, score_column(model)).where(F.col(score) >= 0.5).select(*docs.columns)
