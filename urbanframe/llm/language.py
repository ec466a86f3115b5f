"""Language identification: averaged hashed subword embeddings, linear softmax.

A text's lower-cased bytes, with everything but letters as single spaces, give
hashed byte n-grams of two to four. Their embeddings are averaged and a linear
layer with softmax names the language. Embeddings and layer are learned on the
driver by stochastic gradient descent in numpy, from a sample of labelled
documents bounded by ``rows`` and reduced on the executors to hashed counts.
A fifth of the sample is kept aside to fit a temperature (so scores are
probabilities) and the score under which a prediction should be rejected.

Defined results: null texts and texts without a letter are ``und`` with score
0; with nothing to learn from every text is ``und``; repeated rows get equal
predictions; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanframe.llm.common import documents, id_fold, small_batches

SAMPLE_ROWS = 3000
BUCKETS = 4096
UNKNOWN = "und"

_FOLD = np.full(256, 32, np.uint64)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def has_letter(text: str | None) -> bool:
    return bool(text) and next(filter(str.isalpha, text), None) is not None


def subword_counts(text: str | None) -> np.ndarray:
    """Hashed counts of byte 2- to 4-grams of one whole text."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass")
    code = _FOLD[np.frombuffer(b" " + raw + b" ", np.uint8)]
    code = code[np.concatenate([[True], (code[1:] != 32) | (code[:-1] != 32)])]
    counts = np.zeros(BUCKETS, np.int64)
    gram = code
    for n in (2, 3, 4):
        if len(code) < n:
            break
        gram = (gram[:-1] << np.uint64(8)) | code[n - 1 :]
        bucket = ((gram + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(52)
        counts += np.bincount(bucket.astype(np.int64), minlength=BUCKETS)
    return counts


@dataclass
class LanguageModel:
    languages: list[str]
    embedding: np.ndarray  # (BUCKETS, width)
    weights: np.ndarray  # (width, languages)
    bias: np.ndarray
    temperature: float = 1.0
    reject_below: float = 0.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.embedding) @ self.weights + self.bias

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return _softmax(self.logits(x) / self.temperature)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def averaged(counts: np.ndarray) -> np.ndarray:
    return (counts / np.maximum(counts.sum(1, keepdims=True), 1)).astype(np.float32)


def train(x: np.ndarray, y: np.ndarray, languages: list[str], width: int = 16, epochs: int = 30, rate: float = 8.0, batch: int = 16, seed: int = 5, precision: float = 0.995) -> LanguageModel:
    """Stochastic gradient descent on averaged counts ``x`` and class indices ``y``."""
    draw = np.random.default_rng(seed)
    order = draw.permutation(len(y))
    aside, kept = (order[: len(y) // 5], order[len(y) // 5 :]) if len(y) >= 20 else (order, order)
    model = LanguageModel(
        languages, draw.normal(0, 0.5, (x.shape[1], width)).astype(np.float32), draw.normal(0, 0.5, (width, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)
    )
    steps, step = epochs * max(1, -(-len(kept) // batch)), 0
    for _ in range(epochs):
        shuffled = draw.permutation(kept)
        for start in range(0, len(shuffled), batch):
            rows = shuffled[start : start + batch]
            lr = np.float32(rate * (1 - step / steps))
            step += 1
            hidden = x[rows] @ model.embedding
            error = _softmax(hidden @ model.weights + model.bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            error /= len(rows)
            back = error @ model.weights.T
            model.weights -= np.float32(0.1) * lr * (hidden.T @ error)
            model.bias -= np.float32(0.02) * lr * error.sum(0)
            model.embedding -= lr * (x[rows].T @ back)
    logits = model.logits(x[aside])
    losses = {t: -np.log(_softmax(logits / t)[np.arange(len(aside)), y[aside]] + 1e-12).mean() for t in np.geomspace(0.2, 8, 30)}
    model.temperature = float(min(losses, key=losses.get))
    p = model.probabilities(x[aside])
    top = p.max(1)
    right = p.argmax(1) == y[aside]
    model.reject_below = next((float(t) for t in np.sort(top) if right[top >= t].mean() >= precision), 1.0)
    return model


def fit(docs: DataFrame, keep: Column | None = None, rows: int = SAMPLE_ROWS, seed: int = 23) -> LanguageModel | None:
    """Learn from ``text`` and non-null ``lang`` of rows for which ``keep`` holds, about ``rows`` of them.

    Rows are drawn by their id, so those without one are left out: they would all share a draw.
    """
    small_batches(docs.sparkSession)
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (F.lit(True) if keep is None else keep)).select("doc_id", "text", "lang")
    total = known.select("doc_id").count()
    share = 2**30 if total <= rows else int(2**30 * rows / total)

    @F.pandas_udf("struct<at: array<short>, n: array<int>>")
    def reduced(texts: pd.Series) -> pd.DataFrame:
        counts = [subword_counts(t) for t in texts]
        places = [np.flatnonzero(c) for c in counts]
        return pd.DataFrame({"at": [p.astype(np.int16) for p in places], "n": [c[p].astype(np.int32) for c, p in zip(counts, places)]})

    sample = known.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2**30)) < share)
    found = sample.select("doc_id", "lang", reduced("text").alias("x")).toPandas()
    if found.empty:
        return None
    found = found.iloc[sorted(range(len(found)), key=lambda i: (str(found.doc_id[i]), found.lang[i], len(found.x[i]["at"])))]
    languages = sorted(set(found.lang))
    x = np.zeros((len(found), BUCKETS), np.float32)
    for i, row in enumerate(found.x):
        x[i, np.asarray(row["at"], np.int64)] = row["n"]
    return train(averaged(x), np.array([languages.index(v) for v in found.lang]), languages)


def predict_column(model: LanguageModel | None, text: str = "text") -> Column:
    """Struct of ``lang_pred, score, accepted`` for a text column."""

    @F.pandas_udf("struct<lang_pred: string, score: double, accepted: boolean>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names = np.full(len(texts), UNKNOWN, object)
        score = np.zeros(len(texts))
        at = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
        for start in range(0, len(at), 512):
            rows = at[start : start + 512]
            p = model.probabilities(averaged(np.stack([subword_counts(texts.iloc[i]) for i in rows])))
            names[rows] = np.array(model.languages, object)[p.argmax(1)]
            score[rows] = np.minimum(p.max(1), 1.0)
        accepted = (names != UNKNOWN) & (score >= (model.reject_below if model else 1))
        return pd.DataFrame({"lang_pred": names, "score": score, "accepted": accepted})

    return predict(F.col(text))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, id_fold(4) != 2)
    found = docs.select("doc_id", (id_fold(4) == 2).alias("held_out"), predict_column(model).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.accepted")
