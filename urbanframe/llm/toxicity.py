"""Toxicity: a logistic classifier with a counterfactual penalty.

Features are hashed words and word beginnings that a text holds. Which of them
matter is learned from counts over a bounded sample of labelled documents,
taken on the executors. The weights minimise log loss plus a penalty on score
changes: in every labelled text that holds an identity term, the term is
swapped for another one of its set, and the squared change of the log odds is
added to the loss. A term thus cannot carry weight that its counterparts do not,
so neutral mentions do not raise the score.

Sets of terms are given (``IDENTITY_TERMS``, names of groups in four languages)
and learned from the training rows alone (``learned_terms``): a word that toxic
texts hold more often than chance allows although most of its mentions are
harmless is the kind of word that draws false positives; it is exchanged for a
word as frequent that both classes hold alike.

Defined results: null and empty texts have no features and get the score of
the intercept; with no labels of one class every score is the share of class 1
(0 with no labels); repeated rows get equal scores, rows with a null id are scored
but never learned from; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanframe.llm.common import documents, id_fold, labelled_sample, labels, small_batches, written

SAMPLE_ROWS = 20_000
FEATURES = 1024
CACHE_WORDS = 500_000
WORD = re.compile(r"\w+")

#: Neutral names of groups, swapped within a list. A parameter.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("african", "european", "american", "chinese", "mexican", "indian"),
    ("immigrant", "native", "refugee"),
    ("disabled", "deaf", "blind", "old", "young"),
    ("frauen", "männer"),
    ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten"),
    ("ausländer", "einheimische", "flüchtlinge"),
    ("femmes", "hommes"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("étrangers", "français", "réfugiés"),
    ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"),
    ("extranjeros", "españoles", "refugiados"),
)
#: Learned terms: most of them, least labelled texts with one, least share of these
#: that is harmless, chance that any of the words tried passes as suspect by chance
#: alone, and most excess of a counterpart (standard deviations of chance).
LEARNED, LEAST_TEXTS, HARMLESS, BY_CHANCE, NEUTRAL = 64, 20, 0.75, 0.05, 0.5
#: Harmless counterparts to choose from.
COUNTERPARTS = 2_000


def word_features(word: str) -> list[int]:
    """Hashes of a word and its beginnings of four to seven letters."""
    return [zlib.crc32(word.encode("utf-8", "surrogatepass")), *(zlib.crc32(f"{word[:n]}*".encode("utf-8", "surrogatepass")) for n in (4, 5, 6, 7) if len(word) >= n)]


def text_words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def swaps(terms: tuple[tuple[str, ...], ...]) -> dict[str, str]:
    """Each term and the next one of its list."""
    return {t: row[(i + 1) % len(row)] for row in terms for i, t in enumerate(row)}


@dataclass
class ToxicModel:
    hashes: np.ndarray  # sorted feature hashes
    weights: np.ndarray
    bias: float
    terms: tuple[tuple[str, str], ...] = ()  # learned terms and their counterparts
    pairs: int = 0  # counterfactual texts that the fit saw
    cache: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.index = dict(zip(self.hashes.tolist(), range(len(self.hashes))))

    def __getstate__(self):
        return self.hashes, self.weights, self.bias, self.terms, self.pairs

    def __setstate__(self, state):
        self.hashes, self.weights, self.bias, self.terms, self.pairs = state
        self.cache = {}
        self.__post_init__()

    def places(self, words: set[str]) -> set[int]:
        """Indices of the features that the words have."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        for w in words.difference(self.cache):
            self.cache[w] = tuple(self.index[h] for h in word_features(w) if h in self.index)
        return {i for hit in filter(None, map(self.cache.__getitem__, words)) for i in hit}

    def score(self, text: str | None) -> float:
        odds = self.bias + sum(self.weights[i] for i in sorted(self.places(text_words(text))))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))


def train(x: np.ndarray, y: np.ndarray, pairs: list[tuple[int, np.ndarray]], counterfactual: float = 5.0, l2: float = 2e-4, steps: int = 400, rate: float = 0.5) -> tuple[np.ndarray, float]:
    """Weights and intercept by adaptive gradient steps.

    ``x`` holds 0/1 rows (uint8), ``pairs`` the row number and the changed
    features (-1, 0, 1) of every counterfactual text.
    """
    n, k = x.shape
    n1 = int(y.sum())
    bias = math.log((n1 + 0.5) / (n - n1 + 0.5))
    w = np.zeros(k)
    if not k or n1 == 0 or n1 == n:
        return w, bias if n else -40.0
    rows = x.astype(np.float32)
    change = np.stack([d for _, d in pairs]).astype(np.float32) if pairs else np.zeros((0, k), np.float32)
    speed, speed_b = np.full(k, 1e-8), 1e-8
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ w.astype(np.float32) + bias, -30, 30)))
        error = (p - y) / n
        g = rows.T @ error.astype(np.float32) + l2 * w
        if len(change):
            g = g + 2 * counterfactual * (change.T @ (change @ w.astype(np.float32))) / len(change)
        gb = float(error.sum())
        speed += g * g
        speed_b += gb * gb
        w -= rate * g / np.sqrt(speed)
        bias -= rate * gb / math.sqrt(speed_b)
    return w, bias


def _feature_counts(sample: DataFrame) -> DataFrame:
    """``feature, word, pos, neg``: how many toxic and other texts of the sample hold each
    feature; ``word`` is null for beginnings of words."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), 256):
                part = frame.iloc[start : start + 256]
                held = [text_words(t) for t in part["text"]]
                hashes = {w: word_features(w) for w in set().union(*held)}
                whole = {h[0]: w for w, h in hashes.items()}
                hashed = [np.array(sorted({h for w in words for h in hashes[w]}), np.int64) for words in held]
                flat = np.concatenate(hashed)
                label = np.repeat(part["label"].to_numpy(), [len(h) for h in hashed])
                feature, inverse = np.unique(flat, return_inverse=True)
                pos = np.bincount(inverse, weights=label, minlength=len(feature)).astype(np.int64)
                words = [whole.get(h) for h in feature.tolist()]
                yield pd.DataFrame({"feature": feature, "word": pd.Series(words, dtype=object), "pos": pos, "neg": np.bincount(inverse, minlength=len(feature)) - pos})

    rows = sample.select("text", "label").mapInPandas(run, "feature long, word string, pos long, neg long")
    return rows.groupBy("feature").agg(F.min("word").alias("word"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def learned_terms(counts: DataFrame, excess: Column, most: int = LEARNED) -> tuple[tuple[str, str], ...]:
    """Pairs of a suspect word and its harmless counterpart of the nearest frequency.

    A suspect's excess among toxic texts has to pass what the largest excess of
    as many words as are tried would pass by chance with odds of ``BY_CHANCE``.
    """
    total = F.col("pos") + F.col("neg")
    words = counts.where(F.col("word").isNotNull() & (total >= LEAST_TEXTS)).select("word", "neg", total.alias("n"), excess.alias("excess"))
    tried = words.count()
    if not tried:
        return ()
    least = NormalDist().inv_cdf(1 - BY_CHANCE / tried)
    suspects = words.where((F.col("excess") > least) & (F.col("neg") >= HARMLESS * F.col("n"))).orderBy(F.desc("excess"), "word").limit(most).collect()
    calm = words.where(F.abs("excess") < NEUTRAL).orderBy(F.desc("n"), "word").limit(COUNTERPARTS).collect()
    return tuple((s.word, min(calm, key=lambda c: (abs(c.n - s.n), c.word)).word) for s in suspects) if calm else ()


def fit(docs: DataFrame, labels: DataFrame, keep: Column | None = None, rows: int = SAMPLE_ROWS, features: int = FEATURES, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, counterfactual: float = 5.0, learned: int = LEARNED) -> ToxicModel:
    """Learn from labelled documents for which ``keep`` holds, about ``rows`` of them."""
    small_batches(docs.sparkSession)
    ids = labelled_sample(labels, "toxic", keep, rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
    n1, n = sample.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    # Features that toxic texts hold more often than chance allows, the strongest first.
    share = n1 / n if n else 0.0
    total = F.col("pos") + F.col("neg")
    excess = (F.col("pos") - total * share) / F.sqrt(total * max(share * (1 - share), 1e-9))
    counts = written(_feature_counts(sample))
    found = learned_terms(counts, excess, learned) if learned else ()
    exchange = swaps(terms) | dict(found)
    forced = {h for t in [*swaps(terms), *(w for pair in found for w in pair)] for h in word_features(t)[:1]}
    strong = counts.where((F.col("pos") >= 3) & (excess > 4.5)).orderBy(excess.desc(), "feature").limit(features)
    chosen = {r.feature for r in strong.select("feature").collect()} | forced
    empty = ToxicModel(np.array(sorted(chosen), np.int64), np.zeros(len(chosen)), 0.0)

    @F.pandas_udf("struct<held: array<int>, swapped: array<int>>")
    def places(texts: pd.Series) -> pd.DataFrame:
        held, swapped = [], []
        for t in texts:
            words = text_words(t)
            held.append(sorted(empty.places(words)))
            other = {exchange.get(w, w) for w in words}
            swapped.append(sorted(empty.places(other)) if words & exchange.keys() else None)
        return pd.DataFrame({"held": held, "swapped": swapped})

    seen = sample.select("doc_id", "label", places("text").alias("p")).collect()
    seen.sort(key=lambda r: (r.doc_id, r.label, r.p.held))
    x = np.zeros((len(seen), len(chosen)), np.uint8)
    pairs = []
    for i, r in enumerate(seen):
        x[i, r.p.held] = 1
        if r.p.swapped is not None:
            other = np.zeros(len(chosen), np.int8)
            other[r.p.swapped] = 1
            pairs.append((i, other - x[i].astype(np.int8)))
    w, bias = train(x, np.array([r.label for r in seen], np.float64), pairs, counterfactual)
    return ToxicModel(empty.hashes, w, bias, found, len(pairs))


def mention_report(docs: DataFrame, labels: DataFrame, model: ToxicModel, keep: Column | None = None) -> DataFrame:
    """``texts, false_positives, mean_score`` of harmless labelled texts that hold one of the model's learned terms."""
    terms = {w for w, _ in model.terms}

    @F.pandas_udf("boolean")
    def mentions(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(text_words(t) & terms) for t in texts], dtype=bool)

    calm = labels.where((F.col("toxic") == 0) & (F.lit(True) if keep is None else keep)).select("doc_id").distinct()
    scored = docs.select("doc_id", "text").join(calm, "doc_id").where(mentions("text")).select(score_column(model).alias("score"))
    return scored.agg(F.count(F.lit(1)).alias("texts"), F.coalesce(F.sum((F.col("score") >= 0.5).cast("int")), F.lit(0)).alias("false_positives"), F.avg("score").alias("mean_score"))


def score_column(model: ToxicModel, text: str = "text") -> Column:
    """Probability that a text is toxic."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return score(F.col(text))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, labels(spark, sf_dir), id_fold(5) != 0)
    scored = docs.select("doc_id", (id_fold(5) == 0).alias("held_out"), score_column(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
