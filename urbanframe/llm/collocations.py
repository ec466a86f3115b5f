"""Phrase collocations: contiguous phrases scored by how far they outrun their parts.

Texts are lower-cased (A-Z) and cut into pieces at punctuation and line ends,
pieces into words at spaces and tabs. Phrases are counted for each group (by
default each language; null reads as ``und``) by direct-address tiles. Words that reach the least
count are ranked by frequency over all groups; a pair of ranks is an address in
a square tile of ``TILE`` ranks a side. A task gathers the pairs of some texts
and counts each well-filled tile with one dense ``bincount``; pairs in sparse
tiles are sorted as coordinates and counted by runs. Pairs that reach the least
count over all tasks are ranked again and become units of their own, and the
next round counts (phrase, word) the same way, up to ``longest`` words. A phrase
can only reach the least count if its first and last parts do, so leaving out
the others loses nothing.

At most ``LISTED`` units are ranked and broadcast in a round (8 bytes each, the
most frequent ones). If more reach the least count, those beyond the list keep
their 64-bit hash as address and go to the sorted coordinates, so the list only
decides where a pair is counted. Units are named by hashes; all units that
reach the least count are checked to have different ones, else the run starts
anew with another seed. A rare word whose hash equals another's by chance (odds
of about 1 in 2 ** 64 a pair) counts as that word.

Scores are exact: products are decimals of 38 digits.

Defined results: null, empty and blank texts have no words; repeated rows count
as often as they stand there; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.llm.anchors import mixed
from urbanframe.llm.common import broadcast_if_small, documents, small_batches, written
from urbanframe.llm.words import Block, blocks, byte_set

LEAST = 10
LONGEST = 3
TOP = 2000
#: Score multiplier, and the share (percent) of a longer phrase that makes its part redundant.
SCALE = 1_000_000
SHARE = 50
#: Units ranked and broadcast in a round.
LISTED = 1_000_000
#: Ranks a side of a tile; pairs from which a tile is counted densely.
TILE = 512
DENSE = 8192
#: Words gathered in a task before their pairs are counted and sent on.
GATHERED = 4_000_000

BREAKS = byte_set((0x0A, 0x0D)) | np.isin(np.arange(256), list(b".,;:!?"))
SEPARATORS = np.isin(np.arange(256), list(b" \t"))


def _seeded(value: np.ndarray, seed: int) -> np.ndarray:
    return mixed(value + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))


def joined_unit(first: np.ndarray, last: np.ndarray, seed: int) -> np.ndarray:
    """Name (uint64) of a phrase from its first part's and its last word's."""
    return mixed(_seeded(first, seed) * np.uint64(0xD6E8FEB86659FD93) + last)


class Texts:
    """Words of a block with their units, which differ between groups."""

    def __init__(self, block: Block, groups: list[str], seed: int):
        self.block = block
        names, self.group = np.unique(np.array(groups, dtype=object).astype(str), return_inverse=True)
        self.names = names.tolist()
        marks = np.array([_group_mark(name, seed) for name in self.names], np.uint64)
        self.unit = _seeded(block.hashes() ^ marks[self.group[block.text]], seed)


def _group_mark(name: str, seed: int) -> int:
    data = name.encode("utf-8", "surrogatepass")
    return reduce(lambda h, b: ((h ^ b) * 0x100000001B3) & (2**64 - 1), data, 0xCBF29CE484222325 + seed & (2**64 - 1))


def _texts(frame: pd.DataFrame, seed: int) -> Iterator[Texts]:
    groups = frame["grp"].tolist()
    for first, block in blocks(frame["text"].tolist(), SEPARATORS, BREAKS):
        if len(block):
            yield Texts(block, groups[first : first + block.texts], seed)


VOCABULARY = "grp string, word string, unit long, n long"


def _vocabulary(texts: DataFrame, seed: int) -> DataFrame:
    """``VOCABULARY``: every word of every group with its count."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for frame in frames:
            for own in _texts(frame, seed):
                unit, first, n = np.unique(own.unit, return_index=True, return_counts=True)
                raw, block = own.block.raw.tobytes(), own.block
                for u, i, k in zip(unit.tolist(), first.tolist(), n.tolist()):
                    if (known := held.get(u)) is None:
                        held[u] = [own.names[own.group[block.text[i]]], raw[block.start[i] : block.end[i]], k]
                    else:
                        known[2] += k
                if len(held) > GATHERED // 16:
                    yield listed(held)
                    held = {}
        if held:
            yield listed(held)

    def listed(held: dict[int, list]) -> pd.DataFrame:
        group, word, n = zip(*held.values())
        return pd.DataFrame({"grp": group, "word": [w.decode("utf-8", "replace") for w in word], "unit": np.fromiter(held, np.uint64, len(held)).view(np.int64), "n": n})

    return texts.mapInPandas(run, VOCABULARY).groupBy("grp", "word", "unit").agg(F.sum("n").alias("n"))


class Ranks:
    """The most frequent units in order of frequency; the others keep their name as address."""

    def __init__(self, units: np.ndarray, complete: bool):
        self.units, self.complete = units, complete
        self.order = np.argsort(units)
        self.sorted = units[self.order]

    def of(self, unit: np.ndarray) -> np.ndarray:
        """Ranks (int64); -1 for a unit that is not listed."""
        if not len(self.units):
            return np.full(len(unit), -1, np.int64)
        at = np.minimum(np.searchsorted(self.sorted, unit), len(self.sorted) - 1)
        return np.where(self.sorted[at] == unit, self.order[at], -1)


def _ranked(units: DataFrame, listed: int) -> Ranks:
    """Ranks of ``unit, n``, cut at a count so that at most ``listed`` units are collected."""
    held, least = 0, None
    total = units.count()
    for r in units.groupBy(F.least("n", F.lit(1_000_000)).alias("n")).count().orderBy(F.desc("n")).limit(1_000_000).collect() if total > listed else []:
        held += r["count"]
        if held > listed:
            break
        least = r["n"]
    if total > listed:
        units = units.where(F.col("n") >= least if least is not None else F.lit(False))
    often = units.select("unit", "n").toArrow()
    unit, n = often["unit"].to_numpy().view(np.uint64), often["n"].to_numpy()
    return Ranks(unit[np.lexsort((unit, -n))], total <= listed)


def counted_pairs(left: np.ndarray, right: np.ndarray, a: Ranks, b: Ranks) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``left, right, n`` of the distinct pairs of units (uint64)."""
    i, j = a.of(left), b.of(right)
    listed = (i >= 0) & (j >= 0)
    if not (a.complete and b.complete) and not listed.all():
        # Beyond the lists: sorted coordinates of names.
        x, y = left[~listed], right[~listed]
        order = np.lexsort((y, x))
        x, y = x[order], y[order]
        first = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])]))
        yield x[first], y[first], np.diff(np.append(first, len(x)))
    i, j = i[listed], j[listed]
    if not len(i):
        return
    across = -(-len(b.units) // TILE)
    tile = (i // TILE) * across + j // TILE
    order = np.argsort(tile, kind="stable")
    tile = tile[order]
    first = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
    size = np.diff(np.append(first, len(tile)))
    full = size >= DENSE
    for at, n in zip(first[full].tolist(), size[full].tolist()):
        own = order[at : at + n]
        count = np.bincount(i[own] % TILE * TILE + j[own] % TILE, minlength=TILE * TILE)
        cell = np.flatnonzero(count)
        row, column = divmod(int(tile[at]), across)
        yield a.units[row * TILE + cell // TILE], b.units[column * TILE + cell % TILE], count[cell]
    rest = order[np.repeat(~full, size)]
    if len(rest):
        key = np.sort(i[rest] * len(b.units) + j[rest])
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        yield a.units[key[first] // len(b.units)], b.units[key[first] % len(b.units)], np.diff(np.append(first, len(key)))


def _phrase_counts(texts: DataFrame, ranks: list, k: int, seed: int) -> DataFrame:
    """``first, last, n`` of the phrases of ``k`` words: names of the first ``k - 1`` words and of the last one.

    ``ranks`` are broadcast ranks of the units of 1, 2, ... k - 1 words.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        left, right, total = [], [], 0

        def counts() -> Iterator[pd.DataFrame]:
            for x, y, n in counted_pairs(np.concatenate(left), np.concatenate(right), ranks[-1].value, ranks[0].value):
                yield pd.DataFrame({"first": x.view(np.int64), "last": y.view(np.int64), "n": n})

        for frame in frames:
            for own in _texts(frame, seed):
                at = own.block.same_piece(k)
                unit = own.unit
                named = unit
                keep = np.ones(len(at), bool)
                for size in range(1, k):
                    if size > 1:
                        named = joined_unit(named[:-1], unit[size - 1 :], seed)
                    level = ranks[size - 1].value
                    if level.complete:  # all parts of this size have to reach the least count
                        good = level.of(named) >= 0
                        for shift in range(k - size + 1):
                            keep &= good[at + shift]
                at = at[keep]
                left.append(named[at])
                right.append(unit[at + k - 1])
                total += len(at)
                if total > GATHERED:
                    yield from counts()
                    left, right, total = [], [], 0
        if total:
            yield from counts()

    return texts.mapInPandas(run, "first long, last long, n long").groupBy("first", "last").agg(F.sum("n").alias("n"))


def _named(phrases: DataFrame, seed: int) -> DataFrame:
    """``unit`` of ``first, last``."""

    @F.pandas_udf("long")
    def name(first: pd.Series, last: pd.Series) -> pd.Series:
        return pd.Series(joined_unit(first.to_numpy().view(np.uint64), last.to_numpy().view(np.uint64), seed).view(np.int64))

    return phrases.withColumn("unit", name("first", "last"))


def _clash(units: DataFrame) -> bool:
    return bool(units.groupBy("unit").count().where("count > 1").head(1))


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, listed: int = LISTED, group: str = "lang", tries: int = 5) -> tuple[list[DataFrame], DataFrame]:
    """Phrases that reach ``least``, by length, and ``grp, total`` of all word occurrences.

    Item ``k`` has the phrases of ``k + 1`` words: ``grp, words`` (array),
    ``parts`` (names of all prefixes and suffixes), ``unit, n``.
    """
    small_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce(F.col(group).cast("string"), F.lit("und")).alias("grp"), "text")
    for seed in range(tries):
        found = _phrases(context, texts, least, longest, listed, seed)
        if found is not None:
            return found
    raise RuntimeError("units keep clashing")


def _phrases(context, texts: DataFrame, least: int, longest: int, listed: int, seed: int) -> tuple[list[DataFrame], DataFrame] | None:
    words = written(_vocabulary(texts, seed))
    totals = words.groupBy("grp").agg(F.sum("n").cast("bigint").alias("total"))
    often = written(words.where(F.col("n") >= least))
    if _clash(often):
        return None
    levels, ranks = [often.select("grp", F.array("word").alias("words"), F.array("unit").alias("names"), "unit", "n")], []
    for k in range(2, longest + 1):
        ranks.append(context.broadcast(_ranked(levels[-1], listed)))
        phrases = written(_named(_phrase_counts(texts, ranks, k, seed).where(F.col("n") >= least), seed))
        if _clash(phrases):
            return None
        before = levels[-1].select(F.col("unit").alias("first"), "grp", F.col("words").alias("head"), F.col("names").alias("head_names"))
        last = often.select(F.col("unit").alias("last"), "word")
        whole = phrases.join(broadcast_if_small(before, 100_000), "first").join(broadcast_if_small(last, 100_000), "last")
        levels.append(written(whole.select("grp", F.concat("head", F.array("word")).alias("words"), F.concat("head_names", F.array("last")).alias("names"), "unit", "n")))
    return levels, totals


def _scores(levels: list[DataFrame], k: int) -> DataFrame:
    """Phrases of ``k`` words with the counts of the parts of their lowest-scoring cut and the score."""
    found = levels[k - 1]
    cuts = []
    for i in range(1, k):
        for side, size, part in (("l", i, F.slice("names", 1, i)), ("r", k - i, F.slice("names", i + 1, k - i))):
            counts = levels[size - 1].select(F.col("names").alias("_part"), F.col("n").alias(f"_{side}{i}"))
            found = found.withColumn("_part", part).join(counts, "_part").drop("_part")
        score = F.expr(f"CAST({SCALE} AS DECIMAL(38,0)) * CAST(n AS DECIMAL(38,0)) * CAST(n AS DECIMAL(38,0)) div (CAST(_l{i} AS DECIMAL(38,0)) * CAST(_r{i} AS DECIMAL(38,0)))")
        cuts.append(F.struct(score.alias("score"), F.lit(i).alias("k"), F.col(f"_l{i}").alias("l"), F.col(f"_r{i}").alias("r")))
    return found.withColumn("_cut", F.array_min(F.array(*cuts))).select("grp", "words", "names", "n", "_cut.*")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, share: int = SHARE, listed: int = LISTED, group: str = "lang") -> DataFrame:
    """``grp, rank, phrase, a, l, r, n, score``: each group's best phrases of 2 to ``longest`` words.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of the cut that scores
    lowest, ``n`` all words of the group. A phrase inside a longer one that
    comes at least ``share`` percent as often is left out.
    """
    levels, totals = phrase_counts(docs, least, longest, listed, group)
    scored = []
    for k in range(2, longest + 1):
        own = _scores(levels, k)
        for longer in range(k + 1, longest + 1):
            places = F.transform(F.sequence(F.lit(1), F.lit(longer - k + 1)), lambda i: F.slice("names", i, k))
            inside = levels[longer - 1].select(F.explode(places).alias("names"), F.col("n").alias("_longer")).groupBy("names").agg(F.max("_longer").alias("_longer"))
            own = own.join(inside, "names", "left").where(F.col("_longer").isNull() | (100 * F.col("_longer") < share * F.col("n"))).drop("_longer")
        scored.append(own)
    phrases = reduce(DataFrame.unionByName, scored).withColumn("phrase", F.array_join("words", " "))
    order = [F.desc("score"), F.desc("n"), F.asc("phrase")]
    # First the best of each of 64 parts of a group, so that no task sorts a whole group.
    salted = phrases.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    few = salted.withColumn("_at", F.row_number().over(W.partitionBy("grp", "_salt").orderBy(*order))).where(F.col("_at") <= top)
    best = few.withColumn("rank", F.row_number().over(W.partitionBy("grp").orderBy(*order))).where(F.col("rank") <= top)
    return best.join(totals, "grp").select("grp", F.col("rank").cast("bigint").alias("rank"), "phrase", F.col("n").alias("a"), "l", "r", F.col("total").alias("n"), "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir)).withColumnRenamed("grp", "lang")


OP11_SQL = rf"""
WITH piece AS (SELECT lang, UNNEST(STRING_SPLIT_REGEX(t, '[.,;:!?\x0A-\x0D]')) AS p FROM (SELECT COALESCE(lang, 'und') AS lang, TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)),
split AS (SELECT lang, REGEXP_EXTRACT_ALL(p, '[^\x20\x09]+') AS w FROM piece),
grams AS (SELECT lang, k, w[i:i + k - 1] AS g FROM (SELECT lang, w, k, UNNEST(RANGE(1, LEN(w) - k + 2)) AS i FROM split, (SELECT UNNEST([1, 2, 3]) AS k) WHERE LEN(w) >= k)),
f AS (SELECT lang, k, g, COUNT(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, CAST(SUM(n) AS BIGINT) AS total FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT * FROM f WHERE k > 1 AND n >= {LEAST}),
cuts AS (SELECT c.lang, c.k, c.g, c.n AS a, c.c, x.n AS l, y.n AS r, CAST({SCALE}::HUGEINT * c.n * c.n // (x.n::HUGEINT * y.n) AS BIGINT) AS score FROM (SELECT *, UNNEST(RANGE(1, k)) AS c FROM cand) c JOIN f x ON x.lang = c.lang AND x.g = c.g[1:c.c] JOIN f y ON y.lang = c.lang AND y.g = c.g[c.c + 1:]),
low AS (SELECT * FROM cuts QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
inside AS (SELECT lang, part, MAX(n) AS n FROM (SELECT lang, n, UNNEST([g[1:2], g[2:3]]) AS part FROM cand WHERE k = 3) GROUP BY ALL),
kept AS (SELECT low.*, ARRAY_TO_STRING(g, ' ') AS phrase FROM low LEFT JOIN inside ON inside.lang = low.lang AND inside.part = low.g WHERE inside.n IS NULL OR 100 * inside.n < {SHARE} * low.a)
SELECT lang, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, total AS n, score FROM kept JOIN totals USING (lang)
QUALIFY rank <= {TOP}
"""
