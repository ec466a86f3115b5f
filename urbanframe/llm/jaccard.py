"""N-gram Jaccard join: rare-first prefix filtering, exact verification.

Texts become sets of hashed word n-grams. Two sets can only reach the threshold
if they share a gram among the first ``n - ceil(t n) + 1`` of each in one global
order. The order puts frequent grams last, so shared boilerplate seldom makes
candidates. Of the first gram that a pair shares, the smaller set must hold it
among the first ninth (at ``t`` = 0.8) of its own, so a gram that no set has so
early joins nothing. Candidates pass a length filter, a positional filter and a
suffix filter (sizes of the parts that fixed pivots cut the sets into bound the
overlap) before their sets are compared, once per pair.

The result is components of linked documents. No group is expanded into all its
pairs: equal texts are one class from the start. Under a gram of many documents
these are first compared, in ``hub_rounds`` rounds, with one of them (the hub),
links are merged into components, and grams whose documents are all in one
component are done. What is then left under a crowded gram, documents of
different components, is joined by gram and size range, so no link is missed.
Grams known to be very frequent are dealt out by gram and document; their
joins' skewed parts are split by AQE.

Frequencies come from all documents: every task counts the grams of blocks of
about two million; those seen twice in a block are summed over all blocks. The
most frequent are broadcast (``FREQUENT`` at most, 12 bytes each); the list only
fixes the order, which may be any for the result to be exact.

Defined results: null, empty and blank texts have no grams and link with
nothing; with fewer words than ``n`` the whole sequence is the one gram; equal
texts always link; every row is returned, repeated rows with equal values; rows
with one id and different texts are different documents; null ids are ordered
last, so they name a component only where all its ids are null; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.llm.common import SPACE, broadcast_if_small, checkpointed, documents, fresh, keyed, small_batches, trimmed, written
from urbanframe.llm.shingles import gram_sets
from urbanframe.operators.graph import components

WORDS = 5
PERCENT = 80
FREQUENT = 500_000
BLOCK_GRAMS = 2_000_000
PARTS = 128
#: Documents under a gram beyond which a hub is compared first.
MANY = 64
#: Rounds of hubs.
HUB_ROUNDS = 4
#: Counted documents of a gram from which its postings are dealt out by document as well.
HOT = 512
#: Bits of the table that most rare grams are ruled out by.
SIFT = 22


def needed(n, percent: int = PERCENT):
    """Smallest overlap with which a set of size ``n`` can reach the threshold at all."""
    return -(-percent * n // 100)


def _part_sizes(grams: np.ndarray) -> np.ndarray | None:
    """Sizes of the parts that fixed pivots cut a set into; None where one passes 16 bits."""
    sizes = np.bincount((grams.view(np.uint64) >> np.uint64(57)).astype(np.int64), minlength=PARTS)
    return sizes.astype(np.int16) if sizes.max(initial=0) < 2**15 else None


def classes_of_equal_texts(docs: DataFrame) -> DataFrame:
    """``_key, rep``: the smallest key with the same text; null, empty and blank texts are left out."""
    hashes = (F.xxhash64("text").alias("h1"), F.crc32(F.col("text").cast("binary")).alias("h2"), F.length("text").alias("h3"))
    full = checkpointed(docs.where(F.col("text").rlike(f"[^{SPACE}]")).select("_key", *hashes).distinct())
    rep = full.groupBy("h1", "h2", "h3").agg(F.min("_key").alias("rep"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # Only classes of several texts need the join; the hot ones arrive combined.
    found = full.join(broadcast_if_small(checkpointed(rep)), ["h1", "h2", "h3"], "left")
    return checkpointed(found.select("_key", F.coalesce("rep", "_key").alias("rep")))


def _gram_counts(texts: DataFrame, words: int) -> DataFrame:
    """``_key, n`` of every text, and ``gram, n`` of grams that a block of texts repeats."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        total = 0

        def repeated() -> pd.DataFrame:
            grams = np.sort(np.concatenate(held))
            held.clear()
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            n = np.diff(np.append(first, len(grams)))
            return pd.DataFrame({"_key": None, "gram": grams[first][n > 1], "n": n[n > 1]}).astype({"_key": "Int64"})

        for frame in frames:
            sizes = []
            for grams in gram_sets(frame["text"].tolist(), words):
                held.append(grams)
                sizes.append(len(grams))
                total += len(grams)
                if total > BLOCK_GRAMS:
                    yield repeated()
                    total = 0
            yield pd.DataFrame({"_key": frame["_key"], "gram": None, "n": sizes}).astype({"gram": "Int64"})
        if total:
            yield repeated()

    return texts.select("_key", "text").mapInPandas(trimmed(run), "_key long, gram long, n long")


def _most_frequent(counted: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted grams and their counts: as many of the most frequent as ``most`` allows.

    The least count to keep comes from a histogram of counts, so nothing is sorted.
    """
    totals = written(counted.where("gram IS NOT NULL").groupBy("gram").agg(F.least(F.sum("n"), F.lit(2**30)).cast("int").alias("n")))
    held, least = 0, None
    for r in totals.groupBy(F.least("n", F.lit(10_000)).alias("n")).count().orderBy(F.desc("n")).collect():
        held += r["count"]
        if held > most:
            break
        least = r["n"]
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    often = totals.where(F.col("n") >= least).toArrow()
    grams, counts = (often[c].to_numpy() for c in ("gram", "n"))
    order = np.argsort(grams)
    return grams[order], counts[order]


def _sift(grams: np.ndarray) -> np.ndarray:
    """Table of the leading bits that any of ``grams`` has."""
    table = np.zeros(1 << SIFT, bool)
    table[grams.view(np.uint64) >> np.uint64(64 - SIFT)] = True
    return table


def _prefixes(texts: DataFrame, frequent, words: int, percent: int) -> DataFrame:
    """``gram, _key, n, place, hot``: the rare-first prefix of every text's set."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, count = frequent.value
        sift = _sift(known)
        for frame in frames:
            out = []
            for key, grams in zip(frame["_key"].tolist(), gram_sets(frame["text"].tolist(), words)):
                n = len(grams)
                if not n:
                    continue
                k = n - needed(n, percent) + 1
                maybe = np.flatnonzero(sift[grams.view(np.uint64) >> np.uint64(64 - SIFT)])
                hot = np.zeros(k, bool)
                if len(maybe):
                    at = np.minimum(np.searchsorted(known, grams[maybe]), len(known) - 1)
                    found = known[at] == grams[maybe]
                    maybe, often = maybe[found], count[at[found]]
                    rare = np.delete(grams, maybe)
                    if len(rare) < k:
                        last = np.lexsort((grams[maybe], often))[: k - len(rare)]
                        hot[len(rare) :] = often[last] >= HOT
                        rare = np.concatenate([rare, grams[maybe[last]]])
                    grams = rare
                out.append((grams[:k], np.full(k, key), np.full(k, n, np.int32), np.arange(k, dtype=np.int32), hot))
            if out:
                yield pd.DataFrame(dict(zip(("gram", "_key", "n", "place", "hot"), (np.concatenate(x) for x in zip(*out)))))

    return texts.select("_key", "text").mapInPandas(trimmed(run), "gram long, _key long, n int, place int, hot boolean")


def _parts(texts: DataFrame, words: int) -> DataFrame:
    """``_key, parts``: the sizes of the parts of each set."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"_key": frame["_key"], "parts": [_part_sizes(g) for g in gram_sets(frame["text"].tolist(), words)]})

    return texts.select("_key", "text").mapInPandas(trimmed(run), "_key long, parts array<short>")


def _early(percent: int) -> Column:
    """Whether a posting stands early enough for its set to be the smaller one of a pair."""
    return (F.col("n") - F.col("place")) * (100 + percent) >= 2 * percent * F.col("n")


def _shared_postings(posts: DataFrame, percent: int) -> DataFrame:
    """Postings of grams that several texts hold, one of them early; plus ``m``, the documents under the gram.

    A hot gram's postings are dealt out by document too, and always kept.
    """
    deal = F.when(F.col("hot"), F.pmod(F.xxhash64("_key"), F.lit(4096))).otherwise(0)
    under = W.partitionBy("gram", "deal")
    early = F.max(_early(percent)).over(under)
    kept = posts.withColumn("deal", deal).withColumns({"m": F.count(F.lit(1)).over(under), "early": early})
    return kept.where("hot OR (m > 1 AND early)").select("gram", "_key", "n", "place", F.when(F.col("hot"), 2**30).otherwise(F.col("m")).cast("int").alias("m"))


def _sides(small: DataFrame, large: DataFrame, by: list[str], percent: int, *more: str) -> DataFrame:
    """Pairs of postings under a gram that pass the length and the positional filter.

    Side ``a`` is the smaller set (of equal ones, the one with the smaller key).
    At most the gram and what stands behind it is shared.
    """
    a, b = (df.select(*by, *[F.col(c).alias(f"{c}_{side}") for c in ("_key", "n", "place", *more)]) for df, side in ((small.where(_early(percent)), "a"), (large, "b")))
    rest = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    return a.join(b, by).where(
        ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("_key_a") < F.col("_key_b"))))
        & (100 * F.col("n_a") >= percent * F.col("n_b"))
        & (rest * (100 + percent) >= percent * (F.col("n_a") + F.col("n_b")))
    )


def _parts_fit(a: str, b: str, n_a, n_b, percent: int) -> Column:
    """Suffix filter: the summed smaller sizes of two sets' parts bound their overlap."""
    bound = F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    return F.coalesce(bound * (100 + percent) >= percent * (n_a + n_b), F.lit(True))


def _with_parts(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs with ``parts_a, parts_b``."""
    for side in "ba":
        pairs = pairs.join(parts.select(F.col("_key").alias(side), F.col("parts").alias(f"parts_{side}")), side)
    return pairs


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose sets reach the threshold.

    Texts travel to the pairs and become sets there: they take less room than
    sets of hashes.
    """
    ends = checkpointed(pairs.select(F.col("a").alias("_key")).unionByName(pairs.select(F.col("b").alias("_key"))).distinct())
    own = texts.select("_key", "text").join(broadcast_if_small(ends, 2_000_000), "_key", "left_semi")
    for side in "ba":
        pairs = pairs.join(own.select(F.col("_key").alias(side), F.col("text").alias(f"text_{side}")), side)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            held = dict(zip(frame["a"].tolist(), frame["text_a"])) | dict(zip(frame["b"].tolist(), frame["text_b"]))
            sets = dict(zip(held, gram_sets(list(held.values()), words)))
            linked = []
            for x, y in zip(frame["a"].tolist(), frame["b"].tolist()):
                both = np.sort(np.concatenate([sets[x], sets[y]]))
                shared = int((both[1:] == both[:-1]).sum())
                linked.append(shared * (100 + percent) >= percent * len(both))
            yield frame.loc[linked, ["a", "b"]]

    return pairs.select("a", "b", "text_a", "text_b").mapInPandas(trimmed(run), "a long, b long")


def _crowd(postings: DataFrame, found: DataFrame | None) -> DataFrame:
    """Postings of crowded grams with their component, of grams with several components."""
    if found is None:
        return postings.withColumn("comp", F.col("_key"))
    named = postings.join(found.select(F.col("node").alias("_key"), "component"), "_key", "left").withColumn("comp", F.coalesce("component", "_key")).drop("component")
    named = checkpointed(named)
    open_ = named.groupBy("gram").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("gram")
    return checkpointed(named.join(open_, "gram", "left_semi"))


def _hub_pairs(crowd: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each gram's hub, picked by a hash, with its other documents."""
    columns = ("_key", "n", "place", "comp")
    lead = F.min(F.struct(F.xxhash64("_key", F.lit(turn)).alias("h"), *columns)).alias("hub")
    hubs = broadcast_if_small(checkpointed(crowd.groupBy("gram").agg(lead).select("gram", *[F.col(f"hub.{c}").alias(c) for c in columns])))
    smaller, larger = _sides(hubs, crowd, ["gram"], percent, "comp"), _sides(crowd, hubs, ["gram"], percent, "comp")
    return smaller.unionByName(larger).where("comp_a <> comp_b").select(F.col("_key_a").alias("a"), F.col("_key_b").alias("b"))


def _crowd_pairs(crowd: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """All candidates of different components under crowded grams, joined by gram and size range.

    The suffix filter is part of the join, so that only likely pairs leave it.
    """
    step = F.floor(F.log("n") / float(np.log(100 / percent)) + 1e-9).cast("int")
    crowd = crowd.join(parts, "_key")
    small = crowd.withColumn("range", step)
    large = crowd.withColumn("range", F.explode(F.array(step, step - 1)))
    pairs = _sides(small, large, ["gram", "range"], percent, "comp", "parts").where("comp_a <> comp_b")
    return pairs.where(_parts_fit("parts_a", "parts_b", F.col("n_a"), F.col("n_b"), percent)).select(F.col("_key_a").alias("a"), F.col("_key_b").alias("b"))


def _blank() -> Column:
    return ~F.coalesce(F.col("text").rlike(f"[^{SPACE}]"), F.lit(False))


def key_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, frequent: int = FREQUENT, hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    """``_key, n_shingles, component`` of every text of ``_key, text`` that is not blank."""
    spark = docs.sparkSession
    small_batches(spark)
    member = classes_of_equal_texts(docs)
    spare = checkpointed(member.where("_key <> rep").select("_key"))
    texts = docs.where(~_blank()).join(broadcast_if_small(spare, 2_000_000), "_key", "left_anti")

    counted = written(_gram_counts(texts, words))
    sizes = counted.where("gram IS NULL").select(F.col("_key").alias("rep"), F.col("n").alias("n_shingles"))
    order = spark.sparkContext.broadcast(_most_frequent(counted, frequent))
    shared = written(_shared_postings(_prefixes(texts, order, words, percent), percent))

    few, many = shared.where(F.col("m") <= MANY), shared.where(F.col("m") > MANY)
    keys = ("_key_a AS a", "_key_b AS b", "n_a", "n_b")
    pairs = checkpointed(_sides(few, few, ["gram"], percent).selectExpr(*keys).distinct())
    wanted = pairs.select(F.col("a").alias("_key")).unionByName(pairs.select(F.col("b").alias("_key"))).unionByName(many.select("_key")).distinct()
    parts = written(_parts(texts.join(broadcast_if_small(checkpointed(wanted), 2_000_000), "_key", "left_semi"), words))

    links, found, tried = None, None, None
    for turn in range(hub_rounds + 1):
        crowd = _crowd(many, found)
        if turn and not crowd.head(1):
            break
        if turn == hub_rounds:
            near = _crowd_pairs(crowd, parts, percent)
        else:
            near = _hub_pairs(crowd, turn, percent)
        if turn == 0:
            likely = _parts_fit("parts_a", "parts_b", F.col("n_a"), F.col("n_b"), percent)
            near = near.unionByName(_with_parts(pairs, parts).where(likely).select("a", "b"))
        near = near.distinct()
        near = checkpointed(near if tried is None else near.join(tried, ["a", "b"], "left_anti"))
        tried = near if tried is None else tried.unionByName(near)
        new = checkpointed(verified(near, texts, words, percent))
        links = new if links is None else links.unionByName(new)
        found = components(links)

    out = member.join(sizes, "rep").join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    return out.select("_key", "n_shingles", F.coalesce("component", "rep").alias("component"))


def link_components(docs: DataFrame, **how) -> DataFrame:
    """``doc_id, n_shingles, component_id``: the smallest id that links reach from each document."""
    docs, names = keyed(docs.select("doc_id", "text"))
    found = key_components(_one_of_each(docs.select("_key", "text"), names), **how)
    out = docs.select("doc_id", "_key").join(found, "_key", "left").withColumn("component", F.coalesce("component", "_key"))
    if names is None:
        out = out.withColumn("component_id", F.col("component"))
    else:
        names = names.select(F.col("_key").alias("component"), F.col("doc_id").alias("component_id"))
        out = out.join(broadcast_if_small(names), "component")
    return out.select("doc_id", F.coalesce("n_shingles", F.lit(0)).cast("bigint").alias("n_shingles"), "component_id")


def _one_of_each(docs: DataFrame, names: DataFrame | None) -> DataFrame:
    """One row of each key, where keys may repeat at all."""
    return docs if names is None else docs.dropDuplicates(["_key"])


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(documents(spark, sf_dir))


def stage_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, the first by id; of repeated rows one stays.

    Blank texts link with nothing, so all of their rows stay.
    """
    key = fresh("_key", docs)
    own, names = keyed(docs, key)
    found = key_components(_one_of_each(own.select(F.col(key).alias("_key"), "text"), names))
    gone = checkpointed(found.where("_key <> component").select(F.col("_key").alias(key)))
    kept = own.join(broadcast_if_small(gone, 2_000_000), key, "left_anti")
    if names is not None:
        kept = kept.where(_blank()).unionByName(kept.where(~_blank()).dropDuplicates([key]))
    return kept.select(*docs.columns)


OP4_SQL = r"""
WITH RECURSIVE split AS (SELECT doc_id, REGEXP_EXTRACT_ALL(TRANSLATE(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, ARRAY_TO_STRING(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, UNNEST(RANGE(1, GREATEST(LEN(w) - 4, 1) + 1)) AS i FROM split WHERE LEN(w) > 0)),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM grams GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, COUNT(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT x AS doc_id, x AS other FROM ways UNION SELECT r.doc_id, w.y FROM reached r JOIN ways w ON w.x = r.other),
roots AS (SELECT doc_id, MIN(other) AS root FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(COALESCE(n, 0) AS BIGINT) AS n_shingles, COALESCE(root, doc_id) AS component_id FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN roots USING (doc_id)
"""
