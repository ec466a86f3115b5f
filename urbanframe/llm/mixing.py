"""Mixing sources to target weights by Pareto order sampling.

Each source gets a word budget from its weight. Within a source a document is
wanted in proportion to its importance (without a column for it, the square root
of its size, in steps of powers of two), up to ``max_repeats`` times; the rate
that meets the budget is found in closed form over importance classes. The whole
part of the wanted number is allocated as certain copies, the rest is its
inclusion probability ``p`` in a Pareto order sample (Rosen 1997): documents are
ranked by ``(u / (1 - u)) / (p / (1 - p))``, the odds of a uniform draw over the
inclusion odds, and the smallest ranks are taken until the words taken are as
near to the budget as whole documents allow.

All of it is DataFrame code. The cut in the ranking is found without sorting a
source in one task: the logarithm of the rank has a density of a quarter at most,
so a histogram over steps of 1/32 finds the step that holds the cut, a second
one splits that step in 1024, and only the rows of the one remaining bucket
(less than 1/100,000 of the source) are ordered by a window. Documents with only
certain copies have no rank. Windows without a key run over sources or their
classes only, never over documents.

Defined results: null or blank texts have size 0 and are taken 0 times; a null
source is a source of its own, last in order; draws come from id and text, so
null or repeated ids with different texts are drawn apart, while repeated rows
are separate documents that share a draw; an importance that is null or not
positive counts as 1; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.llm.common import broadcast_if_small, checkpointed, documents, fresh, id_text, unit_draw, word_count

#: Steps of the first histogram to a unit of the rank's logarithm, and buckets of a step.
STEPS, BUCKETS = 32, 1024


def allocate(sources: DataFrame, budget_factor: float, max_repeats: float, weights: tuple[float, ...]) -> DataFrame:
    """Word targets per source: ``source, source_size`` -> plus ``weight, target``.

    Sources in code-point order (null last) take ``weights`` in turn. The
    budget, ``budget_factor`` times all words, is shared by weight; a target
    stops at ``max_repeats`` times its source's size and what it cannot use is
    shared again by weight among the others (water-filling, in closed form:
    sources sorted by cap per weight, the first one that its share does not
    fill fixes the level for it and all later ones).
    """
    everything = W.partitionBy()
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    turn = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last()))
    by_fill = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by_fill.rowsBetween(W.currentRow, W.unboundedFollowing))
    budget = F.lit(float(budget_factor)) * F.sum("source_size").over(everything)
    return (
        sources.withColumn("weight", F.element_at(cycle, (turn - 1) % len(weights) + 1))
        .withColumn("cap", F.lit(float(max_repeats)) * F.col("source_size"))
        .withColumn("level", (budget - before) / after)
        .withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
        .withColumn("water", F.max(F.when(~F.col("full"), F.col("level"))).over(everything))
        .withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.least("cap", F.col("water") * F.col("weight"))))
        .select("source", "source_size", "weight", "target")
    )


def wanted_copies(classes: DataFrame, max_repeats: int) -> DataFrame:
    """Certain copies and inclusion probability of every importance class of a source.

    ``classes`` has ``source, target, step, held`` (words of the class). A class
    is wanted ``rate * 2 ** (step / 4)`` times; heavier ones than ``max_repeats``
    allows stop there and the others' rate rises (the same closed form as in
    ``allocate``). Adds ``sid`` (a number for the source), ``whole``, ``p``.
    """
    heaviest = W.partitionBy("source").orderBy(F.desc("step"))
    before = F.coalesce(F.sum("held").over(heaviest.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).cast("double")
    after = F.sum(F.col("weight") * F.col("held")).over(heaviest.rowsBetween(W.currentRow, W.unboundedFollowing))
    most = F.lit(float(max_repeats))
    levelled = (
        classes.withColumn("weight", F.pow(F.lit(2.0), F.col("step") / 4))
        .withColumn("level", F.try_divide(F.col("target") - most * before, after))
        .withColumn("full", F.coalesce(F.col("level") * F.col("weight") >= most - 1e-12, F.lit(True)))
        .withColumn("rate", F.max(F.when(~F.col("full"), F.col("level"))).over(W.partitionBy("source")))
        .withColumn("copies", F.when(F.col("full"), most).otherwise(F.greatest(F.lit(0.0), F.col("rate") * F.col("weight"))))
        .withColumn("whole", F.floor(F.col("copies") + 1e-9))
        .withColumn("p", F.when(F.col("copies") - F.col("whole") > 1e-9, F.col("copies") - F.col("whole")).otherwise(F.lit(0.0)))
    )
    return levelled.withColumn("sid", F.dense_rank().over(W.partitionBy().orderBy(F.col("source").asc_nulls_last()))).select("source", "sid", "step", "held", "target", "whole", "p")


def _cut(rows: DataFrame, bucket: str, base: Column, cut: str, start: str) -> DataFrame:
    """For each source the bucket in which the running size reaches ``rest``, and the size before it."""
    sums = rows.groupBy("sid", bucket).agg(F.sum("size").alias("_held"), F.first("rest").alias("rest"), F.first(base).alias("_base"))
    running = F.sum("_held").over(W.partitionBy("sid").orderBy(bucket)) + F.col("_base")
    return (
        sums.withColumn("_end", running)
        .withColumn("_start", F.col("_end") - F.col("_held"))
        .where(F.col("_start") <= F.col("rest"))
        .groupBy("sid")
        .agg(F.max(bucket).alias(cut), F.max("_start").alias(start))
    )


def mix(docs: DataFrame, **how) -> DataFrame:
    """How often the mix takes each document, a row for every row of ``docs``.

    ``docs`` needs ``doc_id, text, source``; see ``marked_mix`` for the
    parameters. Returns ``doc_id, source, size, source_size, target, copies,
    taken`` with ``taken = copies * size``.
    """
    return marked_mix(docs, **how).drop("mark")


def marked_mix(
    docs: DataFrame,
    budget_factor: float = 1.5,
    max_repeats: int = 2,
    weights: tuple[float, ...] = (3.0, 1.0, 2.0),
    seed: str = "mix",
    importance: str | None = None,
) -> DataFrame:
    """``mix`` plus ``mark``, a hash of the text. ``importance`` names a positive column that
    documents of a source are wanted in proportion to (in steps of a quarter of a power of two)."""
    if importance:
        given = F.col(importance).cast("double")
        step = F.round(4 * F.log2(F.when(given > 0, given).otherwise(1.0))).cast("int")
    else:
        step = 2 * F.length(F.bin("size"))
    items = docs.select("doc_id", "source", "text", *([importance] if importance else []))
    items = items.withColumn("size", word_count(F.col("text")))
    items = checkpointed(items.select("doc_id", "source", "size", unit_draw(seed, id_text(), F.md5(F.col("text").cast("binary"))).alias("u"), step.alias("step"), F.xxhash64("text").alias("mark")))
    classes = checkpointed(items.groupBy("source", "step").agg(F.sum("size").alias("held")))
    sums = classes.groupBy("source").agg(F.sum("held").alias("source_size"))
    targets = checkpointed(allocate(sums, budget_factor, max_repeats, weights).select(F.col("source").alias("_s"), "source_size", "target"))
    same = F.col("source").eqNullSafe(F.col("_s"))
    plan = wanted_copies(classes.join(F.broadcast(targets) if targets.count() <= 100_000 else targets, same).select("source", "target", "step", "held"), max_repeats)
    rest = F.greatest(F.lit(0.0), F.col("target") - F.sum(F.col("whole") * F.col("held")).over(W.partitionBy("sid")))
    plan = checkpointed(plan.withColumn("rest", rest).select(F.col("source").alias("_p"), "sid", F.col("step").alias("_step"), "whole", "p", "rest"))

    found = items.join(broadcast_if_small(targets), same).join(broadcast_if_small(plan), F.col("source").eqNullSafe(F.col("_p")) & (F.col("step") == F.col("_step")))
    ranked = (
        found.withColumn("rank", F.when((F.col("p") > 0) & (F.col("size") > 0), (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))))
        .withColumn("b1", F.floor(F.log("rank") * STEPS).cast("int"))
        .withColumn("b2", (F.floor(F.log("rank") * (STEPS * BUCKETS)) - F.floor(F.log("rank") * STEPS) * BUCKETS).cast("int"))
        .select("doc_id", "source", "mark", "sid", "size", "source_size", "target", "whole", "rest", "rank", "b1", "b2")
    )
    first = checkpointed(_cut(ranked.where("rank IS NOT NULL"), "b1", F.lit(0), "c1", "start1"))
    ranked = ranked.join(broadcast_if_small(first), "sid", "left")
    second = checkpointed(_cut(ranked.where("rank IS NOT NULL AND b1 = c1"), "b2", F.col("start1"), "c2", "start2"))
    ranked = ranked.join(broadcast_if_small(second), "sid", "left")
    edge = F.coalesce((F.col("b1") == F.col("c1")) & (F.col("b2") == F.col("c2")), F.lit(False))
    clear = F.coalesce((F.col("b1") < F.col("c1")) | ((F.col("b1") == F.col("c1")) & (F.col("b2") < F.col("c2"))), F.lit(False))
    inside = W.partitionBy("sid").orderBy("rank", "doc_id", "mark").rowsBetween(W.unboundedPreceding, -1)
    at_edge = ranked.where(edge).withColumn("_mid", F.col("start2") + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("size") / 2)
    picked = at_edge.withColumn("extra", (F.col("_mid") <= F.col("rest")).cast("int")).drop("_mid")
    others = ranked.where(~edge).withColumn("extra", clear.cast("int"))
    return (
        picked.unionByName(others)
        .withColumn("copies", F.when(F.col("size") > 0, F.least(F.col("whole") + F.col("extra"), F.lit(int(max_repeats)))).otherwise(0).cast("int"))
        .select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "mark")
    )


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents as the mix says; columns stay those of ``docs``."""
    id_, source, mark, copies, copy, own = (fresh(c, docs) for c in ("_id", "_source", "_mark", "_copies", "_copy", "_own"))
    counts = marked_mix(docs.select("doc_id", "text", "source"))
    counts = counts.select(F.col("doc_id").alias(id_), F.col("source").alias(source), F.col("mark").alias(mark), F.col("copies").alias(copies))
    # Rows that share id, source and text share their draw, so one row of counts serves them.
    counts = checkpointed(counts.groupBy(id_, source, mark).agg(F.max(copies).alias(copies)).where(F.col(copies) > 0))
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & F.col("source").eqNullSafe(F.col(source)) & (F.col(own) == F.col(mark))
    repeated = docs.withColumn(own, F.xxhash64("text")).join(broadcast_if_small(counts), same)
    return repeated.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


OP1_SQL = r"""
WITH items AS (
  SELECT doc_id, source,
    CAST(COALESCE(LENGTH(REGEXP_REPLACE(REGEXP_REPLACE(text, '^[\x20\x09-\x0D]+', ''), '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*', 'w', 'g')), 0) AS BIGINT) AS size,
    (CAST('0x' || SUBSTR(MD5('mix:' || COALESCE(CAST(doc_id AS VARCHAR), '') || COALESCE(':' || MD5(text), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
sums AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM items GROUP BY source),
weighted AS (SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
    2.0::DOUBLE * source_size AS cap FROM sums),
levels AS (SELECT *, (1.5::DOUBLE * SUM(source_size) OVER ()
      - COALESCE(SUM(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / SUM(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weighted),
targets AS (SELECT source, source_size, CASE WHEN level * weight >= cap THEN cap
    ELSE LEAST(cap, weight * MAX(CASE WHEN level * weight < cap THEN level END) OVER ()) END AS target FROM levels),
classes AS (SELECT source, LENGTH(BIN(size)) AS step, POWER(2.0::DOUBLE, LENGTH(BIN(size)) / 2.0::DOUBLE) AS w, CAST(SUM(size) AS BIGINT) AS held FROM items GROUP BY ALL),
rates AS (SELECT c.*, t.source_size, t.target, (t.target - 2.0::DOUBLE * COALESCE(SUM(held) OVER heavier, 0)) / NULLIF(SUM(w * held) OVER lighter, 0) AS level
  FROM classes c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
  WINDOW heavier AS (PARTITION BY c.source ORDER BY step DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    lighter AS (PARTITION BY c.source ORDER BY step DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
capped AS (SELECT *, COALESCE(level * w >= 2 - 1e-12, TRUE) AS is_full FROM rates),
wanted AS (SELECT *, CASE WHEN is_full THEN 2 ELSE GREATEST(0, w * MAX(CASE WHEN NOT is_full THEN level END) OVER (PARTITION BY source)) END AS copies FROM capped),
plan AS (SELECT *, FLOOR(copies + 1e-9) AS whole, CASE WHEN copies - FLOOR(copies + 1e-9) > 1e-9 THEN copies - FLOOR(copies + 1e-9) ELSE 0 END AS p FROM wanted),
rests AS (SELECT *, GREATEST(0, target - SUM(whole * held) OVER (PARTITION BY source)) AS rest FROM plan),
ranked AS (SELECT i.doc_id, i.source, i.size, r.source_size, r.target, r.whole, r.rest,
    CASE WHEN r.p > 0 AND i.size > 0 THEN (i.u / (1 - i.u)) / (r.p / (1 - r.p)) END AS rank
  FROM items i JOIN rests r ON i.source IS NOT DISTINCT FROM r.source AND LENGTH(BIN(i.size)) = r.step),
cut AS (SELECT *, COALESCE(SUM(CASE WHEN rank IS NOT NULL THEN size ELSE 0 END) OVER (PARTITION BY source ORDER BY rank NULLS LAST, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2.0::DOUBLE AS mid FROM ranked),
counted AS (SELECT *, CASE WHEN size > 0 THEN LEAST(2, whole + CASE WHEN rank IS NOT NULL AND mid <= rest THEN 1 ELSE 0 END) ELSE 0 END AS times FROM cut)
SELECT doc_id, size, source_size, target, CAST(times * size AS BIGINT) AS taken, CAST(times AS INT) AS copies FROM counted
"""
