"""Policy audit operators: clean-up, ticks, scores, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.operators.indicators import ffill

# What counts as nothing, and the marks.
EMPTY = ("No", "", "nan", "NaN")
TICK, CROSS, MIXED, BOTH, DASH = "✔", "✘", "✔/✘", "✔+✘", "-"
UNSCORED = "Transport and planning combined in one government department"


def given(x: Column, *more: str) -> Column:
    """True where a text says something."""
    return x.isNotNull() & ~F.coalesce(x, F.lit("")).isin(*EMPTY, *more)


def policy_flags(df: DataFrame, by: str = "measures") -> DataFrame:
    """``identified, aligns, measurable, evidence`` marks per measure, in one aggregate."""
    named = given(F.col("policy"))
    against = F.col("qualifier") == "No"
    against = F.coalesce(against, F.lit(False))
    weak = F.coalesce(F.col("evidence_threshold") == "No", F.lit(False))
    any_ = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    told = df.groupBy(by).agg(
        any_(named).alias("_named"),
        any_(named & ~against).alias("_aligns"),
        any_(named & (against | weak)).alias("_not"),
        any_(named & given(F.col("measurable_target"), "Unclear")).alias("_measurable"),
        any_(named & given(F.col("evidence_threshold"))).alias("_evidence"),
        any_(named & ~given(F.col("evidence_threshold"))).alias("_no_evidence"),
    )
    c = F.col
    return told.select(
        by,
        F.when(c("_named"), TICK).otherwise(CROSS).alias("identified"),
        F.when(c("_aligns") & c("_not"), MIXED).when(c("_aligns"), TICK).when(c("_named"), CROSS).otherwise(DASH).alias("aligns"),
        F.when(c("_measurable"), TICK).when(c("_named"), CROSS).otherwise(DASH).alias("measurable"),
        F.when(c("_evidence") & c("_no_evidence"), BOTH).when(c("_evidence"), TICK).when(c("_named"), CROSS).otherwise(DASH).alias("evidence"),
    )


def topic_checklist(df: DataFrame, topics: DataFrame) -> DataFrame:
    """Marks of the listed measures by topic; a topic without any policy shows dashes.

    ``topics`` has ``topic, measures``. Measures without rows count as without policy.
    """
    marks = policy_flags(df.where("policy IS NOT NULL"))
    listed = topics.join(marks, "measures", "left").withColumns({"identified": F.coalesce("identified", F.lit(CROSS)), **{m: F.coalesce(m, F.lit(DASH)) for m in ("aligns", "measurable", "evidence")}})
    none = F.min((F.col("identified") == CROSS).cast("int")).over(W.partitionBy("topic")) == 1
    return listed.withColumn("identified", F.when(none, DASH).otherwise(F.col("identified"))).select("topic", "measures", "identified", "aligns", "measurable")


def policy_scores(df: DataFrame, unscored: str = UNSCORED) -> DataFrame:
    """Presence (measures with a policy) and quality (alignment times measurability) in one row."""
    marks = policy_flags(df)
    align = F.when(F.col("aligns") == TICK, 1.0).when(F.col("aligns") == MIXED, -0.5).when(F.col("aligns") == CROSS, -1.0)
    measure = F.when(F.col("measurable") == TICK, 2.0).when(F.col("measurable") == CROSS, 1.0).otherwise(0.0)
    scored = F.coalesce(F.col("measures") != unscored, F.lit(True))
    return marks.agg(
        F.count_if(F.col("identified") == TICK).alias("presence"),
        F.count(F.lit(1)).alias("presence_of"),
        F.coalesce(F.sum(F.when(scored, align * measure)), F.lit(0.0)).alias("quality"),
        (F.count_if(scored) * 2).alias("quality_of"),
    )


def validate_policies(df: DataFrame, strict: bool = False) -> DataFrame:
    """Rows that break a rule: ``row_id, rule, message``. Nothing is raised.

    Details without a policy name; an evidence threshold without a measurable
    target; with ``strict`` also a measurable target without a threshold.
    """
    unnamed = ~given(F.col("policy")) & (given(F.col("measurable_target")) | given(F.col("evidence_threshold")))
    loose = (F.col("evidence_threshold") == "Yes") & ~F.coalesce(F.col("measurable_target") == "Yes", F.lit(False))
    rules = [(unnamed, "unnamed", "details are entered without a policy name"), (loose, "unmeasurable", "an evidence-informed threshold needs a measurable target")]
    if strict:
        rules.append(((F.col("measurable_target") == "Yes") & F.col("evidence_threshold").isNull(), "no_threshold", "a measurable target needs a threshold assessment"))
    found = F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(r).alias("rule"), F.lit(m).alias("message"))) for c, r, m in rules])
    return df.select("row_id", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("e")).select("row_id", "e.*")


def summarise_policy(df: DataFrame, by: str, mark: str) -> DataFrame:
    """One mark for several measures: all ticks, all dashes, else a cross."""
    every = lambda m: F.every(F.col(mark) == m)
    return df.groupBy(by).agg(F.when(every(TICK), TICK).when(every(DASH), DASH).otherwise(CROSS).alias(mark))


def clean_checklist(df: DataFrame) -> DataFrame:
    """Checklist rows (``row_id, indicators, measures, policy, ...``) made whole.

    Texts are trimmed; a row with an indicator only is a section header: its
    name fills down and the row goes. A row whose policy starts with Yes or No
    states how the rows under it relate to principles: the text before its comma
    fills down as ``qualifier`` within the measure, and the row goes.
    """
    trimmed = df.withColumns({c: F.when(F.trim(c) != "", F.trim(c)) for c, t in df.dtypes if t == "string"})
    states = F.coalesce(F.col("policy").rlike("^(Yes|No),"), F.lit(False))
    marked = trimmed.withColumn("_header", F.col("measures").isNull() & F.col("policy").isNull() & F.col("indicators").isNotNull()).withColumn("_states", states)
    marked = marked.withColumn("qualifier", F.when(F.col("_states"), F.substring_index("policy", ",", 1)))
    filled = ffill(marked, ["indicators", "measures"], "row_id")
    filled = ffill(filled, ["qualifier"], "row_id", ["indicators", "measures"])
    return filled.where("NOT _header AND NOT _states").drop("_header", "_states")


def clean_legacy(df: DataFrame, names: dict[str, str], groups: dict[str, str]) -> DataFrame:
    """Older checklists: known measures only, renamed, with their group, filled down and deduplicated."""
    known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    group = F.create_map(*[F.lit(x) for kv in groups.items() for x in kv]) if groups else F.create_map().cast("map<string,string>")
    filled = ffill(df, ["indicators", "measures"], "row_id")
    renamed = filled.withColumn("measures", F.try_element_at(known, F.col("measures"))).where("measures IS NOT NULL")
    renamed = renamed.withColumn("indicators", F.coalesce(F.try_element_at(group, F.col("measures")), F.col("indicators")))
    keys = ["indicators", "measures", "policy", "qualifier", "measurable_target", "evidence_threshold"]
    return renamed.groupBy(*keys).agg(F.min("row_id").alias("row_id"))


def parse_levels(text: Column, other: Column | None = None) -> Column:
    """Names of the ``name: value`` lines that are affirmed, and ``Other`` entries."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x) != "")
    pairs = F.transform(lines, lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("name"), F.trim(F.substring_index(x, ":", -1)).alias("value")))
    named = F.transform(F.filter(pairs, lambda p: ~F.lower(p["value"]).isin("no", "missing", "")), lambda p: p["name"])
    if other is None:
        return named
    free = F.filter(F.transform(F.split(F.coalesce(other, F.lit("")), "[,;]"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_union(named, free)
