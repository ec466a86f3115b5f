"""Exact quantiles without gathering a column's values in one task."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1024
#: Rows of a range up to which its distinct values are fetched.
FEW = 50_000


def quantiles(df: DataFrame, column: str, shares: list[float], few: int = FEW) -> list[float | None]:
    """Quantiles of a column, between neighbouring values in proportion; null without values.

    A histogram of equal ranges finds the ranges that hold the wanted ranks;
    these are cut again until few rows are left in one. Only counts of ranges
    and the last few values pass through the driver. The column is kept between
    the passes, so what it comes from runs once.
    """
    values = df.select(F.col(column).cast("double").alias("v")).where("v IS NOT NULL").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _by_ranges(values, shares, few)
    finally:
        values.unpersist()


def _by_ranges(values: DataFrame, shares: list[float], few: int) -> list[float | None]:
    n, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
    if not n:
        return [None] * len(shares)
    places = [s * (n - 1) for s in shares]
    at: dict[int, float] = {}
    todo = [(low, high, 0, n, {r for p in places for r in (math.floor(p), math.ceil(p))})]
    while todo:
        low, high, before, inside, ranks = todo.pop()
        own = values.where(F.col("v").between(low, high))
        if low == high:
            at |= dict.fromkeys(ranks, low)
        elif inside <= few:
            seen = before
            for r in own.groupBy("v").count().orderBy("v").collect():
                at |= {rank: r.v for rank in ranks if seen <= rank < seen + r["count"]}
                seen += r["count"]
        else:
            bucket = F.least(F.floor((F.col("v") - low) / ((high - low) / BUCKETS)), F.lit(BUCKETS - 1)).alias("b")
            seen = before
            for r in own.groupBy(bucket).agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect():
                if held := {rank for rank in ranks if seen <= rank < seen + r.n}:
                    todo.append((r.lo, r.hi, seen, r.n, held))
                seen += r.n
    return [at[math.floor(p)] + (at[math.ceil(p)] - at[math.floor(p)]) * (p - math.floor(p)) for p in places]
