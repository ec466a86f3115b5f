"""Places along lines: linear referencing of polylines and rings.

A line's segments get the length before them from one window over the line;
each segment then makes its own points, so a line of any number of corners
costs one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.functions.geometry import _segments, length
from urbanframe.operators.spatial import nearest_edge


def measured_segments(df: DataFrame, keys: list[str], line: str = "line", closed: bool = False) -> DataFrame:
    """``keys, pos, ax, ay, bx, by, start, stop, whole``: a line's segments with the length up to their ends and that of the line."""
    rows = df.select(*keys, F.posexplode(_segments(F.col(line), closed)).alias("pos", "_s"))
    rows = rows.select(*keys, "pos", *[F.col(f"_s.{p}.{c}").cast("double").alias(f"{p}{c}") for p in "ab" for c in "xy"])
    along = W.partitionBy(*keys).orderBy("pos")
    part = F.sqrt((F.col("bx") - F.col("ax")) ** 2 + (F.col("by") - F.col("ay")) ** 2)
    rows = rows.withColumn("_part", part).withColumn("stop", F.sum("_part").over(along))
    # Neighbours have the very same number at their common corner.
    return rows.withColumns({"start": F.coalesce(F.lag("stop").over(along), F.lit(0.0)), "whole": F.max("stop").over(W.partitionBy(*keys))}).drop("_part")


def measures_along(df: DataFrame, keys: list[str], step: float, line: str = "line", closed: bool = False, last: Column | None = None) -> DataFrame:
    """``measured_segments`` that hold points every ``step`` from the start, with the first and last number of these: ``_low, _high``."""
    rows = measured_segments(df, keys, line, closed)
    end = F.floor((F.col("whole") if last is None else last) / F.lit(float(step)) + 1e-9)
    final = F.col("stop") >= F.col("whole")
    low = F.ceil(F.col("start") / F.lit(float(step)) - 1e-12)
    high = F.when(final, end).otherwise(F.least(end, F.ceil(F.col("stop") / F.lit(float(step)) - 1e-12) - 1))
    return rows.withColumn("_low", F.when(F.col("pos") == 0, 0).otherwise(low).cast("int")).withColumn("_high", high.cast("int")).where("_low <= _high AND (start < stop OR pos = 0)")


def points_at(rows: DataFrame, keep: list[str], step: float) -> DataFrame:
    """``keep, i, metres, x, y, whole``: the points of ``measures_along``."""
    rows = rows.withColumn("i", F.explode(F.sequence("_low", "_high"))).withColumn("metres", F.col("i") * F.lit(float(step)))
    t = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("metres") - F.col("start"), F.col("stop") - F.col("start")), F.lit(0.0)))
    return rows.select(*keep, "i", "metres", (F.col("ax") + (F.col("bx") - F.col("ax")) * t).alias("x"), (F.col("ay") + (F.col("by") - F.col("ay")) * t).alias("y"), "whole")


def points_along(df: DataFrame, keys: list[str], step: float, line: str = "line", closed: bool = False, last: Column | None = None) -> DataFrame:
    """``keys, i, metres, x, y, whole``: points every ``step`` from the start (``i`` from 0) up to ``last`` (the whole length).

    Measures beyond the end of the line stand at its end.
    """
    return points_at(measures_along(df, keys, step, line, closed, last), keys, step)


def sample_polylines(edges: DataFrame, step: int = 30) -> DataFrame:
    """Points every ``step`` metres along edges with a ``line``, from 0 to the rounded length, as ``places.sample_along``."""
    found = points_along(edges, ["ogc_fid", "u", "v"], step, last=F.rint("whole"))
    before = F.least("metres", "whole")
    return found.select(
        F.col("ogc_fid").alias("edge_ogc_fid"),
        F.col("metres").cast("int").alias("metres"),
        F.col("u").alias("n1"),
        F.col("v").alias("n2"),
        F.rint(before).cast("int").alias("n1_distance"),
        F.rint(F.col("whole") - before).cast("int").alias("n2_distance"),
        "x",
        "y",
    )


def associate_polylines(points: DataFrame, edges: DataFrame, point_id: str, farthest: float | None = None) -> DataFrame:
    """Points with their nearest edge and where on it they stand, by the length of its ``line``:
    ``edge_ogc_fid, n1, n2, n1_distance, n2_distance, match_distance, mx, my``."""
    found = nearest_edge(points, edges, point_id, farthest=farthest)
    shape = edges.select("ogc_fid", F.col("u").alias("n1"), F.col("v").alias("n2"), length(F.col("line")).alias("_line"))
    return found.join(shape, "ogc_fid").select(
        point_id,
        F.col("ogc_fid").alias("edge_ogc_fid"),
        "n1",
        "n2",
        F.rint("before").cast("int").alias("n1_distance"),
        F.rint(F.greatest(F.lit(0.0), F.col("_line") - F.col("before"))).cast("int").alias("n2_distance"),
        F.col("distance").alias("match_distance"),
        "mx",
        "my",
    )
