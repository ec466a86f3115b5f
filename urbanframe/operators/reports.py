"""Report tables: extents, summaries, covariates, scorecards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanframe.operators.places import with_ids
from urbanframe.operators.quantiles import quantiles
from urbanframe.operators.spatial import BOX, box_join


def extent(points: DataFrame) -> DataFrame:
    """One row: bounding box of points and its middle."""
    box = points.agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"))
    return box.withColumns({"x": (F.col("xmin") + F.col("xmax")) / 2, "y": (F.col("ymin") + F.col("ymax")) / 2})


def describe_grid(grid: DataFrame, columns: list[str], population: str = "pop_est") -> DataFrame:
    """A row per column: count, mean, deviation, extremes and quartiles. A grid without people is refused."""
    if not (grid.agg(F.sum(population)).first()[0] or 0) > 0:
        raise ValueError("the grid holds no people")
    long = grid.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    found = {c: quantiles(grid, c, [0.25, 0.5, 0.75]) for c in columns}
    quartiles = F.create_map(*[x for c, q in found.items() for x in (F.lit(c), F.array(*[F.lit(v).cast("double") for v in q]))])
    stats = long.groupBy("column").agg(F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")).withColumn("q", quartiles[F.col("column")])
    return stats.select("column", "count", "mean", "std", "min", F.col("q")[0].alias("p25"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")


def urban_covariates(region: DataFrame, covariates: DataFrame | None, names: dict[str, str]) -> DataFrame:
    """Region totals under report names beside the one row of covariates."""
    totals = region.select(*[F.col(c).alias(n) for c, n in names.items()])
    return totals.crossJoin(F.broadcast(_single(covariates))) if covariates is not None else totals


def _single(df: DataFrame) -> DataFrame:
    """A table of one row as it is; more rows are refused."""
    if df.limit(2).count() > 1:
        raise ValueError("one row is asked for")
    return df


def first_known(*columns: str) -> Column:
    """The first column that has a value (a timetable measure, else the mapped one)."""
    return F.coalesce(*map(F.col, columns))


def scorecard(city: DataFrame, policy: DataFrame, people: str, area_sqkm: str) -> DataFrame:
    """One row of city metrics, density and policy scores."""
    return city.withColumn("density", F.try_divide(F.col(people).cast("double"), F.col(area_sqkm).cast("double"))).crossJoin(F.broadcast(_single(policy)))


def sort_report(df: DataFrame, keys: list[str], position: str = "position") -> DataFrame:
    """A report in total order of its keys, with each row's ``position`` from 1.

    Rows are range-partitioned and sorted in each partition, so no task sorts a
    whole report; partitions follow each other, and files written from them, too.
    """
    return with_ids(df, keys, position)


def attach_endpoints(points: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Points of an edge with both of its ends' places (null where unknown)."""
    end = lambda n: nodes.select(F.col("osmid").alias(n), F.col("x").alias(f"{n}_x"), F.col("y").alias(f"{n}_y"))
    known = edges.select(F.col("ogc_fid").alias("edge_ogc_fid"), F.col("u").alias("n1"), F.col("v").alias("n2")).join(end("n1"), "n1", "left").join(end("n2"), "n2", "left")
    return points.drop("n1", "n2").join(known, "edge_ogc_fid", "left")


def service_area_cells(grid: DataFrame, edges: DataFrame, cell: float) -> DataFrame:
    """Populated cells that reachable edges (boxes) meet, each once."""
    hits = box_join(edges.select(*BOX), grid, cell).select(F.col("b_grid_id").alias("grid_id"))
    return grid.where("pop_est <> 0").join(hits, "grid_id", "left_semi")
