"""Sinks: tables, CSV, GeoJSON, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanframe.functions.geometry import rectangle
from urbanframe.operators.spatial import BOX


def save(df: DataFrame, path: str, by: str | None = None) -> None:
    """Overwrites a table, partitioned by region where ``by`` names it."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)


def to_csv(df: DataFrame, path: str, drop: tuple[str, ...] = ("geom", "geometry", "polygon", "line")) -> None:
    """CSV with a header, geometry left out."""
    df.drop(*[c for c in drop if c in df.columns]).write.mode("overwrite").csv(path, header=True)


def geojson_features(df: DataFrame, columns: list[str]) -> DataFrame:
    """One GeoJSON feature a row: a ``polygon`` or ``line``, else boxes as polygons, or ``x, y`` as points."""
    pair = lambda p: F.array(p["x"], p["y"])
    if "polygon" in df.columns:
        closed = F.transform("polygon", lambda ring: F.when(F.element_at(ring, 1) == F.element_at(ring, -1), ring).otherwise(F.concat(ring, F.slice(ring, 1, 1))))
        shape = F.struct(F.lit("Polygon").alias("type"), F.transform(closed, lambda ring: F.transform(ring, pair)).alias("coordinates"))
    elif "line" in df.columns:
        shape = F.struct(F.lit("LineString").alias("type"), F.transform("line", pair).alias("coordinates"))
    elif set(BOX) <= set(df.columns):
        ring = F.element_at(rectangle(*[F.col(c) for c in BOX]), 1)
        closed = F.concat(ring, F.slice(ring, 1, 1))
        shape = F.struct(F.lit("Polygon").alias("type"), F.array(F.transform(closed, lambda p: F.array(p["x"], p["y"]))).alias("coordinates"))
    else:
        shape = F.struct(F.lit("Point").alias("type"), F.array(F.col("x").cast("double"), F.col("y").cast("double")).alias("coordinates"))
    return df.select(F.to_json(F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), F.struct(*columns).alias("properties"))).alias("value"))


def to_geojson(df: DataFrame, path: str, columns: list[str]) -> None:
    """GeoJSON as text, a feature a line, so writers stay parallel."""
    geojson_features(df, columns).write.mode("overwrite").text(path)


def export_all(spark: SparkSession, tables: list[str], folder: str) -> list[str]:
    """Writes those of the catalog's tables that exist; returns the names of the missing."""
    missing = []
    for name in tables:
        if spark.catalog.tableExists(name):
            save(spark.table(name), f"{folder}/{name}")
        else:
            missing.append(name)
    return missing
