"""Sources: features, tables, grids, timetables, rules, checklists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.operators.places import with_ids
from urbanframe.operators.spatial import scan_box

# The checklist's column names, in its order.
POLICY_COLUMNS = ("indicators", "measures", "principles", "policy", "level", "adoption_date", "citation", "text", "mandatory", "measurable_target", "measurable_target_text", "evidence_threshold", "threshold_explanation")
GTFS_TABLES = ("stops", "stop_times", "trips", "routes", "calendar", "calendar_dates")


def read_features(spark: SparkSession, path: str, layer: str | None = None, where: str | None = None) -> DataFrame:
    """Vector features from Parquet, ORC, JSON lines or GeoJSON (by ending).

    GeoJSON gives a row per feature with its properties as columns and
    ``geometry`` as read. ``layer`` is a subfolder. Plain filters reach Parquet.
    """
    path = f"{path}/{layer}" if layer else path
    if path.endswith(".geojson"):
        features = spark.read.json(path, multiLine=True).select(F.explode("features").alias("f"))
        df = features.select("f.properties.*", "f.geometry")
    elif path.endswith((".json", ".jsonl")):
        df = spark.read.json(path)
    elif path.endswith(".orc"):
        df = spark.read.orc(path)
    elif path.endswith(".csv"):
        df = spark.read.csv(path, header=True)
    else:
        df = spark.read.parquet(path)
    return df.where(where) if where else df


def read_in_box(spark: SparkSession, path: str, box: tuple[float, float, float, float]) -> DataFrame:
    """Features whose box meets a query box."""
    return scan_box(read_features(spark, path), *box)


def read_table(df: DataFrame, columns: list[str] | None = None, exclude: list[str] | None = None, geometry: tuple[str, ...] = ("geom", "geometry", "polygon", "line")) -> DataFrame:
    """Chosen columns of a table, geometry and excluded ones left out."""
    drop = {*geometry, *(exclude or [])}
    return df.select(*[c for c in columns or df.columns if c not in drop])


def read_geo(df: DataFrame, geom: str, key: str) -> DataFrame:
    """A table with its geometry column as ``geom`` and its key first."""
    return df.select(key, *[c for c in df.columns if c not in (key, geom)], F.col(geom).alias("geom"))


def normalise_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as integers if all their values are whole, else as doubles; bad values are null."""
    numbers = df.withColumns({c: F.col(c).try_cast("double") for c in columns})
    whole = numbers.agg(*[F.coalesce(F.every(F.col(c) == F.floor(c)), F.lit(False)).alias(c) for c in columns]).first()
    return numbers.withColumns({c: F.col(c).cast("bigint") for c in columns if whole[c]})


def cells_from_pixels(px: DataFrame, value: str, size: float, nodata: float) -> DataFrame:
    """Population cells of a pixel table with cell indices ``gx, gy``: ids, boxes, whole people."""
    kept = with_ids(px.where(F.col(value) != nodata), ["gy", "gx"], "grid_id")
    box = {"xmin": F.col("gx") * size, "ymin": F.col("gy") * size, "xmax": (F.col("gx") + 1) * size, "ymax": (F.col("gy") + 1) * size}
    return kept.withColumns(box).withColumn("pop_est", F.rint(value).cast("bigint")).select("grid_id", "pop_est", *box)


def grid_from_areas(df: DataFrame, field: str, order: list[str]) -> DataFrame:
    """Population areas with the configured field as ``pop_est`` and a ``grid_id``."""
    return with_ids(df.withColumnRenamed(field, "pop_est"), order, "grid_id")


def load_covariates(df: DataFrame, columns: list[str], where: str | None = None) -> DataFrame:
    """Those of the columns that exist, filtered; one row of nulls if nothing is left."""
    found = df.where(where) if where else df
    found = found.select(*[c for c in columns if c in df.columns])
    if found.columns and not found.limit(1).count():
        return df.sparkSession.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in found.dtypes])
    return found


def load_frequencies(spark: SparkSession, folder: str, exists: bool) -> DataFrame:
    """``frequencies.txt`` where the feed has one, else an empty table."""
    schema = "trip_id string, start_time string, end_time string, headway_secs int"
    return spark.read.csv(f"{folder}/frequencies.txt", header=True, schema=schema) if exists else spark.createDataFrame([], schema)


def load_gtfs(spark: SparkSession, folder: str, box: tuple[float, float, float, float]) -> dict[str, DataFrame]:
    """A feed's tables with trimmed ids, stops inside a lon/lat box and only their stop times."""
    feed = {}
    for name in GTFS_TABLES:
        df = spark.read.csv(f"{folder}/{name}.txt", header=True)
        feed[name] = df.withColumns({c: F.trim(c) for c in df.columns if c.endswith("_id")})
    lon, lat = F.col("stop_lon").try_cast("double"), F.col("stop_lat").try_cast("double")
    feed["stops"] = feed["stops"].where(lon.between(box[0], box[2]) & lat.between(box[1], box[3]))
    feed["stop_times"] = feed["stop_times"].join(feed["stops"].select("stop_id"), "stop_id", "left_semi")
    return feed


def load_tag_rules(df: DataFrame) -> dict[str, list[dict]]:
    """Rule table (a configuration of some dozens of rows) as rules by destination; a blank value is ``NULL``,
    a blank condition ``OR``."""
    rules: dict[str, list[dict]] = {}
    for r in df.collect():
        rules.setdefault(r["dest_name"], []).append({"key": r["key"], "value": r["value"] or "NULL", "condition": r["pre-condition"] or "OR"})
    return rules


def load_policy(df: DataFrame) -> DataFrame:
    """Checklist rows with the first thirteen columns renamed; ``row_id`` keeps their order."""
    body = [c for c in df.columns if c != "row_id"][: len(POLICY_COLUMNS)]
    return df.select("row_id", *[F.col(c).alias(n) for c, n in zip(body, POLICY_COLUMNS)])


def filter_report(df: DataFrame, condition: Column, name: str = "kept") -> tuple[DataFrame, object]:
    """Filtered rows, and an observation of the rows before and after, filled when the result runs."""
    from pyspark.sql import Observation

    seen = Observation(name)
    watched = df.observe(seen, F.count(F.lit(1)).alias("before"), F.count_if(condition).alias("after"))
    return watched.where(condition), seen


def number_within(df: DataFrame, group: str, order: list[str], out: str = "node") -> DataFrame:
    """Rows numbered from 1 within their group, and ``<group>,<number>`` keys."""
    numbered = df.withColumn(out, F.row_number().over(W.partitionBy(group).orderBy(*order)))
    return numbered.withColumn(f"{group}_{out}", F.concat_ws(",", group, out))


def concat_feeds(frames: list[DataFrame]) -> DataFrame:
    """Feeds one after the other; columns that one lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
