"""Source, sink and table-shaping queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from urbanframe.functions import scalars as sc
from urbanframe.operators import network as net
from urbanframe.operators import places as pl
from urbanframe.plans.fixtures import view, with_views
from urbanframe.session import shared_folder
from urbanframe.sources import readers as rd
from urbanframe.sources import writers as wr


def src_normalise(s, d):
    texts = view(s, d, "part").select("p_partkey", F.col("p_size").cast("string").alias("size"), F.col("p_retailprice").cast("string").alias("price"), F.when(F.col("p_size") > 3, F.col("p_size").cast("string")).otherwise("none").alias("bad"))
    return rd.normalise_numeric(texts, ["size", "price", "bad"])


def src_cells(s, d):
    px = view(s, d, "f_pixels").groupBy((F.col("pixel_id") % 40).alias("gx"), F.floor(F.col("pixel_id") / 40).cast("bigint").alias("gy")).agg(F.max("b4").alias("v")).withColumn("v", F.when(F.col("gx") % 9 == 0, -200).otherwise(F.col("v")))
    return rd.cells_from_pixels(px, "v", 100.0, -200)


def src_areas(s, d):
    return rd.grid_from_areas(view(s, d, "f_areas"), "dwellings", ["area_name"]).select("grid_id", "area_name", "pop_est")


def src_covariates(s, d):
    return rd.load_covariates(view(s, d, "nation"), ["n_name", "n_regionkey", "n_missing"], "n_regionkey = 2")


def src_gtfs(s, d):
    """A feed written as text files and read back inside a box."""
    folder = f"{shared_folder(s)}/feed-{uuid.uuid4().hex}"
    for name in rd.GTFS_TABLES:
        wr.to_csv(view(s, d, f"f_{name}"), f"{folder}/{name}.txt")
    feed = rd.load_gtfs(s, folder, (-15.55, 27.95, -15.25, 28.25))
    return feed["stop_times"].groupBy("stop_id").agg(F.count(F.lit(1)).alias("n"), F.count("departure_time").alias("timed"))


def src_policy(s, d):
    rows = view(s, d, "part").select(F.col("p_partkey").alias("row_id"), *[F.col("p_name").alias(f"c{i}") for i in range(15)])
    return rd.load_policy(rows).select("row_id", "indicators", "threshold_explanation")


def snk_geojson(s, d):
    path = f"{shared_folder(s)}/areas-{uuid.uuid4().hex}"
    wr.to_geojson(view(s, d, "f_areas"), path, ["area_id", "area_name"])
    back = s.read.text(path).select(F.from_json("value", "type string, geometry struct<type: string, coordinates: array<array<array<double>>>>, properties struct<area_id: int, area_name: string>").alias("f"))
    corner = F.col("f.geometry.coordinates")[0][2]
    return back.select("f.properties.area_id", "f.properties.area_name", F.col("f.geometry.type").alias("shape"), corner[0].alias("xmax"), corner[1].alias("ymax"))


def prj_tags(s, d):
    found = pl.ensure_columns(view(s, d, "f_osm"), ["golf"])
    tags = F.map_from_arrays(F.array(*[F.lit(k) for k in ("shop", "Name:en", "website")]), F.array("shop", "leisure", F.lit("w")))
    return found.select("osm_id", "golf", sc.tag_json("amenity", "leisure").alias("tags"), F.size(sc.without_keys(tags, ["website"])).alias("kept"))


def win_number_within(s, d):
    return rd.number_within(view(s, d, "f_edges").select("u", "v"), "u", ["v"], "k").select("u", "v", "k", "u_k")


def win_append_ids(s, d):
    first = view(s, d, "f_destinations").where("dest_oid <= 10").select(F.col("dest_oid").alias("point_id"), "x", "y")
    more = view(s, d, "f_destinations").where("dest_oid > 10").select("x", "y")
    return pl.append_ids(first, more, ["x", "y"], "point_id")


def set_compose(s, d):
    e = view(s, d, "f_edges").select("u", "v", "edge_key", "length")
    return net.compose([e.where("u % 2 = 0 OR u % 3 = 0"), e.where("u % 2 = 1")])


def net_oriented(s, d):
    keyed = view(s, d, "f_edges").withColumn("edge_key", (F.col("ogc_fid") % 3).cast("int"))
    return net.oriented_edges(keyed).select("ogc_fid", "from", "to")


def fn_scalars(s, d):
    price = F.col("p_retailprice").cast("double")
    label = F.concat(F.col("p_size").cast("string"), F.when(F.col("p_size") % 2 == 0, "m").otherwise(" miles"))
    return view(s, d, "part").select(
        "p_partkey",
        sc.half_even(F.col("p_size") / 2).alias("half"),
        sc.to_int_half_even(F.col("p_size") / 4).alias("quarter"),
        sc.clock_of(F.col("p_partkey") * 97).alias("clock"),
        sc.clamp(price, 950.0, 1200.0).alias("held"),
        sc.resolution_metres(label).alias("metres"),
        F.round(sc.fahrenheit(F.col("p_size").cast("double")), 6).alias("warm"),
        sc.recode(F.col("p_brand"), {"Brand#11": "first"}).alias("brand"),
    )


SQL = {
    "src_normalise": "SELECT p_partkey, CAST(p_size AS BIGINT) AS size, CAST(p_retailprice AS DOUBLE) AS price, CASE WHEN p_size > 3 THEN CAST(p_size AS BIGINT) END AS bad FROM part",
    "src_cells": "WITH c AS (SELECT pixel_id % 40 AS gx, pixel_id // 40 AS gy, MAX(b4) AS v FROM f_pixels GROUP BY 1, 2) SELECT ROW_NUMBER() OVER (ORDER BY gy, gx) AS grid_id, CAST(v AS BIGINT) AS pop_est, gx * 100.0::DOUBLE AS xmin, gy * 100.0::DOUBLE AS ymin, gx * 100.0::DOUBLE + 100 AS xmax, gy * 100.0::DOUBLE + 100 AS ymax FROM c WHERE gx % 9 <> 0",
    "src_areas": "SELECT ROW_NUMBER() OVER (ORDER BY area_name) AS grid_id, area_name, dwellings AS pop_est FROM f_areas",
    "src_covariates": "SELECT n_name, n_regionkey FROM nation WHERE n_regionkey = 2",
    "src_gtfs": "SELECT CAST(stop_id AS VARCHAR) AS stop_id, COUNT(*) AS n, COUNT(departure_time) AS timed FROM f_stop_times JOIN f_stops USING (stop_id) WHERE stop_lon BETWEEN -15.55 AND -15.25 AND stop_lat BETWEEN 27.95 AND 28.25 GROUP BY 1",
    "src_policy": "SELECT p_partkey AS row_id, p_name AS indicators, p_name AS threshold_explanation FROM part",
    "snk_geojson": "SELECT area_id, area_name, 'Polygon' AS shape, CAST(xmax AS DOUBLE) AS xmax, CAST(ymax AS DOUBLE) AS ymax FROM f_areas",
    "prj_tags": """SELECT osm_id, CAST(NULL AS VARCHAR) AS golf, '{' || ARRAY_TO_STRING(LIST_FILTER([CASE WHEN amenity IS NOT NULL THEN '"amenity":"' || amenity || '"' END, CASE WHEN leisure IS NOT NULL THEN '"leisure":"' || leisure || '"' END], LAMBDA x: x IS NOT NULL), ',') || '}' AS tags, CAST(1 AS INT) AS kept FROM f_osm""",
    "win_number_within": "SELECT u, v, CAST(ROW_NUMBER() OVER (PARTITION BY u ORDER BY v) AS INT) AS k, u || ',' || ROW_NUMBER() OVER (PARTITION BY u ORDER BY v) AS u_k FROM f_edges",
    "win_append_ids": "SELECT dest_oid AS point_id, x, y FROM f_destinations WHERE dest_oid <= 10 UNION ALL SELECT (SELECT MAX(dest_oid) FROM f_destinations WHERE dest_oid <= 10) + ROW_NUMBER() OVER (ORDER BY x, y), x, y FROM f_destinations WHERE dest_oid > 10",
    "set_compose": "SELECT DISTINCT u, v, edge_key, length FROM f_edges",
    "net_oriented": "SELECT ogc_fid, CASE WHEN ogc_fid % 3 = 2 THEN u ELSE v END AS \"from\", CASE WHEN ogc_fid % 3 = 2 THEN v ELSE u END AS \"to\" FROM f_edges",
    "fn_scalars": """SELECT p_partkey, ROUND_EVEN(p_size / 2.0::DOUBLE, 0) AS half, CAST(ROUND_EVEN(p_size / 4.0::DOUBLE, 0) AS INT) AS quarter,
      LPAD(CAST(p_partkey * 97 // 3600 AS VARCHAR), 2, '0') || ':' || LPAD(CAST(p_partkey * 97 // 60 % 60 AS VARCHAR), 2, '0') || ':' || LPAD(CAST(p_partkey * 97 % 60 AS VARCHAR), 2, '0') AS clock,
      GREATEST(950.0::DOUBLE, LEAST(1200.0::DOUBLE, CAST(p_retailprice AS DOUBLE))) AS held, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS metres, ROUND(p_size * 9.0::DOUBLE / 5 + 32, 6) AS warm, CASE WHEN p_brand = 'Brand#11' THEN 'first' ELSE p_brand END AS brand FROM part""",
}

QUERIES = {name: globals()[name] for name in SQL}
SQL = {name: with_views(sql) for name, sql in SQL.items()}
