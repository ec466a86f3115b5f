"""Queries of scans, filters, geometry functions, node filters and checklists."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from urbanframe.functions import geometry as g
from urbanframe.functions import scalars as sc
from urbanframe.operators import network as net
from urbanframe.operators import places as pl
from urbanframe.operators import policy as po
from urbanframe.plans.fixtures import view, with_views
from urbanframe.session import shared_folder
from urbanframe.sources import readers as rd
from urbanframe.sources import writers as wr


def _dart():
    return F.array(F.array(*[g.make_point(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(1, 5)]))


def _bend():
    return F.array(*[g.make_point(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(1, 4)])


def src_scan(s, d):
    """Features read with a condition that reaches the files."""
    return rd.read_features(s, f"{d}/orders.parquet", where="o_totalprice > 100000 AND o_orderstatus = 'F'").select("o_orderkey", "o_custkey")


def src_box(s, d):
    """Features whose box meets a query box, read from a written table."""
    path = f"{shared_folder(s)}/{uuid.uuid4().hex}"
    wr.save(view(s, d, "f_osm"), path)
    return rd.read_in_box(s, path, (500, 400, 1500, 1600)).select("osm_id")


def src_table(s, d):
    """A table without geometry and excluded columns."""
    return rd.read_table(view(s, d, "f_parks").withColumn("geom", _dart()), exclude=[f"{c}{i}" for c in "xy" for i in range(1, 5)])


def src_geo(s, d):
    """A table by key with its geometry as ``geom``."""
    found = rd.read_geo(view(s, d, "f_ways").select("leisure", "way_id", _bend().alias("shape")), "shape", "way_id")
    return found.select("way_id", "leisure", F.size("geom").alias("corners"), F.element_at("geom", -1)["x"].alias("last_x"))


def snk_csv(s, d):
    """CSV without geometry, read again."""
    path = f"{shared_folder(s)}/{uuid.uuid4().hex}"
    wr.to_csv(view(s, d, "f_ways").select("way_id", "leisure", "x1", _bend().alias("line")), path)
    return s.read.csv(path, header=True, schema="way_id long, leisure string, x1 long")


def flt_report(s, d):
    """Stops of a box, with the rows before and after observed."""
    stops = view(s, d, "f_stops")
    return rd.filter_report(stops, (F.col("stop_lon") < -15.4) & (F.col("stop_lat") > 28.0), f"stops-{uuid.uuid4().hex}")[0].select("stop_id")


def set_feeds(s, d):
    """Feeds with different columns one after the other."""
    routes = view(s, d, "f_routes").select(F.col("route_id").alias("id"), "route_type")
    stops = view(s, d, "f_stops").select(F.col("stop_id").alias("id"), "stop_name")
    return rd.concat_feeds([routes, stops])


def fn_hours(s, d):
    """Hours of clock times, and of windows of service within a day's window."""
    found = view(s, d, "f_frequencies")
    return found.select("trip_id", F.round(sc.hours_of(F.col("start_time")), 6).alias("start"), F.round(sc.hours_of(F.col("end_time")), 6).alias("end"), sc.overlap_hours(F.col("start_time"), F.col("end_time"), "07:00:00", "19:00:00").alias("inside"))


def geo_lines(s, d):
    """Length, parts, points and places of bent lines."""
    line, spot = _bend(), g.make_point(F.col("x2") + 7, F.col("y2") - 3)
    at = g.interpolate(line, F.lit(40.0))
    found = view(s, d, "f_ways").select("way_id", g.length(line).alias("length"), g.substring_length(line, F.lit(0.75), F.lit(0.25)).alias("half"), at["x"].alias("x"), at["y"].alias("y"), g.locate(line, spot).alias("share"))
    return found.select("way_id", *[F.round(c, 6).alias(c) for c in ("length", "half", "x", "y", "share")])


def geo_polygons(s, d):
    """Area, centroid, corners and widened box of concave polygons."""
    shape = _dart()
    box, mid = g.expand(g.bbox(shape), 1600.0), g.centroid(shape)
    found = view(s, d, "f_parks").select("osm_id", g.area(shape).alias("area"), mid["x"].alias("x"), mid["y"].alias("y"), F.size(g.exterior(shape)).alias("corners"), box["xmin"].alias("xmin"), box["ymax"].alias("ymax"))
    return found.select("osm_id", "corners", *[F.round(c, 6).alias(c) for c in ("area", "x", "y", "xmin", "ymax")])


def geo_parts(s, d):
    """The parts of multipolygons, one a row."""
    upper = F.array(F.array(*[g.make_point(F.col(f"x{i}"), F.col(f"y{i}") + 500) for i in (1, 2, 3)]))
    parts = view(s, d, "f_parks").select("osm_id", g.parts(F.array(_dart(), upper)).alias("polygon"))
    return parts.select("osm_id", F.round(g.area(F.col("polygon")), 6).alias("area"))


def _cells(s, d):
    """Nodes with the populous cell they are in, if any."""
    cell = F.floor(F.col("y") / 250).cast("bigint") * 1000 + F.floor(F.col("x") / 250).cast("bigint")
    nodes = view(s, d, "f_nodes").select(F.col("osmid").alias("node"), cell.alias("cell"))
    full = view(s, d, "f_grid").where("pop_est >= 150").select("grid_id")
    return nodes.join(full, F.col("cell") == F.col("grid_id"), "left").select("node", "grid_id")


def _samples(s, d):
    return pl.sample_along(view(s, d, "f_edges"))


def net_evaluated(s, d):
    """Nodes in populous cells, and those of sample points that start at one of them."""
    used = _samples(s, d).join(_cells(s, d).where("grid_id IS NOT NULL").select(F.col("node").alias("n1")), "n1", "left_semi")
    return net.evaluated_nodes(_cells(s, d), used)


def net_both_nodes(s, d):
    """Sample points both of whose nodes are in populous cells."""
    return net.require_both_nodes(_samples(s, d), net.evaluated_nodes(_cells(s, d))).select("edge_ogc_fid", "metres")


def net_whole_metres(s, d):
    """Distances as whole metres, the mark for not reached as null."""
    found = view(s, d, "f_ways").select("way_id", F.when(F.col("way_id") % 9 == 0, -999.0).otherwise(g.length(_bend()) / 2).alias("half"))
    return net.whole_metres(found, ["half"])


def policy_clean(s, d):
    """A checklist with section headers and statements on principles made whole."""
    header, states = F.col("row_id") % 17 == 0, F.col("row_id") % 7 == 0
    raw = view(s, d, "f_policy").select(
        "row_id",
        F.when(header | (F.col("row_id") % 17 == 1), F.col("indicators")).alias("indicators"),
        F.when(~header, F.concat(F.lit(" "), "measures")).alias("measures"),
        F.when(header, None).when(states, F.concat("qualifier", F.lit(", it does"))).otherwise(F.col("policy")).alias("policy"),
    )
    return po.clean_checklist(raw)


_RING = ((1, 2), (2, 3), (3, 4), (4, 1))
_CROSS = [f"(x{i} * y{j} - x{j} * y{i})" for i, j in _RING]
_AREA = " + ".join(_CROSS)
_MID = {c: "(" + " + ".join(f"({c}{i} + {c}{j}) * {cross}" for (i, j), cross in zip(_RING, _CROSS)) + f")::DOUBLE / (3 * ({_AREA}))" for c in "xy"}
_A, _B = ("SQRT(POWER(x2 - x1, 2) + POWER(y2 - y1, 2))", "SQRT(POWER(x3 - x2, 2) + POWER(y3 - y2, 2))")
_CELLS = "node_cell AS (SELECT osmid AS node, grid_id FROM f_nodes LEFT JOIN (SELECT grid_id FROM f_grid WHERE pop_est >= 150) ON grid_id = CAST(FLOOR(y / 250) AS BIGINT) * 1000 + CAST(FLOOR(x / 250) AS BIGINT)), good AS (SELECT node FROM node_cell WHERE grid_id IS NOT NULL)"


def _hours(c: str) -> str:
    return f"(CAST(SPLIT_PART({c}, ':', 1) AS INT) * 3600 + CAST(SPLIT_PART({c}, ':', 2) AS INT) * 60 + CAST(SPLIT_PART({c}, ':', 3) AS INT)) / 3600.0::DOUBLE"


def _near(i: int) -> str:
    """Share of segment ``i`` at the place nearest to a spot beside the corner."""
    j = i + 1
    return f"GREATEST(0.0::DOUBLE, LEAST(1.0::DOUBLE, ((x2 + 7 - x{i}) * (x{j} - x{i}) + (y2 - 3 - y{i}) * (y{j} - y{i}))::DOUBLE / ((x{j} - x{i}) * (x{j} - x{i}) + (y{j} - y{i}) * (y{j} - y{i}))))"


SQL = {
    "src_scan": "SELECT o_orderkey, o_custkey FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'",
    "src_box": "SELECT osm_id FROM f_osm WHERE xmin <= 1500 AND xmax >= 500 AND ymin <= 1600 AND ymax >= 400",
    "src_table": "SELECT * EXCLUDE (x1, y1, x2, y2, x3, y3, x4, y4) FROM f_parks",
    "src_geo": "SELECT way_id, leisure, CAST(3 AS INT) AS corners, x3::DOUBLE AS last_x FROM f_ways",
    "snk_csv": "SELECT way_id, leisure, x1 FROM f_ways",
    "flt_report": "SELECT stop_id FROM f_stops WHERE stop_lon < -15.4 AND stop_lat > 28.0",
    "set_feeds": "SELECT route_id AS id, route_type, NULL AS stop_name FROM f_routes UNION ALL SELECT stop_id, NULL, stop_name FROM f_stops",
    "fn_hours": f"""WITH h AS (SELECT trip_id, {_hours('start_time')} AS s, {_hours('end_time')} AS e FROM f_frequencies)
      SELECT trip_id, ROUND(s, 6) AS start, ROUND(e, 6) AS "end", ROUND_EVEN(GREATEST(0, GREATEST(0, e - s) - GREATEST(0, 7 - s) - GREATEST(0, e - 19)), 1) AS inside FROM h""",
    "geo_lines": f"""WITH l AS (SELECT *, {_A} AS a, {_B} AS b, {_near(1)} AS t1, {_near(2)} AS t2 FROM f_ways), d AS (SELECT *, POWER(x1 + (x2 - x1) * t1 - x2 - 7, 2) + POWER(y1 + (y2 - y1) * t1 - y2 + 3, 2) AS d1, POWER(x2 + (x3 - x2) * t2 - x2 - 7, 2) + POWER(y2 + (y3 - y2) * t2 - y2 + 3, 2) AS d2 FROM l)
      SELECT way_id, ROUND(a + b, 6) AS length, ROUND((a + b) / 2, 6) AS half, ROUND(CASE WHEN a >= 40 THEN x1 + (x2 - x1) * 40 / a ELSE x2 + (x3 - x2) * (40 - a) / b END, 6) AS x, ROUND(CASE WHEN a >= 40 THEN y1 + (y2 - y1) * 40 / a ELSE y2 + (y3 - y2) * (40 - a) / b END, 6) AS y,
      ROUND(CASE WHEN d2 < d1 THEN a + b * t2 ELSE a * t1 END / (a + b), 6) AS share FROM d""",
    "geo_polygons": f"SELECT osm_id, CAST(4 AS INT) AS corners, ROUND(ABS({_AREA}) / 2.0::DOUBLE, 6) AS area, ROUND({_MID['x']}, 6) AS x, ROUND({_MID['y']}, 6) AS y, x1 - 1600.0::DOUBLE AS xmin, y3 + 1600.0::DOUBLE AS ymax FROM f_parks",
    "geo_parts": f"SELECT osm_id, ABS({_AREA}) / 2.0::DOUBLE AS area FROM f_parks UNION ALL SELECT osm_id, (x2 - x1) * (y3 - y1) / 2.0::DOUBLE FROM f_parks",
    "net_evaluated": f"WITH {_CELLS} SELECT node AS osmid FROM good UNION SELECT u FROM f_edges WHERE u IN (SELECT node FROM good) UNION SELECT v FROM f_edges WHERE u IN (SELECT node FROM good)",
    "net_both_nodes": f"WITH {_CELLS}, len AS (SELECT *, SQRT(((ux - vx) * (ux - vx) + (uy - vy) * (uy - vy))::DOUBLE) AS l FROM f_edges WHERE u IN (SELECT node FROM good) AND v IN (SELECT node FROM good)) SELECT ogc_fid AS edge_ogc_fid, UNNEST(RANGE(0, CAST(ROUND_EVEN(l, 0) AS BIGINT) + 1, 30)) AS metres FROM len",
    "net_whole_metres": f"SELECT way_id, CASE WHEN way_id % 9 <> 0 THEN CAST(ROUND_EVEN(({_A} + {_B}) / 2, 0) AS INT) END AS half FROM f_ways",
    "policy_clean": """WITH raw AS (SELECT row_id, row_id % 17 = 0 AS header, CASE WHEN row_id % 17 IN (0, 1) THEN indicators END AS i, CASE WHEN row_id % 17 <> 0 THEN measures END AS m,
        CASE WHEN row_id % 17 = 0 THEN NULL WHEN row_id % 7 = 0 THEN qualifier || ', it does' ELSE policy END AS p FROM f_policy),
      marked AS (SELECT *, COALESCE(REGEXP_MATCHES(p, '^(Yes|No),'), FALSE) AS states, NULLIF(TRIM(p), '') AS policy FROM raw),
      named AS (SELECT *, LAST_VALUE(i IGNORE NULLS) OVER (ORDER BY row_id) AS indicators, LAST_VALUE(m IGNORE NULLS) OVER (ORDER BY row_id) AS measures FROM marked),
      filled AS (SELECT row_id, indicators, measures, policy, LAST_VALUE(CASE WHEN states THEN SPLIT_PART(p, ',', 1) END IGNORE NULLS) OVER (PARTITION BY indicators, measures ORDER BY row_id) AS qualifier, header, states FROM named)
      SELECT row_id, indicators, measures, policy, qualifier FROM filled WHERE NOT header AND NOT states""",
}

QUERIES = {name: globals()[name] for name in SQL}
SQL = {name: with_views(sql) for name, sql in SQL.items()}
