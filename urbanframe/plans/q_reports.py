"""Report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanframe.operators import network as net
from urbanframe.operators import policy as po
from urbanframe.operators import reports as rp
from urbanframe.plans.fixtures import view, with_views


def report_extent(s, d):
    return rp.extent(view(s, d, "f_nodes"))


def report_describe_grid(s, d):
    found = rp.describe_grid(view(s, d, "f_grid"), ["pop_est", "xmin"])
    return found.select("column", "count", *[F.round(c, 6).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def report_scorecard(s, d):
    city = view(s, d, "f_grid").agg(F.sum("pop_est").alias("pop_est"), (F.count(F.lit(1)) * 0.0625).alias("area_sqkm"))
    covered = rp.urban_covariates(city, view(s, d, "region").where("r_regionkey = 1").select("r_name"), {"pop_est": "people", "area_sqkm": "area"})
    card = rp.scorecard(covered, po.policy_scores(view(s, d, "f_policy")), "people", "area")
    return card.select("people", "area", "r_name", F.round("density", 6).alias("density"), "presence", "presence_of")


def report_first_known(s, d):
    return view(s, d, "f_points").select("point_id", rp.first_known("d_pt_gtfs", "d_pt_osm").alias("d_pt"))


def join_endpoints(s, d):
    points = view(s, d, "f_edges").select((F.col("ogc_fid") * 2 % 4000).alias("edge_ogc_fid"), F.col("ogc_fid").alias("point_id"))
    return rp.attach_endpoints(points, view(s, d, "f_edges"), view(s, d, "f_nodes"))


def service_area(s, d):
    inside = net.subgraph(view(s, d, "f_edges"), view(s, d, "f_nodes").where("x BETWEEN 130 AND 3600 AND y BETWEEN 130 AND 3300"))
    boxes = inside.select(F.least("ux", "vx").alias("xmin"), F.least("uy", "vy").alias("ymin"), F.greatest("ux", "vx").alias("xmax"), F.greatest("uy", "vy").alias("ymax"))
    return rp.service_area_cells(view(s, d, "f_grid"), boxes, 250.0).select("grid_id", "pop_est")


_NAMED = "(policy IS NOT NULL AND policy NOT IN ('No', '', 'nan', 'NaN'))"


def _describe(c: str) -> str:
    return f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std, MIN({c})::DOUBLE AS min, ROUND(QUANTILE_CONT({c}, 0.25), 6) AS p25, ROUND(QUANTILE_CONT({c}, 0.5), 6) AS p50, ROUND(QUANTILE_CONT({c}, 0.75), 6) AS p75, MAX({c})::DOUBLE AS max FROM f_grid"


SQL = {
    "report_extent": "SELECT MIN(x) AS xmin, MIN(y) AS ymin, MAX(x) AS xmax, MAX(y) AS ymax, (MIN(x) + MAX(x)) / 2.0::DOUBLE AS x, (MIN(y) + MAX(y)) / 2.0::DOUBLE AS y FROM f_nodes",
    "report_describe_grid": f"{_describe('pop_est')} UNION ALL {_describe('xmin')}",
    "report_scorecard": f"""WITH c AS (SELECT CAST(SUM(pop_est) AS BIGINT) AS people, COUNT(*) * 0.0625::DOUBLE AS area FROM f_grid), m AS (SELECT measures, BOOL_OR({_NAMED}) AS n FROM f_policy GROUP BY 1)
      SELECT people, area, (SELECT r_name FROM region WHERE r_regionkey = 1) AS r_name, ROUND(people / area, 6) AS density, (SELECT COUNT(*) FROM m WHERE n) AS presence, (SELECT COUNT(*) FROM m) AS presence_of FROM c""",
    "report_first_known": "SELECT point_id, COALESCE(d_pt_gtfs, d_pt_osm) AS d_pt FROM f_points",
    "join_endpoints": "SELECT p.ogc_fid AS point_id, p.ogc_fid * 2 % 4000 AS edge_ogc_fid, e.u AS n1, e.v AS n2, a.x AS n1_x, a.y AS n1_y, b.x AS n2_x, b.y AS n2_y FROM f_edges p LEFT JOIN f_edges e ON e.ogc_fid = p.ogc_fid * 2 % 4000 LEFT JOIN f_nodes a ON a.osmid = e.u LEFT JOIN f_nodes b ON b.osmid = e.v",
    "service_area": """WITH n AS (SELECT osmid FROM f_nodes WHERE x BETWEEN 130 AND 3600 AND y BETWEEN 130 AND 3300), e AS (SELECT LEAST(ux, vx) AS xmin, LEAST(uy, vy) AS ymin, GREATEST(ux, vx) AS xmax, GREATEST(uy, vy) AS ymax FROM f_edges WHERE u IN (SELECT osmid FROM n) AND v IN (SELECT osmid FROM n))
      SELECT grid_id, pop_est FROM f_grid g WHERE pop_est <> 0 AND EXISTS (SELECT 1 FROM e WHERE e.xmin <= g.xmax AND g.xmin <= e.xmax AND e.ymin <= g.ymax AND g.ymin <= e.ymax)""",
}

QUERIES = {name: globals()[name] for name in SQL}
SQL = {name: with_views(sql) for name, sql in SQL.items()}
