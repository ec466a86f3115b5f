"""Score, roll-up, custom aggregation and comparison queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanframe.operators import indicators as n
from urbanframe.operators import spatial as sp
from urbanframe.plans.fixtures import view, with_views

DISTANCES = {"d_food": "a_food", "d_conv": "a_conv", "d_pt_osm": "a_pt_osm", "d_pt_gtfs": "a_pt_gtfs"}
REGION = {"xmin": 130, "ymin": 130, "xmax": 3600, "ymax": 3300}
REFERENCE = {"pop_density": (5700.0, 2900.0), "int_density": (100.0, 45.0), "daily_living": (1.8, 0.9)}


def _points(s, d):
    return view(s, d, "f_points")


def _rounded(df, places=9, skip=()):
    return df.select(*[F.round(c, places).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes])


def formula_intersection(s, d):
    formulas = [{"name": "district", "formula": "intersection", "layer": "areas", "field": "area_name", "area_id": "area_id"}]
    return n.apply_formulas(_points(s, d), formulas, {"areas": view(s, d, "f_areas")}).select("point_id", "district")


def score_binary(s, d):
    return n.binary_access(_points(s, d), DISTANCES | {"d_none": "a_none"}).select("point_id", *DISTANCES.values(), "a_none")


def score_soft(s, d):
    return _rounded(n.soft_access(_points(s, d), DISTANCES).select("point_id", *DISTANCES.values()))


def score_gaussian(s, d):
    return _rounded(n.gaussian_access(_points(s, d), DISTANCES).select("point_id", *DISTANCES.values()))


def _living(s, d):
    scored = n.binary_access(_points(s, d), DISTANCES)
    return n.apply_formulas(scored, [{"formula": "max", "columns": ["a_pt_osm", "a_pt_gtfs"], "name": "a_pt_any"}, {"formula": "sum", "columns": ["a_food", "a_conv", "a_pt_any"], "name": "daily_living"}])


def daily_living(s, d):
    return _living(s, d).select("point_id", "a_pt_any", "daily_living")


def walkability(s, d):
    formulas = [{"formula": "sum_of_z_scores", "columns": ["pop_density", "int_density", "daily_living"], "name": "walkability"}]
    return _rounded(n.apply_formulas(_living(s, d), formulas).select("point_id", "walkability"), 6)


def relative_walkability(s, d):
    return _rounded(n.relative_indicator(_living(s, d), list(REFERENCE), "relative", REFERENCE).select("point_id", "relative"))


def pooled_walkability(s, d):
    points = _living(s, d)
    return _rounded(n.relative_indicator(points.where("x < 2000"), list(REFERENCE), "relative", pool=points).select("point_id", "relative"), 6)


def gte_flag(s, d):
    return _points(s, d).select("point_id", n.gte_flag(F.col("pop_density"), 5700).alias("dense"), n.gte_flag(F.col("int_density"), 100).alias("connected"))


def _region(s):
    return s.range(1).select(*[F.lit(v).alias(k) for k, v in REGION.items()])


def _grid(s, d):
    columns = {"a_food": "pct_food", "a_conv": "pct_conv", "daily_living": "local_living", "pop_density": "local_density"}
    return n.grid_indicators(_living(s, d), view(s, d, "f_grid"), _region(s), columns)


def grid_indicators(s, d):
    return _rounded(_grid(s, d), 6)


def city_indicators(s, d):
    columns = {"pct_food": "pop_pct_food", "pct_conv": "pop_pct_conv", "local_living": "pop_living"}
    return _rounded(n.city_indicators(_grid(s, d), columns, {"local_density": "local_density"}), 6)


def threshold_pct(s, d):
    return _grid(s, d).agg(n.threshold_pct(F.col("local_density") > 4500).alias("pct_dense"), n.threshold_pct(F.col("pct_food") >= 50).alias("pct_fed"))


def region_report(s, d):
    reference = {"local_density": (4500.0, 2000.0), "local_living": (1.5, 0.5)}
    return n.region_report(_grid(s, d), reference, list(reference), {"local_density": 5700, "pct_food": 50})


def access_profile(s, d):
    columns = {"pct_food": "food", "pct_conv": "convenience", "none": "transit"}
    grid = _grid(s, d).withColumn("none", F.lit(None).cast("double"))
    refs = s.createDataFrame([("food", 20.0, 40.0, 60.0), ("convenience", 30.0, 50.0, 70.0), ("transit", 10.0, 20.0, 30.0)], "metric string, p25 double, p50 double, p75 double")
    return _rounded(n.access_profile(n.city_indicators(grid, columns), refs, list(columns.values())), 6)


def compare_regions(s, d):
    grid = _grid(s, d)
    columns = {"pct_food": "food", "pct_conv": "convenience"}
    west = n.city_indicators(grid.where("xmin < 2000"), columns).withColumn("only_west", F.lit(1))
    return _rounded(n.compare({"west": west, "east": n.city_indicators(grid.where("xmin >= 2000"), columns)}), 6)


def grid_intersections(s, d):
    counted = n.count_in_cells(view(s, d, "f_grid"), view(s, d, "f_nodes"), 1000.0)
    area = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    return _rounded(n.with_density(counted, area), 6)


def grid_pop_density(s, d):
    area = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    return _rounded(n.with_density(view(s, d, "f_grid"), area).select("grid_id", "pop_est", "area_sqkm", "pop_per_sqkm"), 6)


def region_totals(s, d):
    counted = n.count_in_cells(view(s, d, "f_grid"), view(s, d, "f_nodes"), 1000.0)
    inside = sp.boxes_meeting(counted, _region(s), "grid_id", 1000.0)
    return _rounded(n.region_totals(inside, F.lit(3470.0 * 3170.0), ["pop_est", "intersection_count"]), 6)


def custom_point(s, d):
    found = n.custom_aggregate(_living(s, d), view(s, d, "f_areas"), {"daily_living": "", "a_food": "pct_food"}, "area_id", areal=False, weight="dwellings", keep="AREA_NAME, area_id, , nothing")
    return _rounded(found, 6)


def _cells(s, d):
    return _grid(s, d)


def custom_grid_weighted(s, d):
    found = n.custom_aggregate(_cells(s, d), view(s, d, "f_areas"), {"pct_food": "", "local_living": ""}, "area_id", areal=True, weight="pop_est")
    return _rounded(found, 6)


def custom_unapportioned(s, d):
    found = n.custom_aggregate(_cells(s, d), view(s, d, "f_areas"), {"local_living": "living"}, "area_id", areal=True, weight="pop_est", apportion=False)
    return _rounded(found, 6)


def custom_within(s, d):
    found = n.custom_aggregate(_living(s, d), view(s, d, "f_areas"), {"daily_living": "living"}, "area_id", areal=False, within=200.0)
    return _rounded(found, 6)


def custom_chained(s, d):
    clipped = n.clip_areas(view(s, d, "f_areas"), REGION)
    districts = clipped.withColumn("district", F.col("area_id") % 5).groupBy("district").agg(*[f(c).alias(c) for c, f in (("xmin", F.min), ("ymin", F.min), ("xmax", F.max), ("ymax", F.max))])
    plans = [
        {"name": "areas", "source": "points", "areas": clipped, "options": {"columns": {"daily_living": "living"}, "area_id": "area_id"}},
        {"name": "lost", "source": "nothing", "areas": clipped, "options": {"columns": {}, "area_id": "area_id"}},
        {"name": "districts", "source": "areas", "areas": districts, "options": {"columns": {"living": ""}, "area_id": "district", "weight": "unit_count"}},
    ]
    return _rounded(n.custom_aggregates({"points": (_living(s, d), False)}, plans)["districts"], 6)


A = {o: f"CASE WHEN (SELECT COUNT({c}) FROM f_points) > 0 THEN CAST(COALESCE({c} <= 500, FALSE) AS INT) END AS {o}" for c, o in (DISTANCES | {"d_none": "a_none"}).items()}
LIVING = f"""living AS (SELECT *, CAST(COALESCE(a_food, 0) + COALESCE(a_conv, 0) + COALESCE(a_pt_any, 0) AS DOUBLE) AS daily_living FROM (
  SELECT *, GREATEST(a_pt_osm, a_pt_gtfs) AS a_pt_any FROM (SELECT *, {', '.join(A.values())} FROM f_points) p) q)"""
GRID = f"""{LIVING}, means AS (SELECT grid_id, COUNT(*) AS urban_sample_point_count, AVG(a_food) * 100 AS pct_food, AVG(a_conv) * 100 AS pct_conv, AVG(daily_living) AS local_living, AVG(pop_density) AS local_density FROM living GROUP BY grid_id),
grid AS (SELECT g.*, m.* EXCLUDE (grid_id) FROM f_grid g JOIN means m USING (grid_id)
  WHERE GREATEST(0, LEAST(g.xmax, 3600) - GREATEST(g.xmin, 130)) * GREATEST(0, LEAST(g.ymax, 3300) - GREATEST(g.ymin, 130)) / 62500.0::DOUBLE >= 0.1)"""
CITY = "CAST(SUM(pop_est) AS BIGINT) AS pop_est, CAST(SUM(urban_sample_point_count) AS BIGINT) AS urban_sample_point_count"
SHARE = "GREATEST(0.0::DOUBLE, LEAST(1.0::DOUBLE, GREATEST(0, LEAST(a.xmax, b.xmax) - GREATEST(a.xmin, b.xmin)) * GREATEST(0, LEAST(a.ymax, b.ymax) - GREATEST(a.ymin, b.ymin)) / 62500.0::DOUBLE))"
MEETS = "LEAST(a.xmax, b.xmax) > GREATEST(a.xmin, b.xmin) AND LEAST(a.ymax, b.ymax) > GREATEST(a.ymin, b.ymin)"
INSIDE = "a.x >= b.xmin AND a.x < b.xmax AND a.y >= b.ymin AND a.y < b.ymax"
COUNTED = "counted AS (SELECT g.*, (SELECT COUNT(*) FROM f_nodes a WHERE a.x >= g.xmin AND a.x < g.xmax AND a.y >= g.ymin AND a.y < g.ymax) AS intersection_count FROM f_grid g)"


def _z(c: str, source: str) -> str:
    return f"({c} - (SELECT AVG({c}) FROM {source})) / NULLIF((SELECT STDDEV_SAMP({c}) FROM {source}), 0)"


def _soft(c: str) -> str:
    return f"ROUND(COALESCE(1 / (1 + EXP(5.0::DOUBLE * ({c} - 500) / 500)), 0), 9)"


def _gauss(c: str) -> str:
    return f"ROUND(COALESCE(CASE WHEN {c} <= 500 THEN 1.0::DOUBLE ELSE EXP(-(({c} - 500.0::DOUBLE) * ({c} - 500)) / 129842) END, 0), 9)"


def _pct(condition: str) -> str:
    return f"ROUND_EVEN(100.0::DOUBLE * COALESCE(SUM(CASE WHEN {condition} THEN pop_est END), 0) / SUM(pop_est), 1)"


def _wmean(c: str) -> str:
    return f"CASE WHEN COUNT({c}) > 0 THEN SUM(pop_est * {c}) / SUM(pop_est) END"


_REL = " + ".join(f"({c} - {m}::DOUBLE) / {v}::DOUBLE" for c, (m, v) in REFERENCE.items())
NAME = "living"
SQL = {
    "score_binary": f"SELECT point_id, {', '.join(A.values())} FROM f_points",
    "score_soft": f"SELECT point_id, {', '.join(f'{_soft(c)} AS {o}' for c, o in DISTANCES.items())} FROM f_points",
    "score_gaussian": f"SELECT point_id, {', '.join(f'{_gauss(c)} AS {o}' for c, o in DISTANCES.items())} FROM f_points",
    "daily_living": f"WITH {LIVING} SELECT point_id, a_pt_any, daily_living FROM living",
    "walkability": f"WITH {LIVING} SELECT point_id, ROUND({' + '.join(f'COALESCE({_z(c, NAME)}, 0)' for c in REFERENCE)}, 6) AS walkability FROM living",
    "relative_walkability": f"WITH {LIVING} SELECT point_id, ROUND({_REL}, 9) AS relative FROM living",
    "pooled_walkability": f"WITH {LIVING} SELECT point_id, ROUND({' + '.join(_z(c, 'living') for c in REFERENCE)}, 6) AS relative FROM living WHERE x < 2000",
    "formula_intersection": "SELECT p.point_id, ARG_MIN(a.area_name, a.area_id) AS district FROM f_points p LEFT JOIN f_areas a ON p.x >= a.xmin AND p.x < a.xmax AND p.y >= a.ymin AND p.y < a.ymax GROUP BY p.point_id",
    "gte_flag": "SELECT point_id, CAST(COALESCE(pop_density >= 5700, FALSE) AS INT) AS dense, CAST(COALESCE(int_density >= 100, FALSE) AS INT) AS connected FROM f_points",
    "grid_indicators": f"WITH {GRID} SELECT * REPLACE (ROUND(pct_food, 6) AS pct_food, ROUND(pct_conv, 6) AS pct_conv, ROUND(local_living, 6) AS local_living, ROUND(local_density, 6) AS local_density) FROM grid",
    "city_indicators": f"WITH {GRID} SELECT {CITY}, ROUND({_wmean('pct_food')}, 6) AS pop_pct_food, ROUND({_wmean('pct_conv')}, 6) AS pop_pct_conv, ROUND({_wmean('local_living')}, 6) AS pop_living, ROUND(AVG(local_density), 6) AS local_density FROM grid",
    "threshold_pct": f"WITH {GRID} SELECT {_pct('local_density > 4500')} AS pct_dense, {_pct('pct_food >= 50')} AS pct_fed FROM grid",
    "region_report": f"WITH {GRID}, r AS (SELECT *, (local_density - 4500) / 2000.0::DOUBLE + (local_living - 1.5::DOUBLE) / 0.5::DOUBLE AS rel FROM grid) SELECT {_pct('rel > 0')} AS pct_above_reference, {_pct('rel < 0')} AS pct_below_reference, {_pct('local_density > 5700')} AS pct_above_local_density, {_pct('pct_food > 50')} AS pct_above_pct_food FROM r",
    "access_profile": f"""WITH {GRID}, c AS (SELECT {_wmean('pct_food')} AS food, {_wmean('pct_conv')} AS convenience FROM grid),
      m AS (SELECT 'food' AS metric, food AS value, 20.0::DOUBLE AS p25, 40.0::DOUBLE AS p50, 60.0::DOUBLE AS p75 FROM c UNION ALL SELECT 'convenience', convenience, 30, 50, 70 FROM c UNION ALL SELECT 'transit', NULL, 10, 20, 30 FROM c)
      SELECT metric, ROUND(COALESCE(value, 0), 6) AS value, CASE WHEN value IS NULL THEN metric || ' (not evaluated)' ELSE metric END AS label, p25, p50, p75 FROM m""",
    "compare_regions": f"""WITH {GRID}, c AS (SELECT xmin < 2000 AS west, SUM(pop_est)::DOUBLE AS pop_est, SUM(urban_sample_point_count)::DOUBLE AS urban_sample_point_count, {_wmean('pct_food')} AS food, {_wmean('pct_conv')} AS convenience FROM grid GROUP BY 1),
      l AS (SELECT west, UNNEST(['pop_est', 'urban_sample_point_count', 'food', 'convenience']) AS metric, UNNEST([pop_est, urban_sample_point_count, food, convenience]) AS value FROM c),
      w AS (SELECT metric, MAX(CASE WHEN west THEN value END) AS west, MAX(CASE WHEN NOT west THEN value END) AS east FROM l GROUP BY metric)
      SELECT metric, ROUND(west, 6) AS west, ROUND(east, 6) AS east, ROUND(east - west, 6) AS difference, ROUND(100.0::DOUBLE * (east - west) / NULLIF(west, 0), 6) AS pct_change FROM w""",
    "grid_intersections": f"WITH {COUNTED} SELECT *, 0.0625::DOUBLE AS area_sqkm, ROUND(pop_est / 0.0625::DOUBLE, 6) AS pop_per_sqkm, ROUND(intersection_count / 0.0625::DOUBLE, 6) AS intersections_per_sqkm FROM counted",
    "grid_pop_density": "SELECT grid_id, pop_est, 0.0625::DOUBLE AS area_sqkm, ROUND(pop_est / 0.0625::DOUBLE, 6) AS pop_per_sqkm FROM f_grid",
    "region_totals": f"""WITH {COUNTED}, t AS (SELECT CAST(SUM(pop_est) AS BIGINT) AS pop_est, CAST(SUM(intersection_count) AS BIGINT) AS intersection_count FROM counted WHERE xmin <= 3600 AND xmax >= 130 AND ymin <= 3300 AND ymax >= 130)
      SELECT *, ROUND(3470.0::DOUBLE * 3170.0::DOUBLE / 1e6, 6) AS area_sqkm, ROUND(pop_est / (3470.0::DOUBLE * 3170.0::DOUBLE / 1e6), 6) AS pop_per_sqkm, ROUND(intersection_count / (3470.0::DOUBLE * 3170.0::DOUBLE / 1e6), 6) AS intersections_per_sqkm FROM t""",
    "custom_point": f"WITH {LIVING} SELECT b.area_id, b.area_name, COUNT(*) AS unit_count, ROUND(AVG(daily_living), 6) AS avg_daily_living, ROUND(AVG(a_food) * 100, 6) AS pct_food, MAX(dwellings) AS dwellings FROM living a JOIN f_areas b ON {INSIDE} GROUP BY ALL",
    "custom_grid_weighted": f"WITH {GRID} SELECT b.area_id, COUNT(*) AS unit_count, ROUND(SUM(a.pop_est * {SHARE} * a.pct_food) / NULLIF(SUM(a.pop_est * {SHARE}), 0), 6) AS pop_est_pct_food, ROUND(SUM(a.pop_est * {SHARE} * a.local_living) / NULLIF(SUM(a.pop_est * {SHARE}), 0), 6) AS pop_est_local_living, ROUND(SUM(a.pop_est * {SHARE}), 6) AS pop_est FROM grid a JOIN f_areas b ON {MEETS} GROUP BY b.area_id",
    "custom_unapportioned": f"WITH {GRID} SELECT b.area_id, COUNT(*) AS unit_count, ROUND(SUM(a.pop_est * a.local_living) / NULLIF(SUM(a.pop_est), 0), 6) AS pop_est_local_living, CAST(SUM(a.pop_est) AS DOUBLE) AS pop_est FROM grid a JOIN f_areas b ON {MEETS} GROUP BY b.area_id",
    "custom_within": f"""WITH {LIVING} SELECT b.area_id, COUNT(*) AS unit_count, ROUND(AVG(daily_living), 6) AS living FROM living a JOIN f_areas b
      ON POWER(GREATEST(0, b.xmin - a.x, a.x - b.xmax), 2) + POWER(GREATEST(0, b.ymin - a.y, a.y - b.ymax), 2) <= 40000 GROUP BY b.area_id""",
    "custom_chained": f"""WITH {LIVING}, cut AS (SELECT area_id, GREATEST(xmin, 130) AS xmin, GREATEST(ymin, 130) AS ymin, LEAST(xmax, 3600) AS xmax, LEAST(ymax, 3300) AS ymax FROM f_areas), clipped AS (SELECT * FROM cut WHERE xmax > xmin AND ymax > ymin),
      areas AS (SELECT b.area_id, b.xmin, b.ymin, b.xmax, b.ymax, COUNT(*) AS unit_count, AVG(daily_living) AS living FROM living a JOIN clipped b ON {INSIDE} GROUP BY ALL),
      districts AS (SELECT area_id % 5 AS district, MIN(xmin) AS xmin, MIN(ymin) AS ymin, MAX(xmax) AS xmax, MAX(ymax) AS ymax FROM clipped GROUP BY 1),
      pairs AS (SELECT b.district, a.living, a.unit_count, a.unit_count * LEAST(1.0::DOUBLE, (LEAST(a.xmax, b.xmax) - GREATEST(a.xmin, b.xmin)) * (LEAST(a.ymax, b.ymax) - GREATEST(a.ymin, b.ymin)) / CAST((a.xmax - a.xmin) * (a.ymax - a.ymin) AS DOUBLE)) AS w FROM areas a JOIN districts b ON {MEETS})
      SELECT district, COUNT(*) AS unit_count, ROUND(SUM(w * living) / SUM(w), 6) AS unit_count_living FROM pairs GROUP BY district""",
}

QUERIES = {name: globals()[name] for name in SQL}
SQL = {name: with_views(sql) for name, sql in SQL.items()}
