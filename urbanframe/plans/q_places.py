"""Spatial join, network, destination, sampling and open-space queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanframe.functions import geometry as g
from urbanframe.operators import network as net
from urbanframe.operators import places as pl
from urbanframe.operators import spatial as sp
from urbanframe.plans.fixtures import union_area_sql, view, with_views
from urbanframe.session import written

#: Seeds lie thinly, so tiles of three search distances share the cost of a group among more of them.
SEED_TILE = 1500.0
RULES = {
    "fresh_food_market": [{"key": "shop", "value": "supermarket", "condition": "OR"}, {"key": "amenity", "value": "marketplace", "condition": "OR"}, {"key": "access", "value": "private", "condition": "NOT"}],
    "convenience": [{"key": "shop", "value": v, "condition": "OR"} for v in ("bakery", "convenience", "kiosk")] + [{"key": "amenity", "value": "fuel", "condition": "OR"}],
    "school": [{"key": "amenity", "value": "school", "condition": "AND"}, {"key": "leisure", "value": "NULL", "condition": "AND"}],
}


def _lines(s, d):
    return view(s, d, "f_edges").withColumn("line", F.array(g.make_point(F.col("ux"), F.col("uy")), g.make_point(F.col("vx"), F.col("vy"))))


def _osm(s, d):
    return view(s, d, "f_osm")


def point_in_cell(s, d):
    return sp.attach_area(view(s, d, "f_destinations"), view(s, d, "f_grid"), "dest_oid", "grid_id", 1000.0).select("dest_oid", "grid_id")


def point_in_polygon(s, d):
    areas = view(s, d, "f_areas").withColumn("polygon", F.array(F.array(g.make_point(F.col("xmin"), F.col("ymin")), g.make_point(F.col("xmax"), F.col("ymin")), g.make_point(F.col("xmin"), F.col("ymax")))))
    return sp.attach_area(view(s, d, "f_nodes"), areas, "osmid", "area_id", 800.0, field="area_name").select("osmid", "area_name")


def semi_cells(s, d):
    return sp.boxes_meeting(view(s, d, "f_grid"), view(s, d, "f_areas"), "grid_id", 800.0).select("grid_id")


def anti_openspace(s, d):
    return sp.anti(view(s, d, "f_nodes"), pl.candidates(_osm(s, d)), "osmid", 200.0).select("osmid")


def anti_threshold(s, d):
    exempt = view(s, d, "f_areas").where("dwellings >= 250")
    return sp.anti_below(view(s, d, "f_nodes"), view(s, d, "f_grid"), "osmid", "pop_est", 300, 1000.0, exempt).select("osmid")


def semi_any(s, d):
    covers = [view(s, d, "f_areas"), view(s, d, "f_grid").where("pop_est < 200")]
    return sp.semi_any(view(s, d, "f_nodes"), covers, "osmid", 800.0).select("osmid")


def knn_edge(s, d):
    found = sp.nearest_edge(view(s, d, "f_destinations"), _lines(s, d), "dest_oid")
    return found.select("dest_oid", "ogc_fid", F.round("distance", 6).alias("distance"), F.round("before", 6).alias("before"))


def snap_points(s, d):
    return sp.snap(view(s, d, "f_destinations"), _lines(s, d), "dest_oid", 40.0).select("dest_oid", "ogc_fid")


def within_distance(s, d):
    pairs = sp.within_distance(sp.with_point_box(view(s, d, "f_destinations")), _osm(s, d), 60.0, 200.0)
    return pairs.select(F.col("a_dest_oid").alias("dest_oid"), F.col("b_osm_id").alias("osm_id"), F.round("distance", 6).alias("distance"))


def overlap_ratio(s, d):
    return sp.overlap_filter(view(s, d, "f_grid"), view(s, d, "f_areas"), "grid_id", 0.3, 800.0).select("grid_id")


def covered_self(s, d):
    return sp.covered_by_other(_osm(s, d), "osm_id", 200.0)


def polygon_overlap(s, d):
    """General overlap area, on rectangles so that SQL can check it."""
    a, b = (df.withColumn("shape", g.rectangle(*[F.col(c) for c in sp.BOX])) for df in (_osm(s, d), view(s, d, "f_areas")))
    pairs = sp.box_join(a.select("osm_id", *sp.BOX, "shape"), b.select("area_id", *sp.BOX, "shape"), 400.0)
    shared = pairs.withColumn("shared", g.overlap_area(F.col("a_shape"), F.col("b_shape")))
    return shared.where("shared > 0").select(F.col("a_osm_id").alias("osm_id"), F.col("b_area_id").alias("area_id"), F.round("shared", 4).alias("shared"), F.round(g.area(F.col("a_shape")), 4).alias("own"))


def dest_classify(s, d):
    return pl.classify_tags(_osm(s, d), RULES).select("osm_id", "dest_name")


def _destinations(s, d):
    areas = pl.classify_tags(_osm(s, d), RULES)
    points = view(s, d, "f_destinations").select(F.col("dest_oid").alias("osm_id"), "dest_name", "x", "y")
    return pl.destinations(points, areas)


def dest_by_cell(s, d):
    return pl.counts_in(_destinations(s, d), view(s, d, "f_grid"), "grid_id", 1000.0)


def dest_by_region(s, d):
    people = view(s, d, "f_grid").agg(F.sum("pop_est").alias("people"))
    counts = pl.dest_type_counts(_destinations(s, d)).crossJoin(F.broadcast(people))
    out = pl.per_area_and_people(counts, F.lit(16.0), F.col("people"))
    return out.select("dest_name", "count", F.round("count_per_sqkm", 6).alias("count_per_sqkm"), F.round("count_per_sqkm_per_10k_pop", 6).alias("count_per_sqkm_per_10k_pop"))


def dest_type_counts(s, d):
    return pl.dest_type_counts(_destinations(s, d))


def dest_pivot(s, d):
    return pl.dest_pivot(_destinations(s, d).withColumn("district", F.floor(F.col("x") / 1000).cast("bigint")), "district", ["fresh_food_market", "convenience", "school", "pt_any"])


def dest_replace(s, d):
    own = view(s, d, "f_destinations").where("dest_name = 'convenience'").select(F.col("dest_oid").alias("osm_id"), "dest_name", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    tagged = pl.destinations(own.limit(0), pl.classify_tags(_osm(s, d), RULES))
    return pl.dest_type_counts(pl.add_pois(tagged, own, ["convenience"]))


def dest_near_region(s, d):
    region = s.range(1).select(F.lit(1000).alias("xmin"), F.lit(1000).alias("ymin"), F.lit(2000).alias("xmax"), F.lit(2000).alias("ymax"))
    pairs = sp.within_distance(sp.with_point_box(_destinations(s, d)), region, 500.0, 1000.0)
    return pairs.groupBy(F.col("a_dest_name").alias("dest_name")).agg(F.count(F.lit(1)).alias("count"))


def _rounded_points(df):
    return df.withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


def sample_points(s, d):
    return _rounded_points(pl.with_ids(pl.sample_along(view(s, d, "f_edges")), ["edge_ogc_fid", "metres"], "point_id"))


def sample_dedupe(s, d):
    return _rounded_points(pl.dedupe_places(pl.sample_along(view(s, d, "f_edges")), ["edge_ogc_fid", "metres"])).select("edge_ogc_fid", "metres", "x", "y")


def sample_offsets(s, d):
    points = pl.sample_along(view(s, d, "f_edges")).withColumn("grid_id", sp.cell_id(F.col("x"), F.col("y"), 250.0))
    return points.groupBy("grid_id").agg(F.count(F.lit(1)).alias("n"), F.sum("n1_distance").alias("n1_distance"), F.sum("n2_distance").alias("n2_distance"))


def _homes(s, d):
    """Customers linked to their nation: as many components as nations."""
    return view(s, d, "customer").select(F.col("c_custkey").alias("ogc_fid"), F.col("c_custkey").alias("u"), (F.col("c_nationkey") + 1_000_000_000_000).alias("v"))


def net_component(s, d):
    """Edges of the street network's components of at least 100 nodes; all edges are read."""
    return net.filter_components(view(s, d, "f_edges"), min_nodes=100).select("ogc_fid")


def net_largest(s, d):
    """Edges of the largest component, the one of the lowest id on ties."""
    return net.filter_components(_homes(s, d), retain_all=False).select("ogc_fid")


def net_neighbourhood(s, d):
    nodes = view(s, d, "f_nodes")
    reached = net.reach_by_tile(view(s, d, "f_edges"), nodes, 1000)
    cells = nodes.select(F.col("osmid").alias("node"), sp.cell_id(F.col("x"), F.col("y"), 250.0).alias("grid_id"))
    return net.neighbourhood_mean(reached, cells, view(s, d, "f_grid"), ["pop_est"]).select("src", F.round("pop_est", 6).alias("pop_est"))


def _pois(s, d, lines):
    return view(s, d, "f_destinations").join(net.associate(view(s, d, "f_destinations"), lines, "dest_oid"), "dest_oid")


def net_associate(s, d):
    found = net.associate(view(s, d, "f_destinations"), _lines(s, d), "dest_oid")
    return found.withColumn("match_distance", F.round("match_distance", 6))


def net_seed_distance(s, d):
    lines = written(_lines(s, d))
    return net.reach_by_tile(lines, net.seed_nodes([_pois(s, d, lines)]), 500, cell=SEED_TILE)


def _nearest(s, d):
    lines = written(_lines(s, d))
    pois = written(_pois(s, d, lines))
    conditions = {"food": F.col("dest_name") == "fresh_food_market", "convenience": F.col("dest_name") == "convenience", "transit": F.col("dest_name") == "pt_any"}
    return net.nearest_poi(net.reach_by_tile(lines, net.seed_nodes([pois]), 500, cell=SEED_TILE), pois, conditions)


def net_nearest_poi(s, d):
    return _nearest(s, d)


def net_point_estimates(s, d):
    nodes = view(s, d, "f_nodes").select(F.col("osmid").alias("node"), F.when(F.col("osmid") % 13 != 0, 500.0 + F.col("osmid") % 900).alias("density")).join(_nearest(s, d), "node", "full")
    points = pl.with_ids(pl.sample_along(view(s, d, "f_edges")), ["edge_ogc_fid", "metres"], "point_id")
    found = net.point_estimates(points, nodes, ["food", "convenience"], ["density"])
    return found.select("point_id", "food", "convenience", F.round("density", 6).alias("density"))


def net_intersections(s, d):
    found = net.consolidate_intersections(view(s, d, "f_nodes"), view(s, d, "f_edges"), 35.0)
    return found.select("component", "members", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def pos_candidates(s, d):
    return pl.cut_exclusions(pl.candidates(_osm(s, d)), pl.exclusions(_osm(s, d)), "osm_id", 200.0).select("osm_id", F.round("area_ha", 6).alias("area_ha"))


def _spaces(s, d):
    found = pl.candidates(_osm(s, d))
    w, h = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    found = found.withColumns({"area_ha": w * h / 10000.0, "diameter": F.sqrt((w * w + h * h).cast("double"))})
    return found.withColumn("roundness", w * h / (F.lit(3.141592653589793) * (w * w + h * h) / 4.0))


def pos_linear(s, d):
    return pl.acceptable_linear(pl.water_linear(_spaces(s, d)), "osm_id", 200.0).select("osm_id", "water_feature", "linear_tag", "linear_feature", "acceptable_linear_feature")


def pos_public(s, d):
    return pl.public_access(pl.water_linear(_spaces(s, d)), "osm_id", 200.0).select("osm_id", "public_access", "within_public")


def _clusters(s, d):
    flagged = pl.acceptable_linear(pl.water_linear(_spaces(s, d)), "osm_id", 200.0)
    return pl.open_space_clusters(pl.public_access(flagged, "osm_id", 200.0), "osm_id", 200.0)


def pos_clusters(s, d):
    return _clusters(s, d).select("aos_id", "aos_class", "members", *[F.round(c, 6).alias(c) for c in ("aos_ha", "aos_ha_public", "aos_ha_water", "water_percent")])


def pos_roundness(s, d):
    shape = g.rectangle(*[F.col(c) for c in sp.BOX])
    return _osm(s, d).select("osm_id", F.round(g.roundness(shape), 6).alias("roundness"), F.round(g.min_circle(shape)["r"] * 2, 6).alias("diameter"))


def pos_perimeter(s, d):
    return pl.perimeter_nodes(_osm(s, d).where("leisure = 'park'"), "osm_id")


def pos_access(s, d):
    parks = pl.perimeter_nodes(_osm(s, d).where("leisure = 'park' AND (xmax - xmin) * (ymax - ymin) > 15000"), "osm_id")
    return pl.near_network(parks, _lines(s, d), "osm_id", 30.0).select("osm_id", "node")


def _in(p: str, b: str) -> str:
    return f"{p}.x >= {b}.xmin AND {p}.x < {b}.xmax AND {p}.y >= {b}.ymin AND {p}.y < {b}.ymax"


CANDIDATES = "cand AS (SELECT * FROM f_osm WHERE leisure IS NOT NULL OR landuse IN ('forest'))"
T = "GREATEST(0.0::DOUBLE, LEAST(1.0::DOUBLE, ((p.x - e.ux) * (e.vx - e.ux) + (p.y - e.uy) * (e.vy - e.uy)) / NULLIF(((e.vx - e.ux) * (e.vx - e.ux) + (e.vy - e.uy) * (e.vy - e.uy))::DOUBLE, 0)))"
KNN = f"""places AS (SELECT p.dest_oid, p.dest_name, e.ogc_fid, e.u, e.v, SQRT(((e.vx - e.ux) * (e.vx - e.ux) + (e.vy - e.uy) * (e.vy - e.uy))::DOUBLE) AS len, {T} AS t,
    SQRT(POWER(e.ux + (e.vx - e.ux) * {T} - p.x, 2) + POWER(e.uy + (e.vy - e.uy) * {T} - p.y, 2)) AS distance FROM f_destinations p CROSS JOIN f_edges e),
knn AS (SELECT *, t * len AS before FROM places QUALIFY ROW_NUMBER() OVER (PARTITION BY dest_oid ORDER BY ROUND(distance, 9), ogc_fid) = 1),
pois AS (SELECT dest_oid, dest_name, ogc_fid, u AS n1, v AS n2, CAST(ROUND_EVEN(before, 0) AS INT) AS n1_distance, CAST(ROUND_EVEN(GREATEST(0, len - before), 0) AS INT) AS n2_distance, distance FROM knn)"""
ADJ = "adj AS (SELECT u AS node, v AS next, length FROM f_edges UNION ALL SELECT v, u, length FROM f_edges)"
SEEDS = "seeds AS (SELECT n1 AS node FROM pois UNION SELECT n2 FROM pois)"
WALK = "walk AS (SELECT node AS src, node, CAST(0 AS BIGINT) AS dist FROM seeds UNION SELECT w.src, a.next, w.dist + a.length FROM walk w JOIN adj a ON a.node = w.node WHERE w.dist + a.length <= {limit}), dists AS (SELECT src, node, MIN(dist) AS dist FROM walk GROUP BY 1, 2)"
NEAREST = """ends AS (SELECT dest_name, n1 AS src, n1_distance AS off FROM pois UNION ALL SELECT dest_name, n2, n2_distance FROM pois),
nearest AS (SELECT d.node, MIN(CASE WHEN dest_name = 'fresh_food_market' THEN dist + off END) AS food, MIN(CASE WHEN dest_name = 'convenience' THEN dist + off END) AS convenience, MIN(CASE WHEN dest_name = 'pt_any' THEN dist + off END) AS transit
  FROM dists d JOIN ends e ON e.src = d.src GROUP BY d.node)"""
CLASSES = """classes AS (SELECT *, 'fresh_food_market' AS dest_name FROM f_osm WHERE (shop = 'supermarket' OR amenity = 'marketplace') AND (access <> 'private' OR access IS NULL)
  UNION ALL SELECT *, 'convenience' FROM f_osm WHERE shop IN ('bakery', 'convenience', 'kiosk') OR amenity = 'fuel'
  UNION ALL SELECT *, 'school' FROM f_osm WHERE amenity = 'school' AND leisure IS NOT NULL),
dests AS (SELECT dest_oid AS osm_id, dest_name, x::DOUBLE AS x, y::DOUBLE AS y FROM f_destinations UNION ALL SELECT osm_id, dest_name, (xmin + xmax) / 2::DOUBLE, (ymin + ymax) / 2::DOUBLE FROM classes)"""


def _samples(step: int) -> str:
    return f"""len AS (SELECT *, SQRT(((ux - vx) * (ux - vx) + (uy - vy) * (uy - vy))::DOUBLE) AS l FROM f_edges),
steps AS (SELECT *, UNNEST(GENERATE_SERIES(0, CAST(ROUND_EVEN(l, 0) AS INT), {step})) AS m FROM len),
parts AS (SELECT *, LEAST(1.0::DOUBLE, COALESCE(m / NULLIF(l, 0), 0)) AS p FROM steps),
samples AS (SELECT ogc_fid AS edge_ogc_fid, CAST(m AS INT) AS metres, u AS n1, v AS n2, CAST(ROUND_EVEN(p * l, 0) AS INT) AS n1_distance, CAST(ROUND_EVEN(GREATEST(0, (1 - p) * l), 0) AS INT) AS n2_distance, ux + (vx - ux) * p AS x, uy + (vy - uy) * p AS y,
  ROW_NUMBER() OVER (ORDER BY ogc_fid, m) AS point_id FROM parts)"""


def _overlap(a: str, b: str) -> str:
    return f"(GREATEST(0, LEAST({a}.xmax, {b}.xmax) - GREATEST({a}.xmin, {b}.xmin)) * GREATEST(0, LEAST({a}.ymax, {b}.ymax) - GREATEST({a}.ymin, {b}.ymin)))"


def _covered(a: str, b: str) -> str:
    return f"{a}.xmin >= {b}.xmin AND {a}.xmax <= {b}.xmax AND {a}.ymin >= {b}.ymin AND {a}.ymax <= {b}.ymax"


def _meet(a: str, b: str) -> str:
    return f"{a}.xmin <= {b}.xmax AND {b}.xmin <= {a}.xmax AND {a}.ymin <= {b}.ymax AND {b}.ymin <= {a}.ymax"


SPACES = f"""{CANDIDATES}, sized AS (SELECT *, (xmax - xmin) * (ymax - ymin) / 10000.0::DOUBLE AS area_ha, SQRT(((xmax - xmin) * (xmax - xmin) + (ymax - ymin) * (ymax - ymin))::DOUBLE) AS diameter FROM cand),
spaces AS (SELECT *, COALESCE(natural_tag = 'water', FALSE) AS water_feature, CAST(NULL AS BOOLEAN) AS linear_tag, area_ha > 0.5 AND area_ha * 10000 / (3.141592653589793::DOUBLE * diameter * diameter / 4.0::DOUBLE) < 0.25 AS linear_feature FROM sized)"""
LINEARS = f"""good AS (SELECT a.osm_id FROM spaces a JOIN spaces b ON a.osm_id <> b.osm_id AND {_meet('a', 'b')} WHERE a.linear_feature AND (
    (NOT b.linear_feature AND (({_covered('a', 'b')}) OR (a.diameter < 800 AND ({_overlap('a', 'b')} / (a.area_ha * 10000) > 0.2
      OR (a.osm_id < b.osm_id AND (CASE WHEN LEAST(a.xmax, b.xmax) = GREATEST(a.xmin, b.xmin) THEN LEAST(a.ymax, b.ymax) - GREATEST(a.ymin, b.ymin) WHEN LEAST(a.ymax, b.ymax) = GREATEST(a.ymin, b.ymin) THEN LEAST(a.xmax, b.xmax) - GREATEST(a.xmin, b.xmin) ELSE 0 END) > 50)))))
    OR (a.diameter < 800 AND {_overlap('a', 'b')} / 10000.0::DOUBLE > 0.4))),
linears AS (SELECT *, CASE WHEN linear_feature THEN osm_id IN (SELECT osm_id FROM good) END AS acceptable_linear_feature FROM spaces)"""
PUBLIC = f"""tagged AS (SELECT *, NOT COALESCE(amenity IN ('school'), FALSE) AND NOT COALESCE(leisure IN ('pitch', 'garden'), FALSE) AND NOT COALESCE(natural_tag IN ('wood', 'water'), FALSE) AND NOT COALESCE(access IN ('private', 'no'), FALSE) AS pa FROM linears),
cover AS (SELECT a.osm_id AS i, b.osm_id AS o FROM tagged a JOIN tagged b ON a.osm_id <> b.osm_id AND {_covered('a', 'b')}),
inside AS (SELECT *, osm_id IN (SELECT i FROM cover JOIN tagged t ON t.osm_id = o AND t.pa) AS within_public FROM tagged),
once AS (SELECT * REPLACE (pa AND osm_id NOT IN (SELECT i FROM cover JOIN inside t ON t.osm_id = o AND NOT t.pa) AS pa) FROM inside),
public AS (SELECT * EXCLUDE (pa), pa AND osm_id NOT IN (SELECT i FROM cover JOIN once t ON t.osm_id = o AND NOT t.pa AND NOT t.within_public) AS public_access FROM once)"""
CLUSTERS = f"""classed AS (SELECT *, area_ha AS ha, CASE WHEN COALESCE(linear_tag, FALSE) THEN 4 WHEN (public_access OR within_public) AND (NOT linear_feature OR COALESCE(acceptable_linear_feature, FALSE)) THEN 1 WHEN NOT public_access AND NOT within_public THEN 2 WHEN public_access THEN 3 END AS aos_class FROM public),
near AS (SELECT a.osm_id AS a, b.osm_id AS b, {_overlap('a', 'b')} / 10000.0::DOUBLE AS shared, a.public_access AND b.public_access AS pub, a.water_feature AND b.water_feature AS wat FROM classed a JOIN classed b ON a.osm_id < b.osm_id AND a.aos_class = b.aos_class AND a.aos_class <= 2 AND {_meet('a', 'b')}),
links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
closure AS (SELECT osm_id AS n, osm_id AS r FROM classed WHERE aos_class IS NOT NULL UNION SELECT c.n, l.b FROM closure c JOIN links l ON l.a = c.r),
label AS (SELECT n, MIN(r) AS aos_id FROM closure GROUP BY n),
sums AS (SELECT l.aos_id, MIN(aos_class) AS aos_class, COUNT(*) AS members FROM classed c JOIN label l ON l.n = c.osm_id GROUP BY 1),
boxes AS (SELECT l.aos_id, UNNEST(['all', CASE WHEN public_access THEN 'public' END, CASE WHEN water_feature THEN 'water' END]) AS part, xmin, ymin, xmax, ymax FROM classed c JOIN label l ON l.n = c.osm_id),
{union_area_sql('boxes', 'aos_id, part', "part IS NOT NULL")},
aos AS (SELECT s.aos_id, CAST(aos_class AS INT) AS aos_class, members, COALESCE(MAX(CASE WHEN part = 'all' THEN area END), 0) / 10000.0::DOUBLE AS aos_ha, COALESCE(MAX(CASE WHEN part = 'public' THEN area END), 0) / 10000.0::DOUBLE AS aos_ha_public, COALESCE(MAX(CASE WHEN part = 'water' THEN area END), 0) / 10000.0::DOUBLE AS aos_ha_water
  FROM sums s LEFT JOIN union_area USING (aos_id) GROUP BY ALL)"""
RING = """ring AS (SELECT *, (xmax - xmin)::DOUBLE AS w, (ymax - ymin)::DOUBLE AS h FROM f_osm WHERE leisure = 'park' {more}),
stepped AS (SELECT *, UNNEST(GENERATE_SERIES(0, GREATEST(0, CAST(CEIL(2 * (w + h) / 20) AS INT) - 1))) AS i FROM ring),
nodes20 AS (SELECT osm_id, CAST(i + 1 AS INT) AS node, CASE WHEN i * 20 <= w THEN xmin + i * 20 WHEN i * 20 <= w + h THEN xmax WHEN i * 20 <= 2 * w + h THEN xmax - (i * 20 - w - h) ELSE xmin END::DOUBLE AS x,
  CASE WHEN i * 20 <= w THEN ymin WHEN i * 20 <= w + h THEN ymin + (i * 20 - w) WHEN i * 20 <= 2 * w + h THEN ymax ELSE ymax - (i * 20 - 2 * w - h) END::DOUBLE AS y FROM stepped)"""
HOMES = "homes AS (SELECT c_nationkey, COUNT(*) AS n, MIN(c_custkey) AS first FROM customer GROUP BY c_nationkey)"

SQL = {
    "point_in_cell": f"SELECT p.dest_oid, MIN(g.grid_id) AS grid_id FROM f_destinations p LEFT JOIN f_grid g ON {_in('p', 'g')} GROUP BY p.dest_oid",
    "point_in_polygon": """SELECT p.osmid, ARG_MIN(a.area_name, a.area_id) AS area_name FROM f_nodes p LEFT JOIN f_areas a ON p.y >= a.ymin AND p.y < a.ymax AND p.x >= a.xmin
      AND p.x < (a.xmin - a.xmax)::DOUBLE * (p.y - a.ymin) / (a.ymax - a.ymin) + a.xmax GROUP BY p.osmid""",
    "semi_cells": f"SELECT grid_id FROM f_grid a WHERE EXISTS (SELECT 1 FROM f_areas b WHERE {_meet('a', 'b')})",
    "anti_openspace": f"WITH {CANDIDATES} SELECT osmid FROM f_nodes p WHERE NOT EXISTS (SELECT 1 FROM cand b WHERE {_in('p', 'b')})",
    "anti_threshold": f"SELECT osmid FROM f_nodes p WHERE NOT EXISTS (SELECT 1 FROM f_grid g WHERE g.pop_est < 300 AND {_in('p', 'g')}) OR EXISTS (SELECT 1 FROM f_areas b WHERE b.dwellings >= 250 AND {_in('p', 'b')})",
    "semi_any": f"SELECT osmid FROM f_nodes p WHERE EXISTS (SELECT 1 FROM f_areas b WHERE {_in('p', 'b')}) OR EXISTS (SELECT 1 FROM f_grid g WHERE g.pop_est < 200 AND {_in('p', 'g')})",
    "knn_edge": f"WITH {KNN} SELECT dest_oid, ogc_fid, ROUND(distance, 6) AS distance, ROUND(before, 6) AS before FROM knn",
    "snap_points": f"WITH {KNN} SELECT dest_oid, ogc_fid FROM knn WHERE distance <= 40",
    "within_distance": """SELECT dest_oid, osm_id, ROUND(distance, 6) AS distance FROM (SELECT p.dest_oid, o.osm_id, SQRT(POWER(GREATEST(0, o.xmin - p.x, p.x - o.xmax)::DOUBLE, 2) + POWER(GREATEST(0, o.ymin - p.y, p.y - o.ymax)::DOUBLE, 2)) AS distance FROM f_destinations p CROSS JOIN f_osm o) WHERE distance <= 60""",
    "overlap_ratio": f"WITH clipped AS (SELECT a.grid_id, GREATEST(a.xmin, b.xmin) AS xmin, GREATEST(a.ymin, b.ymin) AS ymin, LEAST(a.xmax, b.xmax) AS xmax, LEAST(a.ymax, b.ymax) AS ymax FROM f_grid a JOIN f_areas b ON {_meet('a', 'b')}), {union_area_sql('clipped', 'grid_id', 'TRUE')} SELECT grid_id FROM union_area WHERE area / 62500.0::DOUBLE >= 0.3",
    "covered_self": f"SELECT a.osm_id AS inner, b.osm_id AS outer FROM f_osm a JOIN f_osm b ON a.osm_id <> b.osm_id AND {_covered('a', 'b')}",
    "dest_classify": f"WITH {CLASSES} SELECT osm_id, dest_name FROM classes",
    "dest_by_cell": f"WITH {CLASSES} SELECT g.grid_id, d.dest_name, COUNT(*) AS count FROM dests d JOIN f_grid g ON {_in('d', 'g')} GROUP BY 1, 2",
    "dest_by_region": f"WITH {CLASSES}, c AS (SELECT dest_name, COUNT(*) AS count FROM dests GROUP BY 1) SELECT dest_name, count, ROUND(count / 16.0::DOUBLE, 6) AS count_per_sqkm, ROUND(count / 16.0::DOUBLE / ((SELECT SUM(pop_est) FROM f_grid) / 10000.0::DOUBLE), 6) AS count_per_sqkm_per_10k_pop FROM c",
    "dest_type_counts": f"WITH {CLASSES} SELECT dest_name, COUNT(*) AS count FROM dests GROUP BY 1",
    "dest_pivot": f"WITH {CLASSES} SELECT CAST(FLOOR(x / 1000) AS BIGINT) AS district, " + ", ".join(f"NULLIF(COUNT(CASE WHEN dest_name = '{n}' THEN 1 END), 0) AS {n}" for n in ("fresh_food_market", "convenience", "school", "pt_any")) + " FROM dests GROUP BY 1",
    "dest_replace": f"WITH {CLASSES} SELECT dest_name, COUNT(*) AS count FROM (SELECT dest_name FROM classes WHERE dest_name <> 'convenience' UNION ALL SELECT dest_name FROM f_destinations WHERE dest_name = 'convenience') GROUP BY 1",
    "dest_near_region": f"WITH {CLASSES} SELECT dest_name, COUNT(*) AS count FROM dests WHERE SQRT(POWER(GREATEST(0, 1000 - x, x - 2000), 2) + POWER(GREATEST(0, 1000 - y, y - 2000), 2)) <= 500 GROUP BY 1",
    "sample_points": f"WITH {_samples(30)} SELECT * REPLACE (ROUND(x, 6) AS x, ROUND(y, 6) AS y) FROM samples",
    "sample_dedupe": f"WITH {_samples(30)} SELECT edge_ogc_fid, metres, ROUND(x, 6) AS x, ROUND(y, 6) AS y FROM samples QUALIFY ROW_NUMBER() OVER (PARTITION BY ROUND(x, 6), ROUND(y, 6) ORDER BY edge_ogc_fid, metres) = 1",
    "sample_offsets": f"WITH {_samples(30)} SELECT CAST(FLOOR(y / 250) AS BIGINT) * 1000 + CAST(FLOOR(x / 250) AS BIGINT) AS grid_id, COUNT(*) AS n, CAST(SUM(n1_distance) AS BIGINT) AS n1_distance, CAST(SUM(n2_distance) AS BIGINT) AS n2_distance FROM samples GROUP BY 1",
    "net_component": """WITH RECURSIVE links AS (SELECT u AS a, v AS b FROM f_edges UNION ALL SELECT v, u FROM f_edges), closure AS (SELECT DISTINCT a AS n, a AS r FROM links UNION SELECT c.n, l.b FROM closure c JOIN links l ON l.a = c.r),
      label AS (SELECT n, MIN(r) AS c FROM closure GROUP BY n), big AS (SELECT c FROM label GROUP BY c HAVING COUNT(*) >= 100) SELECT ogc_fid FROM f_edges WHERE u IN (SELECT n FROM label JOIN big USING (c))""",
    "net_largest": f"WITH {HOMES} SELECT c_custkey AS ogc_fid FROM customer WHERE c_nationkey = (SELECT c_nationkey FROM homes ORDER BY n DESC, first LIMIT 1)",
    "net_neighbourhood": f"""WITH RECURSIVE {ADJ}, seeds AS (SELECT osmid AS node FROM f_nodes), {WALK.format(limit=1000)}, cells AS (SELECT DISTINCT d.src, CAST(FLOOR(n.y / 250) AS BIGINT) * 1000 + CAST(FLOOR(n.x / 250) AS BIGINT) AS grid_id FROM dists d JOIN f_nodes n ON n.osmid = d.node)
      SELECT src, ROUND(AVG(g.pop_est), 6) AS pop_est FROM cells JOIN f_grid g USING (grid_id) GROUP BY src""",
    "net_associate": f"WITH {KNN} SELECT dest_oid, ogc_fid AS edge_ogc_fid, n1, n2, n1_distance, n2_distance, ROUND(distance, 6) AS match_distance FROM pois",
    "net_seed_distance": f"WITH RECURSIVE {KNN}, {ADJ}, {SEEDS}, {WALK.format(limit=500)} SELECT src, node, dist FROM dists",
    "net_nearest_poi": f"WITH RECURSIVE {KNN}, {ADJ}, {SEEDS}, {WALK.format(limit=500)}, {NEAREST} SELECT * FROM nearest",
    "net_point_estimates": f"""WITH RECURSIVE {KNN}, {ADJ}, {SEEDS}, {WALK.format(limit=500)}, {NEAREST}, {_samples(30)},
      metrics AS (SELECT COALESCE(n.osmid, e.node) AS node, CASE WHEN n.osmid % 13 <> 0 THEN 500.0::DOUBLE + n.osmid % 900 END AS density, food, convenience FROM f_nodes n FULL JOIN nearest e ON e.node = n.osmid),
      spots AS (SELECT point_id, n1 AS node, 0.0::DOUBLE AS off, 1.0::DOUBLE AS w, TRUE AS whole FROM samples WHERE n1_distance = 0 UNION ALL SELECT point_id, n2, 0, 1, TRUE FROM samples WHERE n1_distance <> 0 AND n2_distance = 0
        UNION ALL SELECT point_id, n1, n1_distance, 1 - n1_distance / (n1_distance + n2_distance)::DOUBLE, FALSE FROM samples WHERE n1_distance <> 0 AND n2_distance <> 0
        UNION ALL SELECT point_id, n2, n2_distance, 1 - n2_distance / (n1_distance + n2_distance)::DOUBLE, FALSE FROM samples WHERE n1_distance <> 0 AND n2_distance <> 0)
      SELECT point_id, MIN(food + off) AS food, MIN(convenience + off) AS convenience, ROUND(CASE WHEN BOOL_OR(whole) THEN SUM(density * w) ELSE COALESCE(SUM(density * w), 0) END, 6) AS density FROM spots LEFT JOIN metrics USING (node) GROUP BY point_id""",
    "net_intersections": """WITH RECURSIVE deg AS (SELECT node FROM (SELECT u AS node FROM f_edges UNION ALL SELECT v FROM f_edges) GROUP BY node HAVING COUNT(*) >= 2),
      kept AS (SELECT osmid, x, y FROM f_nodes WHERE osmid IN (SELECT node FROM deg)), links AS (SELECT a.osmid AS a, b.osmid AS b FROM kept a JOIN kept b ON a.osmid <> b.osmid AND SQRT(POWER((a.x - b.x)::DOUBLE, 2) + POWER((a.y - b.y)::DOUBLE, 2)) <= 70),
      closure AS (SELECT osmid AS n, osmid AS r FROM kept UNION SELECT c.n, l.b FROM closure c JOIN links l ON l.a = c.r), label AS (SELECT n, MIN(r) AS component FROM closure GROUP BY n)
      SELECT component, COUNT(*) AS members, ROUND(AVG(x), 6) AS x, ROUND(AVG(y), 6) AS y FROM kept JOIN label ON n = osmid GROUP BY component""",
    "pos_candidates": f"""WITH {CANDIDATES}, ex AS (SELECT * FROM f_osm WHERE access IN ('private', 'no') OR landuse = 'military'),
      clipped AS (SELECT a.osm_id, GREATEST(a.xmin, b.xmin) AS xmin, GREATEST(a.ymin, b.ymin) AS ymin, LEAST(a.xmax, b.xmax) AS xmax, LEAST(a.ymax, b.ymax) AS ymax FROM cand a JOIN ex b ON {_overlap('a', 'b')} > 0), {union_area_sql('clipped', 'osm_id', 'TRUE')},
      cut AS (SELECT osm_id, ((xmax - xmin) * (ymax - ymin) - COALESCE(area, 0)) / 10000.0::DOUBLE AS area_ha FROM cand LEFT JOIN union_area USING (osm_id)) SELECT osm_id, ROUND(area_ha, 6) AS area_ha FROM cut WHERE area_ha > 0""",
    "pos_linear": f"WITH {SPACES}, {LINEARS} SELECT osm_id, water_feature, linear_tag, linear_feature, acceptable_linear_feature FROM linears",
    "pos_public": f"WITH {SPACES}, {LINEARS}, {PUBLIC} SELECT osm_id, public_access, within_public FROM public",
    "pos_clusters": f"WITH RECURSIVE {SPACES}, {LINEARS}, {PUBLIC}, {CLUSTERS} SELECT aos_id, aos_class, members, ROUND(aos_ha, 6) AS aos_ha, ROUND(aos_ha_public, 6) AS aos_ha_public, ROUND(aos_ha_water, 6) AS aos_ha_water, ROUND(COALESCE(100 * aos_ha_water / NULLIF(aos_ha, 0), 0), 6) AS water_percent FROM aos",
    "pos_roundness": "SELECT osm_id, ROUND((xmax - xmin) * (ymax - ymin) / (3.141592653589793::DOUBLE * ((xmax - xmin) * (xmax - xmin) + (ymax - ymin) * (ymax - ymin)) / 4), 6) AS roundness, ROUND(SQRT(((xmax - xmin) * (xmax - xmin) + (ymax - ymin) * (ymax - ymin))::DOUBLE), 6) AS diameter FROM f_osm",
    "pos_perimeter": f"WITH {RING.format(more='')} SELECT * FROM nodes20",
    "pos_access": f"WITH {RING.format(more='AND (xmax - xmin) * (ymax - ymin) > 15000')} SELECT osm_id, node FROM nodes20 p WHERE EXISTS (SELECT 1 FROM f_edges e WHERE GREATEST(e.ux, e.vx) >= p.x - 30 AND LEAST(e.ux, e.vx) <= p.x + 30 AND GREATEST(e.uy, e.vy) >= p.y - 30 AND LEAST(e.uy, e.vy) <= p.y + 30 AND ROUND(SQRT(POWER(e.ux + (e.vx - e.ux) * {T} - p.x, 2) + POWER(e.uy + (e.vy - e.uy) * {T} - p.y, 2)), 9) <= 30)",
    "polygon_overlap": f"SELECT a.osm_id, b.area_id, CAST({_overlap('a', 'b')} AS DOUBLE) AS shared, CAST((a.xmax - a.xmin) * (a.ymax - a.ymin) AS DOUBLE) AS own FROM f_osm a JOIN f_areas b ON {_overlap('a', 'b')} > 0",
}

QUERIES = {name: globals()[name] for name in SQL}
SQL = {name: with_views(sql) for name, sql in SQL.items()}
