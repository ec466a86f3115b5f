"""Queries on slanted lines and concave polygons: tags, distances, unions, cuts, open space, polylines."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanframe.functions import geometry as g
from urbanframe.operators import linear as ln
from urbanframe.operators import network as net
from urbanframe.operators import overlay as ov
from urbanframe.operators import parks as pk
from urbanframe.operators import places as pl
from urbanframe.operators import reports as rp
from urbanframe.operators import shapes as sh
from urbanframe.plans.fixtures import shape_union_sql, view, with_views
from urbanframe.plans.q_places import ADJ, CLASSES, KNN, RULES, SEEDS, WALK
from urbanframe.session import shuffled, spread

CELL = 200.0
LINE_TAGS = ["amenity", "leisure", "natural_tag", "tourism", "waterway"]
POINT_TAGS = ["amenity", "leisure", "natural_tag", "tourism", "historic"]


def _points(n: int):
    return F.array(*[g.make_point(F.col(f"x{i}"), F.col(f"y{i}")) for i in range(1, n + 1)])


def _parks(s, d):
    """Darts, every other one listed the other way round."""
    return spread(view(s, d, "f_parks").withColumn("polygon", F.array(F.when(F.col("osm_id") % 2 == 0, _points(4)).otherwise(F.reverse(_points(4))))), "osm_id")


def _ways(s, d):
    return spread(view(s, d, "f_ways").withColumn("shape", _points(3)), "way_id")


def _bends(s, d):
    return spread(view(s, d, "f_bends").withColumn("line", _points(3)), "ogc_fid")


def _nodes(s, d):
    return spread(view(s, d, "f_nodes").select("osmid", (F.col("x") + 0.37).alias("x"), (F.col("y") + 0.41).alias("y")), "osmid")


def _tagged_parks(s, d):
    ways = _ways(s, d)
    points = ways.withColumn("shape", g.make_point(F.col("x2"), F.col("y2")))
    found = sh.associate_tags(_parks(s, d), ways, "osm_id", "way_id", LINE_TAGS, CELL, "tags_line")
    return sh.associate_tags(found, points, "osm_id", "way_id", POINT_TAGS, CELL, "tags_point")


def pos_tags(s, d):
    """Tags of the lines and points that meet each park."""
    return _tagged_parks(s, d).select("osm_id", *[F.array_join(c, ",").alias(c) for c in ("tags_line", "tags_point")])


def shape_meet(s, d):
    """Ways and the parks that they meet."""
    return sh.meeting(_ways(s, d), _parks(s, d), "way_id", "osm_id", CELL, "shape", "polygon").toDF("way_id", "osm_id")


def shape_near(s, d):
    """Distances of ways and parks up to 40 m apart."""
    found = sh.near(_ways(s, d), _parks(s, d), "way_id", "osm_id", 40.0, CELL, "shape", "polygon")
    return found.toDF("way_id", "osm_id", "distance").withColumn("distance", F.round("distance", 6))


def shape_catchment(s, d):
    """People within 150 m of each park, places as areas that may overlap."""
    cells = view(s, d, "f_grid").select("grid_id", "pop_est", g.rectangle(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]).alias("polygon"))
    found = sh.near(_parks(s, d), cells, "osm_id", "grid_id", 150.0, 250.0, "polygon", "polygon").toDF("osm_id", "grid_id", "distance")
    return found.join(shuffled(cells.select("grid_id", "pop_est")), "grid_id").groupBy("osm_id").agg(F.sum("pop_est").alias("people"), F.count(F.lit(1)).alias("cells"))


def park_union(s, d):
    """Area of the union of each kind's parks, from the dissolved shapes."""
    kinds = _parks(s, d).select(F.coalesce("leisure", F.lit("none")).alias("kind"), "polygon")
    union, kind_of = ov.dissolve_clusters(kinds, "kind", CELL)
    sizes = union.shapes().groupBy("cluster").agg(F.sum(g.area(F.col("polygon"))).alias("area"))
    return sizes.join(kind_of, "cluster").groupBy("kind").agg(F.round(F.sum("area"), 4).alias("area"))


def park_union_area(s, d):
    """The same from the tiles' sums."""
    kinds = _parks(s, d).select(F.coalesce("leisure", F.lit("none")).alias("kind"), "polygon")
    return ov.dissolve(kinds, "kind", CELL).areas().select("kind", F.round("area", 4).alias("area"))


def _cut(s, d):
    parks = _parks(s, d)
    return pk.cut_out(pl.candidates(parks), pl.exclusions(parks), "osm_id", CELL)


def pos_cut(s, d):
    """Area of open spaces less exclusions, from the rings that are left."""
    return _cut(s, d).groupBy("osm_id").agg(F.round(F.sum(g.area(F.col("polygon"))) / 10000.0, 6).alias("area_ha"))


def pos_cut_nodes(s, d):
    """Nodes inside what is left of open spaces."""
    points = _nodes(s, d).withColumn("shape", g.make_point(F.col("x"), F.col("y")))
    return sh.meeting(points, _cut(s, d), "osmid", "osm_id", CELL, "shape", "polygon").toDF("osmid", "osm_id")


def area_clip(s, d):
    """Areas clipped to the parks' union: what is left of each, and dwellings by that area; none left drops out."""
    corner = [g.make_point(F.col(x), F.col(y)) for x, y in (("xmin", "ymin"), ("xmax", "ymin"), ("xmin", "ymax"))]
    areas = view(s, d, "f_areas").withColumn("polygon", F.array(F.array(*corner)))
    left = ov.clip(areas, _parks(s, d), "area_id", CELL).areas()
    return areas.join(left, "area_id").select("area_id", F.round("area", 4).alias("area"), F.round(F.col("dwellings") / (F.col("area") / 10000.0), 6).alias("per_ha"))


def _flagged(s, d):
    """Open spaces with all flags, their polygons, and their overlaps."""
    # Written, as many steps read them: else each would read the tables and find the circles anew.
    parks = pk.written(pl.candidates(_parks(s, d)))
    parts = parks.select("osm_id", F.lit(1).alias("part"), "polygon")
    spaces = pk.written(pl.water_linear(parks.drop("polygon").join(shuffled(pk.measured(parts, "osm_id")), "osm_id")))
    found = pk.written(pk.overlaps(parts, "osm_id", CELL))
    spaces = pk.written(pk.acceptable_linear(spaces, parts, found, "osm_id", CELL))
    return pk.written(pl.public_access(spaces, "osm_id", CELL, pk.covering(found, spaces, "osm_id"))), parts


def pos_shape_flags(s, d):
    """Size, linear, water and access flags of open spaces by their shapes."""
    spaces, _ = _flagged(s, d)
    return spaces.select("osm_id", *[F.round(c, 6).alias(c) for c in ("area_ha", "diameter", "roundness")], "water_feature", "linear_tag", "linear_feature", "acceptable_linear_feature", "public_access", "within_public")


def _areas(s, d):
    spaces, parts = _flagged(s, d)
    tags = F.to_json(F.struct("leisure", "natural_tag", "waterway"))
    return pk.OpenSpaceAreas(spaces.withColumn("tags", tags), parts, "osm_id", CELL)


def pos_shape_areas(s, d):
    """Clusters of adjacent open spaces: dissolved areas by access and water, members' tags."""
    found = _areas(s, d).areas().withColumn("attributes", F.array_join("attributes", ";"))
    return found.select("aos_id", "aos_class", "members", *[F.round(c, 6).alias(c) for c in ("aos_ha", "aos_ha_public", "aos_ha_not_public", "aos_ha_water", "water_percent")], "has_water_feature", "attributes")


def pos_shape_outline(s, d):
    """Nodes every 20 m around parks, with their fraction of the outline."""
    shapes = view(s, d, "f_parks").select("osm_id", F.lit(1).alias("part"), F.array(_points(4)).alias("polygon"))
    return pk.outline_nodes(shapes, "osm_id").select("osm_id", "node", *[F.round(c, 6).alias(c) for c in ("fraction", "x", "y")])


def _outlined(s, d):
    return spread(view(s, d, "f_parks").select("osm_id", F.lit(1).alias("part"), F.array(_points(4)).alias("polygon")), "osm_id")


def _access(s, d, least: float):
    shapes = _outlined(s, d)
    areas = shapes.select("osm_id", (g.extent(F.col("polygon")) / 10000.0).alias("aos_ha_public"))
    return pk.access_nodes(shapes, areas, _bends(s, d), "osm_id", least)


def pos_shape_access(s, d):
    """Outline nodes within 30 m of the network, of areas of any size."""
    return _access(s, d, 0.001).select("osm_id", "node")


def pos_large_access(s, d):
    """The same of large areas only."""
    return _access(s, d, 1.5).select("osm_id", "node")


def _green(s, d):
    value = F.when(F.col("osmid") % 17 == 0, -9999.0).otherwise((F.col("osmid") * 37 % 200) / 100.0 - 0.6)
    pixels = _nodes(s, d).withColumn("value", value)
    shapes = _parks(s, d).select("osm_id", "polygon")
    areas = shapes.select("osm_id", (g.extent(F.col("polygon")) / 10000.0).alias("aos_ha_public"))
    return pk.green_areas(areas, shapes, pixels, "osm_id")


def green_areas(s, d):
    """Areas of at least 1 ha with a mean index of at least 0.2."""
    return _green(s, d).select("osm_id", F.round("aos_ha_public", 6).alias("aos_ha_public"), F.round("ndvi_mean", 6).alias("ndvi_mean"))


def green_access(s, d):
    """Access nodes of green areas."""
    return pk.green_access(_outlined(s, d), _green(s, d), _bends(s, d), "osm_id").select("osm_id", "node")


def sample_bends(s, d):
    """Points every 30 m along bent edges, with offsets from both ends."""
    return ln.sample_polylines(_bends(s, d)).withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


def net_associate_bends(s, d):
    """Destinations on the nearest bent edge: offsets along it and the match point."""
    found = ln.associate_polylines(view(s, d, "f_destinations"), _bends(s, d), "dest_oid")
    return found.select("dest_oid", "edge_ogc_fid", "n1", "n2", "n1_distance", "n2_distance", *[F.round(c, 6).alias(c) for c in ("match_distance", "mx", "my")])


def in_both(s, d):
    """Nodes inside an area and a park at once."""
    corner = [g.make_point(F.col(x), F.col(y)) for x, y in (("xmin", "ymin"), ("xmax", "ymin"), ("xmin", "ymax"))]
    areas = view(s, d, "f_areas").withColumn("polygon", F.array(F.array(*corner)))
    return sh.in_all(_nodes(s, d), [areas, _parks(s, d)], "osmid", CELL).select("osmid")


def custom_areas(s, d):
    """A configured layer (parks of one kind) in place of tagged open space, where it meets the study region."""
    region = view(s, d, "f_areas").select(g.rectangle(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]).alias("polygon"))
    found = pk.open_space_areas({"data": "parks", "where": "leisure = 'garden'"}, {"parks": _parks(s, d)}, region, lambda: _parks(s, d), "osm_id", 400.0)
    return found.select("osm_id", F.round("aos_ha_public", 6).alias("aos_ha_public"))


KNOWN = {"convenience": ("Convenience shop", "Food"), "fresh_food_market": ("Fresh food or market", "Food")}
POIS = {
    "convenience": {"data": "shops", "replace": True},
    "fresh_food_market": {"data": "markets", "domain": "not used"},
    "garden": {"data": "gardens", "dest_name_full": "Garden", "domain": "Green"},
    "stop": {"data": "stops"},
    "school": {"data": None, "replace": True},
}


def _pois(s, d):
    tagged = pl.destinations(view(s, d, "f_destinations").where("FALSE").select(F.col("dest_oid").alias("osm_id"), "dest_name", "x", "y"), pl.classify_tags(view(s, d, "f_osm"), RULES))
    own = view(s, d, "f_destinations")
    layers = {"shops": own.where("dest_name = 'convenience'"), "markets": own.where("dest_name = 'fresh_food_market'"), "stops": own.where("dest_name = 'pt_any'"), "gardens": _parks(s, d).where("leisure = 'garden'")}
    known = s.createDataFrame([(k, *v) for k, v in KNOWN.items()], "dest_name string, dest_full_name string, domain string")
    return pl.configured_pois(tagged, POIS, layers, known)


def dest_pois(s, d):
    """Types of destinations after own points of interest replaced or joined those from tags."""
    return _pois(s, d)[1]


def dest_poi_places(s, d):
    """The destinations themselves, polygons by their centroid."""
    found, _ = _pois(s, d)
    return found.select("osm_id", "dest_name", "dest_name_full", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def dest_origins(s, d):
    """Destinations within 500 m of the areas, by type and by whether they come from tags."""
    return pl.counts_near(_pois(s, d)[0], view(s, d, "f_areas"), 500.0, 800.0)


def net_headway_poi(s, d):
    """Distances to the nearest stop of any headway and of at most 30 and 20 minutes."""
    stops = view(s, d, "f_destinations").withColumn("headway", F.when(F.col("dest_oid") % 11 != 0, F.col("dest_oid") * 7 % 61))
    pois = stops.join(net.associate(stops, _straight(s, d), "dest_oid"), "dest_oid")
    conditions = {"any": F.col("headway") >= 0, "within_30": F.col("headway") <= 30, "within_20": F.col("headway") <= 20}
    return net.nearest_poi(net.reach_by_tile(view(s, d, "f_edges"), net.seed_nodes([pois]), 500), pois, conditions)


def _straight(s, d):
    return view(s, d, "f_edges").withColumn("line", F.array(g.make_point(F.col("ux"), F.col("uy")), g.make_point(F.col("vx"), F.col("vy"))))


def report_sorted(s, d):
    """Destinations per place type and district in order, with their position."""
    found = view(s, d, "f_destinations").groupBy(F.floor(F.col("y") / 1000).cast("bigint").alias("district"), "dest_name").agg(F.count(F.lit(1)).alias("count"))
    return rp.sort_report(found, ["district", "dest_name"])


def net_discs(s, d):
    """Intersections at the centroid of their merged discs."""
    found = net.consolidate_discs(view(s, d, "f_nodes"), view(s, d, "f_edges"), 49.0)
    return found.select("component", "members", *[F.round(c, 4).alias(c) for c in ("area", "x", "y")])


# -- SQL ----------------------------------------------------------------------


def _edges_sql(name: str, table: str, key: str, n: int, closed: bool = True, more: str = "") -> str:
    steps = [(i, i % n + 1) for i in range(1, n + (1 if closed else 0))]
    rows = " UNION ALL ".join(f"SELECT {key}, {i} AS pos, x{i} AS ax, y{i} AS ay, x{j} AS bx, y{j} AS by_{more} FROM {table}" for i, j in steps)
    return f"{name} AS ({rows})"


def _in(p: str, k: str, n: int = 4) -> str:
    one = [f"CASE WHEN ({k}.y{i} > {p}.y) <> ({k}.y{j} > {p}.y) AND {p}.x < ({k}.x{j} - {k}.x{i}) * ({p}.y - {k}.y{i})::DOUBLE / ({k}.y{j} - {k}.y{i}) + {k}.x{i} THEN 1 ELSE 0 END" for i, j in ((i, i % n + 1) for i in range(1, n + 1))]
    return f"(({' + '.join(one)}) % 2 = 1)"


def _side(a: str, b: str, end: str) -> str:
    x, y = ("ax", "ay") if end == "a" else ("bx", "by_")
    return f"SIGN(({a}.bx - {a}.ax) * ({b}.{y} - {a}.ay) - ({a}.by_ - {a}.ay) * ({b}.{x} - {a}.ax))"


def _reach(a: str, b: str, d: int = 0) -> str:
    return " AND ".join(f"GREATEST({a}.a{c}, {a}.b{e}) + {d} >= LEAST({b}.a{c}, {b}.b{e}) AND GREATEST({b}.a{c}, {b}.b{e}) + {d} >= LEAST({a}.a{c}, {a}.b{e})" for c, e in (("x", "x"), ("y", "y_")))


def _meets(a: str, b: str) -> str:
    return f"({_reach(a, b)} AND {_side(a, b, 'a')} * {_side(a, b, 'b')} <= 0 AND {_side(b, a, 'a')} * {_side(b, a, 'b')} <= 0)"


def _off(p: str, end: str, s: str) -> str:
    x, y = ("ax", "ay") if end == "a" else ("bx", "by_")
    t = f"GREATEST(0.0::DOUBLE, LEAST(1.0::DOUBLE, (({p}.{x} - {s}.ax) * ({s}.bx - {s}.ax) + ({p}.{y} - {s}.ay) * ({s}.by_ - {s}.ay))::DOUBLE / NULLIF(({s}.bx - {s}.ax) * ({s}.bx - {s}.ax) + ({s}.by_ - {s}.ay) * ({s}.by_ - {s}.ay), 0)))"
    return f"(POWER({p}.{x} - {s}.ax - {t} * ({s}.bx - {s}.ax), 2) + POWER({p}.{y} - {s}.ay - {t} * ({s}.by_ - {s}.ay), 2))"


def _distance(a: str, b: str) -> str:
    return f"CASE WHEN {_meets(a, b)} THEN 0.0::DOUBLE ELSE SQRT(LEAST({_off(a, 'a', b)}, {_off(a, 'b', b)}, {_off(b, 'a', a)}, {_off(b, 'b', a)})) END"


def _json(columns: list[str]) -> str:
    parts = [f"CASE WHEN {c} IS NOT NULL THEN '\"{c}\":\"' || {c} || '\"' END" for c in columns]
    return "'{' || CONCAT_WS(',', " + ", ".join(parts) + ") || '}'"


def _area(n: int = 4) -> str:
    return "ABS(" + " + ".join(f"(x{i} * y{j} - x{j} * y{i})" for i, j in ((i, i % n + 1) for i in range(1, n + 1))) + ") / 2.0::DOUBLE"


PE = _edges_sql("pe", "f_parks", "osm_id", 4)
WE = _edges_sql("we", "f_ways", "way_id", 3, False)
FIRST = "firsts AS (SELECT way_id, x1 AS x, y1 AS y FROM f_ways)"
MET = f"met AS (SELECT w.way_id, p.osm_id FROM we w JOIN pe p ON {_meets('w', 'p')} UNION SELECT w.way_id, k.osm_id FROM firsts w JOIN f_parks k ON {_in('w', 'k')})"
CAND = "cand AS (SELECT * FROM f_parks WHERE leisure IS NOT NULL OR landuse = 'forest' OR boundary = 'national_park' OR place = 'square' OR highway = 'pedestrian')"
GONE = "gone AS (SELECT * FROM f_parks WHERE access IN ('private', 'no') OR landuse = 'military')"
NODES = "spots AS (SELECT osmid, x + 0.37::DOUBLE AS x, y + 0.41::DOUBLE AS y FROM f_nodes)"
TRIANGLES = "tri AS (SELECT area_id, dwellings, xmin AS x1, ymin AS y1, xmax AS x2, ymin AS y2, xmin AS x3, ymax AS y3 FROM f_areas)"
SIZED = f"""side AS (SELECT *, {_area()} AS area, {_area(3)} AS hull, SQRT(POWER(x1 - x2, 2) + POWER(y1 - y2, 2)) AS sa, SQRT(POWER(x2 - x3, 2) + POWER(y2 - y3, 2)) AS sb, SQRT(POWER(x3 - x1, 2) + POWER(y3 - y1, 2)) AS sc FROM cand),
sized AS (SELECT *, CASE WHEN 2 * POWER(GREATEST(sa, sb, sc), 2) >= sa * sa + sb * sb + sc * sc THEN GREATEST(sa, sb, sc) ELSE sa * sb * sc / (2 * hull) END AS diameter FROM side),
spaces AS (SELECT *, area / 10000.0::DOUBLE AS area_ha, 4 * area / (3.141592653589793::DOUBLE * diameter * diameter) AS roundness, COALESCE(natural_tag = 'water', FALSE) OR COALESCE(sport = 'canoe', FALSE) OR waterway IS NOT NULL AS water_feature, CASE WHEN waterway IN ('canal', 'drain') THEN TRUE END AS linear_tag,
  waterway IS NOT NULL OR (area / 10000.0::DOUBLE > 0.5 AND 4 * area / (3.141592653589793::DOUBLE * diameter * diameter) < 0.25) AS linear_feature FROM sized)"""
_BOXES = "LEAST(a.x1, a.x4) < b.x2 AND LEAST(b.x1, b.x4) < a.x2 AND a.y1 < b.y3 AND b.y1 < a.y3"
PAIRS = f"""{_edges_sql('ce', 'spaces', 'osm_id', 4)}, pairs AS (SELECT a.osm_id AS a, b.osm_id AS b, a.area AS area_a, b.area AS area_b FROM spaces a JOIN spaces b ON a.osm_id < b.osm_id AND {_BOXES}),
duo AS (SELECT p.a || ':' || p.b AS k, e.osm_id AS id, e.ax, e.ay, e.bx, e.by_ FROM pairs p JOIN ce e ON e.osm_id = p.a OR e.osm_id = p.b), {shape_union_sql("duo", "joint")},
half AS (SELECT a, b, area_a + area_b - j.area AS shared FROM pairs p JOIN joint j ON j.k = p.a || ':' || p.b WHERE area_a + area_b - j.area > 1e-6), shares AS (SELECT * FROM half UNION ALL SELECT b, a, shared FROM half)"""
FLAGS = f"""good AS (SELECT s.a AS osm_id FROM shares s JOIN spaces a ON a.osm_id = s.a JOIN spaces b ON b.osm_id = s.b WHERE a.linear_feature AND ((NOT b.linear_feature AND (s.shared >= a.area * (1 - 1e-9) OR (a.diameter < 800 AND s.shared / a.area > 0.2))) OR (a.diameter < 800 AND s.shared / 10000.0::DOUBLE > 0.4))),
tagged AS (SELECT *, CASE WHEN linear_feature THEN osm_id IN (SELECT osm_id FROM good) END AS acceptable_linear_feature, NOT COALESCE(amenity = 'school', FALSE) AND NOT COALESCE(leisure IN ('pitch', 'garden'), FALSE) AND NOT COALESCE(natural_tag IN ('wood', 'water'), FALSE) AND NOT COALESCE(access IN ('private', 'no'), FALSE)
  AND NOT COALESCE(sport = 'archery', FALSE) AND golf IS NULL AND NOT water_feature AS pa FROM spaces),
cover AS (SELECT s.a AS i, s.b AS o FROM shares s JOIN spaces a ON a.osm_id = s.a WHERE s.shared >= a.area * (1 - 1e-9)),
inside AS (SELECT *, osm_id IN (SELECT i FROM cover JOIN tagged t ON t.osm_id = o AND t.pa) AS within_public FROM tagged),
once AS (SELECT * REPLACE (pa AND osm_id NOT IN (SELECT i FROM cover JOIN inside t ON t.osm_id = o AND NOT t.pa) AS pa) FROM inside),
flagged AS (SELECT * EXCLUDE (pa), pa AND osm_id NOT IN (SELECT i FROM cover JOIN once t ON t.osm_id = o AND NOT t.pa AND NOT t.within_public) AS public_access FROM once)"""
AREAS = f"""classed AS (SELECT *, CASE WHEN COALESCE(linear_tag, FALSE) THEN 4 WHEN (public_access OR within_public) AND (NOT linear_feature OR COALESCE(acceptable_linear_feature, FALSE)) THEN 1 WHEN NOT public_access AND NOT within_public THEN 2 WHEN public_access AND linear_feature THEN 3 END AS aos_class FROM flagged),
touch AS (SELECT p.osm_id AS a, q.osm_id AS b FROM ce p JOIN ce q ON p.osm_id <> q.osm_id AND {_meets('p', 'q')} UNION SELECT a, b FROM shares),
links AS (SELECT t.a, t.b FROM touch t JOIN classed a ON a.osm_id = t.a JOIN classed b ON b.osm_id = t.b AND a.aos_class = b.aos_class AND a.aos_class <= 2),
closure AS (SELECT osm_id AS n, osm_id AS r FROM classed WHERE aos_class IS NOT NULL UNION SELECT c.n, l.b FROM closure c JOIN links l ON l.a = c.r),
label AS (SELECT n, MIN(r) AS aos_id FROM closure GROUP BY n),
member AS (SELECT c.*, l.aos_id, {_json(['leisure', 'natural_tag', 'waterway'])} AS tags FROM classed c JOIN label l ON l.n = c.osm_id),
layered AS (SELECT m.aos_id || ':' || layer AS k, m.osm_id AS id, e.ax, e.ay, e.bx, e.by_ FROM (SELECT *, UNNEST(['all', CASE WHEN public_access THEN 'public' ELSE 'not_public' END, CASE WHEN water_feature THEN 'water' END]) AS layer FROM member) m JOIN ce e USING (osm_id) WHERE layer IS NOT NULL),
{shape_union_sql('layered', 'merged')},
sums AS (SELECT aos_id, MIN(aos_class) AS aos_class, COUNT(*) AS members, STRING_AGG(tags, ';' ORDER BY tags) AS attributes, BOOL_OR(water_feature OR osm_id IN (SELECT t.a FROM touch t JOIN spaces w ON w.osm_id = t.b AND w.water_feature)) AS has_water_feature FROM member GROUP BY aos_id),
ha AS (SELECT CAST(SPLIT_PART(k, ':', 1) AS BIGINT) AS aos_id, """ + ", ".join(f"COALESCE(SUM(CASE WHEN SPLIT_PART(k, ':', 2) = '{layer}' THEN area END), 0) / 10000.0::DOUBLE AS {name}" for name, layer in (("aos_ha", "all"), ("aos_ha_public", "public"), ("aos_ha_not_public", "not_public"), ("aos_ha_water", "water"))) + " FROM merged GROUP BY 1)"
OUTLINE = """ring AS (SELECT osm_id, pos, ax, ay, bx, by_, SQRT(POWER(bx - ax, 2) + POWER(by_ - ay, 2)) AS l FROM pe),
sums20 AS (SELECT *, SUM(l) OVER (PARTITION BY osm_id ORDER BY pos) AS stop FROM ring), run AS (SELECT *, COALESCE(LAG(stop) OVER (PARTITION BY osm_id ORDER BY pos), 0) AS start, MAX(stop) OVER (PARTITION BY osm_id) AS whole FROM sums20),
step AS (SELECT osm_id, whole, UNNEST(RANGE(0, CAST(FLOOR(whole / 20) AS BIGINT) + 1)) AS i FROM (SELECT DISTINCT osm_id, whole FROM run)),
outline AS (SELECT s.osm_id, CAST(s.i + 1 AS INT) AS node, s.i * 20 / s.whole AS fraction, r.ax + (r.bx - r.ax) * (s.i * 20 - r.start) / r.l AS x, r.ay + (r.by_ - r.ay) * (s.i * 20 - r.start) / r.l AS y FROM step s JOIN run r ON r.osm_id = s.osm_id AND s.i * 20 >= r.start AND s.i * 20 < r.stop)"""
BE = _edges_sql("be", "f_bends", "ogc_fid", 3, False, ", u, v")
_SPOT = "SELECT osm_id, node, x AS ax, y AS ay, x AS bx, y AS by_ FROM outline"
ACCESS = f"sized AS (SELECT osm_id, {_area()} / 10000.0::DOUBLE AS ha FROM f_parks), access AS (SELECT DISTINCT p.osm_id, p.node, s.ha FROM ({_SPOT}) p JOIN sized s USING (osm_id) JOIN be e ON {_reach('p', 'e', 30)} AND SQRT({_off('p', 'a', 'e')}) <= 30 WHERE s.ha > 0.001)"
GREEN = f"green AS (SELECT k.osm_id, {_area().replace('x', 'k.x').replace('y', 'k.y')} / 10000.0::DOUBLE AS ha, AVG(p.value) AS m FROM f_parks k JOIN (SELECT *, (osmid * 37 % 200) / 100.0::DOUBLE - 0.6::DOUBLE AS value FROM spots WHERE osmid % 17 <> 0) p ON {_in('p', 'k')} WHERE p.value BETWEEN -1 AND 1 GROUP BY ALL HAVING AVG(p.value) >= 0.2 AND ha >= 1)"
BENT = """part AS (SELECT *, SQRT(POWER(bx - ax, 2) + POWER(by_ - ay, 2)) AS l FROM be), bent AS (SELECT *, SUM(l) OVER (PARTITION BY ogc_fid ORDER BY pos) - l AS start, SUM(l) OVER (PARTITION BY ogc_fid) AS whole FROM part)"""

SQL = {
    "pos_tags": f"""WITH {PE}, {WE}, {FIRST}, {MET}, lines AS (SELECT osm_id, STRING_AGG(DISTINCT t, ',' ORDER BY t) AS tags_line FROM met JOIN (SELECT way_id, {_json(LINE_TAGS)} AS t FROM f_ways) USING (way_id) WHERE t <> '{{}}' GROUP BY osm_id),
      dots AS (SELECT way_id, {_json(POINT_TAGS)} AS t, x2 AS x, y2 AS y, x2 AS ax, y2 AS ay, x2 AS bx, y2 AS by_ FROM f_ways),
      hits AS (SELECT d.way_id, k.osm_id FROM dots d JOIN f_parks k ON {_in('d', 'k')} UNION SELECT d.way_id, p.osm_id FROM dots d JOIN pe p ON {_meets('d', 'p')}),
      points AS (SELECT osm_id, STRING_AGG(DISTINCT t, ',' ORDER BY t) AS tags_point FROM hits JOIN dots USING (way_id) WHERE t <> '{{}}' GROUP BY osm_id) SELECT osm_id, tags_line, tags_point FROM f_parks LEFT JOIN lines USING (osm_id) LEFT JOIN points USING (osm_id)""",
    "shape_meet": f"WITH {PE}, {WE}, {FIRST}, {MET} SELECT way_id, osm_id FROM met",
    "shape_near": f"WITH {PE}, {WE}, {FIRST}, each AS (SELECT w.way_id, p.osm_id, {_distance('w', 'p')} AS distance FROM we w JOIN pe p ON {_reach('w', 'p', 40)} UNION ALL SELECT w.way_id, k.osm_id, 0 FROM firsts w JOIN f_parks k ON {_in('w', 'k')}) SELECT way_id, osm_id, ROUND(MIN(distance), 6) AS distance FROM each WHERE distance <= 40 GROUP BY way_id, osm_id",
    "shape_catchment": f"""WITH {PE}, box AS (SELECT grid_id, pop_est, xmin AS x1, ymin AS y1, xmax AS x2, ymin AS y2, xmax AS x3, ymax AS y3, xmin AS x4, ymax AS y4 FROM f_grid), {_edges_sql('ge', 'box', 'grid_id', 4)},
      each AS (SELECT p.osm_id, e.grid_id FROM pe p JOIN ge e ON {_reach('p', 'e', 150)} WHERE {_distance('p', 'e')} <= 150 UNION SELECT k.osm_id, b.grid_id FROM (SELECT *, x1 AS x, y1 AS y FROM f_parks) k JOIN box b ON {_in('k', 'b')} UNION SELECT k.osm_id, b.grid_id FROM (SELECT *, x1 AS x, y1 AS y FROM box) b JOIN f_parks k ON {_in('b', 'k')})
      SELECT osm_id, CAST(SUM(pop_est) AS BIGINT) AS people, COUNT(*) AS cells FROM each JOIN f_grid USING (grid_id) GROUP BY osm_id""",
    "park_union": f"WITH {PE}, kinds AS (SELECT COALESCE(leisure, 'none') AS k, osm_id AS id, ax, ay, bx, by_ FROM pe JOIN f_parks USING (osm_id)), {shape_union_sql('kinds', 'merged')} SELECT k AS kind, ROUND(area, 4) AS area FROM merged",
    "pos_cut": f"""WITH {PE}, {CAND}, {GONE}, near AS (SELECT a.osm_id AS own, b.osm_id FROM cand a JOIN gone b ON {_BOXES}), sets AS (SELECT own || ':both' AS k, osm_id AS id FROM near UNION ALL SELECT DISTINCT own || ':both', own + 0.5 FROM near UNION ALL SELECT own || ':gone', osm_id FROM near),
      lines AS (SELECT k, id, ax, ay, bx, by_ FROM sets JOIN pe ON pe.osm_id = CAST(FLOOR(id) AS BIGINT)), {shape_union_sql('lines', 'merged')},
      gap AS (SELECT CAST(SPLIT_PART(k, ':', 1) AS BIGINT) AS osm_id, SUM(CASE WHEN k LIKE '%both' THEN area ELSE -area END) AS rest FROM merged GROUP BY 1)
      SELECT osm_id, ROUND(COALESCE(rest, {_area()}) / 10000.0::DOUBLE, 6) AS area_ha FROM cand LEFT JOIN gap USING (osm_id) WHERE COALESCE(rest, 1) > 1e-6""",
    "pos_cut_nodes": f"WITH {CAND}, {GONE}, {NODES} SELECT p.osmid, k.osm_id FROM spots p JOIN cand k ON {_in('p', 'k')} WHERE NOT EXISTS (SELECT 1 FROM gone x WHERE {_in('p', 'x')})",
    "area_clip": f"""WITH {PE}, {TRIANGLES}, {_edges_sql('te', 'tri', 'area_id', 3)}, sets AS (SELECT area_id, osm_id FROM tri t JOIN f_parks b ON t.x1 < b.x2 AND b.x1 < t.x2 AND t.y1 < b.y3 AND b.y1 < t.y3),
      lines AS (SELECT area_id || ':both' AS k, osm_id AS id, ax, ay, bx, by_ FROM sets JOIN pe USING (osm_id) UNION ALL SELECT area_id || ':both', -1, ax, ay, bx, by_ FROM te WHERE area_id IN (SELECT area_id FROM sets) UNION ALL SELECT area_id || ':rest', osm_id, ax, ay, bx, by_ FROM sets JOIN pe USING (osm_id)), {shape_union_sql('lines', 'merged')},
      gap AS (SELECT CAST(SPLIT_PART(k, ':', 1) AS BIGINT) AS area_id, SUM(CASE WHEN k LIKE '%both' THEN area ELSE -area END) AS outer_part FROM merged GROUP BY 1), left_over AS (SELECT area_id, dwellings, {_area(3)} - outer_part AS area FROM tri JOIN gap USING (area_id))
      SELECT area_id, ROUND(area, 4) AS area, ROUND(dwellings / (area / 10000.0::DOUBLE), 6) AS per_ha FROM left_over WHERE area > 1e-6""",
    "pos_shape_flags": f"WITH {CAND}, {SIZED}, {PAIRS}, {FLAGS} SELECT osm_id, ROUND(area_ha, 6) AS area_ha, ROUND(diameter, 6) AS diameter, ROUND(roundness, 6) AS roundness, water_feature, linear_tag, linear_feature, acceptable_linear_feature, public_access, within_public FROM flagged",
    "pos_shape_areas": f"WITH RECURSIVE {CAND}, {SIZED}, {PAIRS}, {FLAGS}, {AREAS} SELECT aos_id, CAST(aos_class AS INT) AS aos_class, members, ROUND(aos_ha, 6) AS aos_ha, ROUND(aos_ha_public, 6) AS aos_ha_public, ROUND(aos_ha_not_public, 6) AS aos_ha_not_public, ROUND(aos_ha_water, 6) AS aos_ha_water, ROUND(100 * aos_ha_water / aos_ha, 6) AS water_percent, has_water_feature, attributes FROM sums JOIN ha USING (aos_id)",
    "pos_shape_outline": f"WITH {PE}, {OUTLINE} SELECT osm_id, node, ROUND(fraction, 6) AS fraction, ROUND(x, 6) AS x, ROUND(y, 6) AS y FROM outline",
    "pos_shape_access": f"WITH {PE}, {OUTLINE}, {BE}, {ACCESS} SELECT osm_id, node FROM access",
    "pos_large_access": f"WITH {PE}, {OUTLINE}, {BE}, {ACCESS} SELECT osm_id, node FROM access WHERE ha > 1.5",
    "green_areas": f"WITH {NODES}, {GREEN} SELECT osm_id, ROUND(ha, 6) AS aos_ha_public, ROUND(m, 6) AS ndvi_mean FROM green",
    "green_access": f"WITH {PE}, {OUTLINE}, {BE}, {ACCESS}, {NODES}, {GREEN} SELECT osm_id, node FROM access WHERE osm_id IN (SELECT osm_id FROM green)",
    "sample_bends": f"""WITH {BE}, {BENT}, steps AS (SELECT ogc_fid, u, v, whole, UNNEST(RANGE(0, CAST(ROUND_EVEN(whole, 0) AS BIGINT) + 1, 30)) AS m FROM bent WHERE pos = 1),
      spot AS (SELECT s.*, LEAST(s.m, s.whole) AS b, e.ax, e.ay, e.bx, e.by_, LEAST(1.0::DOUBLE, (s.m - e.start) / e.l) AS t FROM steps s JOIN bent e ON e.ogc_fid = s.ogc_fid AND s.m >= e.start AND (s.m < e.start + e.l OR e.pos = 2))
      SELECT ogc_fid AS edge_ogc_fid, CAST(m AS INT) AS metres, u AS n1, v AS n2, CAST(ROUND_EVEN(b, 0) AS INT) AS n1_distance, CAST(ROUND_EVEN(whole - b, 0) AS INT) AS n2_distance, ROUND(ax + (bx - ax) * t, 6) AS x, ROUND(ay + (by_ - ay) * t, 6) AS y FROM spot""",
    "net_associate_bends": f"""WITH {BE}, {BENT}, places AS (SELECT p.dest_oid, p.x, p.y, e.*, GREATEST(0.0::DOUBLE, LEAST(1.0::DOUBLE, ((p.x - e.ax) * (e.bx - e.ax) + (p.y - e.ay) * (e.by_ - e.ay)) / (e.l * e.l))) AS t FROM f_destinations p CROSS JOIN bent e),
      met AS (SELECT *, ax + (bx - ax) * t AS mx, ay + (by_ - ay) * t AS my, start + l * t AS before FROM places), far AS (SELECT *, SQRT(POWER(mx - x, 2) + POWER(my - y, 2)) AS distance FROM met),
      best AS (SELECT * FROM far QUALIFY ROW_NUMBER() OVER (PARTITION BY dest_oid ORDER BY ROUND(distance, 9), ogc_fid, pos) = 1)
      SELECT dest_oid, ogc_fid AS edge_ogc_fid, u AS n1, v AS n2, CAST(ROUND_EVEN(before, 0) AS INT) AS n1_distance, CAST(ROUND_EVEN(GREATEST(0, whole - before), 0) AS INT) AS n2_distance, ROUND(distance, 6) AS match_distance, ROUND(mx, 6) AS mx, ROUND(my, 6) AS my FROM best""",
    "in_both": f"WITH {NODES}, {TRIANGLES} SELECT osmid FROM spots p WHERE EXISTS (SELECT 1 FROM tri t WHERE {_in('p', 't', 3)}) AND EXISTS (SELECT 1 FROM f_parks k WHERE {_in('p', 'k')})",
    "custom_areas": f"""WITH {PE}, box AS (SELECT area_id, xmin AS x1, ymin AS y1, xmax AS x2, ymin AS y2, xmax AS x3, ymax AS y3, xmin AS x4, ymax AS y4 FROM f_areas), {_edges_sql('ge', 'box', 'area_id', 4)}, hit AS (SELECT p.osm_id FROM pe p JOIN ge e ON {_meets('p', 'e')} UNION SELECT k.osm_id FROM (SELECT *, x1 AS x, y1 AS y FROM f_parks) k JOIN box b ON {_in('k', 'b')})
      SELECT osm_id, ROUND({_area()} / 10000.0::DOUBLE, 6) AS aos_ha_public FROM f_parks WHERE leisure = 'garden' AND osm_id IN (SELECT osm_id FROM hit)""",
}
SQL["dest_pois"] = f"""WITH {CLASSES}, alls AS (SELECT dest_name FROM classes WHERE dest_name NOT IN ('convenience', 'school') UNION ALL SELECT CASE dest_name WHEN 'pt_any' THEN 'stop' ELSE dest_name END FROM f_destinations UNION ALL SELECT 'garden' FROM f_parks WHERE leisure = 'garden')
  SELECT dest_name, CASE dest_name WHEN 'convenience' THEN 'Convenience shop' WHEN 'fresh_food_market' THEN 'Fresh food or market' WHEN 'garden' THEN 'Garden' ELSE dest_name END AS dest_name_full, CASE dest_name WHEN 'garden' THEN 'Green' WHEN 'stop' THEN 'Custom' ELSE 'Food' END AS domain, COUNT(*) AS count FROM alls GROUP BY ALL"""
_CENTRE = ", ".join("ROUND((" + " + ".join(f"({c}{i} + {c}{j}) * (x{i} * y{j} - x{j} * y{i})" for i, j in ((1, 2), (2, 3), (3, 4), (4, 1))) + ")::DOUBLE / (3 * (" + " + ".join(f"(x{i} * y{j} - x{j} * y{i})" for i, j in ((1, 2), (2, 3), (3, 4), (4, 1))) + f")), 6) AS {c}" for c in "xy")
SQL["dest_poi_places"] = f"""WITH {CLASSES}, alls AS (SELECT CAST(osm_id AS VARCHAR) AS osm_id, dest_name, (xmin + xmax) / 2::DOUBLE AS x, (ymin + ymax) / 2::DOUBLE AS y FROM classes WHERE dest_name NOT IN ('convenience', 'school') UNION ALL SELECT NULL, CASE dest_name WHEN 'pt_any' THEN 'stop' ELSE dest_name END, x, y FROM f_destinations UNION ALL SELECT NULL, 'garden', {_CENTRE} FROM f_parks WHERE leisure = 'garden')
  SELECT osm_id, dest_name, CASE dest_name WHEN 'convenience' THEN 'Convenience shop' WHEN 'fresh_food_market' THEN 'Fresh food or market' WHEN 'garden' THEN 'Garden' ELSE dest_name END AS dest_name_full, ROUND(x, 6) AS x, ROUND(y, 6) AS y FROM alls"""
SQL["dest_origins"] = f"""WITH {CLASSES}, alls AS (SELECT TRUE AS from_osm, dest_name, (xmin + xmax) / 2::DOUBLE AS x, (ymin + ymax) / 2::DOUBLE AS y FROM classes WHERE dest_name NOT IN ('convenience', 'school') UNION ALL SELECT FALSE, CASE dest_name WHEN 'pt_any' THEN 'stop' ELSE dest_name END, x, y FROM f_destinations UNION ALL SELECT FALSE, 'garden', {_CENTRE} FROM f_parks WHERE leisure = 'garden')
  SELECT dest_name, from_osm, COUNT(*) AS count FROM alls p WHERE EXISTS (SELECT 1 FROM f_areas o WHERE POWER(GREATEST(0, o.xmin - p.x, p.x - o.xmax)::DOUBLE, 2) + POWER(GREATEST(0, o.ymin - p.y, p.y - o.ymax)::DOUBLE, 2) <= 250000) GROUP BY ALL"""
SQL["report_sorted"] = "WITH c AS (SELECT CAST(FLOOR(y / 1000) AS BIGINT) AS district, dest_name, COUNT(*) AS count FROM f_destinations GROUP BY ALL) SELECT *, ROW_NUMBER() OVER (ORDER BY district, dest_name) AS position FROM c"
_TURN = "2 * 3.141592653589793::DOUBLE"
SQL["net_discs"] = f"""WITH RECURSIVE deg AS (SELECT node FROM (SELECT u AS node FROM f_edges UNION ALL SELECT v FROM f_edges) GROUP BY node HAVING COUNT(*) >= 2),
  kept AS (SELECT osmid, x, y FROM f_nodes WHERE osmid IN (SELECT node FROM deg)), links AS (SELECT a.osmid AS a, b.osmid AS b FROM kept a JOIN kept b ON a.osmid <> b.osmid AND POWER(a.x - b.x, 2) + POWER(a.y - b.y, 2) <= 9604),
  closure AS (SELECT osmid AS n, osmid AS r FROM kept UNION SELECT c.n, l.b FROM closure c JOIN links l ON l.a = c.r), label AS (SELECT n, MIN(r) AS component FROM closure GROUP BY n),
  spot AS (SELECT DISTINCT component, x, y FROM kept JOIN label ON n = osmid), own AS (SELECT *, ROW_NUMBER() OVER (ORDER BY component, x, y) AS id FROM spot),
  pair AS (SELECT a.id, ATAN2(b.y - a.y, b.x - a.x) AS t, ACOS(SQRT(POWER(a.x - b.x, 2) + POWER(a.y - b.y, 2)) / 98) AS h FROM own a JOIN own b ON a.component = b.component AND a.id <> b.id AND POWER(a.x - b.x, 2) + POWER(a.y - b.y, 2) < 9604),
  low AS (SELECT id, t - h - FLOOR((t - h) / ({_TURN})) * {_TURN} AS lo, 2 * h AS w FROM pair),
  spans AS (SELECT id, lo, LEAST(lo + w, {_TURN}) AS hi FROM low UNION ALL SELECT id, 0, lo + w - {_TURN} FROM low WHERE lo + w > {_TURN} UNION ALL SELECT id, {_TURN}, {_TURN} FROM own),
  gaps AS (SELECT id, COALESCE(MAX(hi) OVER (PARTITION BY id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a, lo AS b FROM spans),
  arc AS (SELECT o.component, o.x, o.y, UNNEST([1, -1]) AS s, UNNEST([g.b, g.a]) AS t FROM gaps g JOIN own o USING (id) WHERE g.b > g.a),
  total AS (SELECT component, SUM(s * (2401 * t + 49 * (x * SIN(t) - y * COS(t)))) / 2 AS area, SUM(s * 49 * (x * x * SIN(t) + 98 * x * (t / 2 + SIN(2 * t) / 4) + 2401 * (SIN(t) - POWER(SIN(t), 3) / 3))) / 2 AS mx, SUM(s * 49 * (-y * y * COS(t) + 98 * y * (t / 2 - SIN(2 * t) / 4) + 2401 * (POWER(COS(t), 3) / 3 - COS(t)))) / 2 AS my FROM arc GROUP BY component)
  SELECT component, (SELECT COUNT(*) FROM label l WHERE l.component = total.component) AS members, ROUND(area, 4) AS area, ROUND(mx / area, 4) AS x, ROUND(my / area, 4) AS y FROM total"""
SQL["net_headway_poi"] = f"""WITH RECURSIVE {KNN}, {ADJ}, {SEEDS}, {WALK.format(limit=500)}, ends AS (SELECT dest_oid, n1 AS src, n1_distance AS off FROM pois UNION ALL SELECT dest_oid, n2, n2_distance FROM pois),
  timed AS (SELECT src, off, CASE WHEN dest_oid % 11 <> 0 THEN dest_oid * 7 % 61 END AS headway FROM ends)
  SELECT d.node, MIN(CASE WHEN headway >= 0 THEN dist + off END) AS any, MIN(CASE WHEN headway <= 30 THEN dist + off END) AS within_30, MIN(CASE WHEN headway <= 20 THEN dist + off END) AS within_20 FROM dists d JOIN timed e ON e.src = d.src GROUP BY d.node"""
SQL["park_union_area"] = SQL["park_union"]

QUERIES = {name: globals()[name] for name in SQL}
SQL = {name: with_views(sql) for name, sql in SQL.items()}
