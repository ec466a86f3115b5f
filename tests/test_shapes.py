"""Shapes by their true outline, on small tables against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from urbanframe.functions import geometry as g
from urbanframe.operators import linear, network, overlay, parks, places, shapes, spatial
from urbanframe.sources import writers

RNG = random.Random(6)
PLACE = "struct<x: double, y: double>"
POLYGON = f"array<array<{PLACE}>>"


def point(x, y):
    return {"x": float(x), "y": float(y)}


def ring(*xy):
    return [point(x, y) for x, y in xy]


def square(x, y, w, h=None):
    h = w if h is None else h
    return ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))


def dart(x, y, w, h, back=False):
    r = ring((x, y), (x + w, y + 2 * h / 3), (x, y + h), (x + w / 3, y + h / 2))
    return r[::-1] if back else r


def inside(polygon, x, y):
    return sum(overlay._holds([(p["x"], p["y"]) for p in r], (x, y)) for r in polygon) % 2 == 1


def polygons(spark, rows, *more):
    return spark.createDataFrame(rows, ", ".join(["key long", f"polygon {POLYGON}", *more]))


def some_darts(n, seed=1):
    rng = random.Random(seed)
    return [[dart(rng.randrange(100), rng.randrange(100), rng.randrange(10, 60), rng.randrange(10, 60), rng.random() < 0.5)] for _ in range(n)]


def grid_area(test, size=170, step=0.5):
    """Area by counting cell centres."""
    at = np.arange(step / 2, size, step)
    return sum(test(x + 0.01, y + 0.013) for x in at for y in at) * step * step


# -- overlay ------------------------------------------------------------------


@pytest.mark.parametrize("cell", [13.0, 40.0, 1000.0])
def test_dissolve_and_difference_against_points(spark, cell):
    a, b = some_darts(9, 2), some_darts(5, 3)
    own = polygons(spark, [(i % 2, p) for i, p in enumerate(a)])
    merged = overlay.dissolve(own, "key", cell)
    areas, found = {r["key"]: r.area for r in merged.areas().collect()}, {}
    for r in merged.shapes().withColumn("area", g.area(F.col("polygon"))).collect():
        found.setdefault(r["key"], []).append(r)
    for k in (0, 1):
        assert math.isclose(sum(r.area for r in found[k]), areas[k], rel_tol=1e-7)
        for _ in range(300):
            x, y = RNG.uniform(0, 160), RNG.uniform(0, 160)
            assert any(inside(p, x, y) for p in a[k::2]) == (sum(inside(r.polygon, x, y) for r in found[k]) == 1)
    single = polygons(spark, list(enumerate(a)))
    for op, keep in (("difference", lambda p, q: p and not q), ("intersection", lambda p, q: p and q)):
        cut = overlay.against(single, polygons(spark, list(enumerate(b))), "key", cell, op)
        parts = cut.shapes().collect()
        areas = {r["key"]: r.area for r in cut.areas().collect()}
        for i, p in enumerate(a):
            left = [r.polygon for r in parts if r["key"] == i]
            assert bool(left) == (i in areas)
            for _ in range(60):
                x, y = RNG.uniform(0, 160), RNG.uniform(0, 160)
                assert any(inside(q, x, y) for q in left) == keep(inside(p, x, y), any(inside(q, x, y) for q in b))


def test_three_overlapping_triangles(spark):
    triangles = [[ring((0, 0), (60, 0), (0, 60))], [ring((10, 5), (70, 20), (20, 70))], [ring((5, 40), (65, 30), (40, 68))]]
    area = overlay.dissolve(polygons(spark, [(1, t) for t in triangles]), "key", 16.0).areas().first().area
    assert abs(area - grid_area(lambda x, y: any(inside(t, x, y) for t in triangles), 80, 0.25)) < 8


@pytest.mark.parametrize("cell", [7.0, 100.0])
def test_rings_with_holes_and_touching_squares(spark, cell):
    frame = [[square(0, 0, 30)], [square(0, 30, 10, 30)], [square(20, 30, 10, 30)], [square(0, 60, 30, 10)]]
    (row,) = overlay.dissolve(polygons(spark, [(1, p) for p in frame]), "key", cell).shapes().collect()
    shell, hole = row.polygon
    assert len(shell) == len(hole) == 4 and row.part == 1
    assert overlay.ring_area([(p.x, p.y) for p in shell]) == 2100 and overlay.ring_area([(p.x, p.y) for p in hole]) == -300
    holed = polygons(spark, [(1, [square(0, 0, 50), square(10, 10, 20)[::-1]]), (2, [square(0, 0, 50), square(10, 10, 20)])])
    assert {r.area for r in overlay.dissolve(holed, "key", cell).areas().collect()} == {2100.0}
    gone = overlay.difference(holed, polygons(spark, [(1, [square(-5, -5, 40, 60)]), (2, [square(35, -5, 20, 60)])]), "key", cell)
    assert gone.areas().count() == gone.shapes().count() == 0


def test_crowded_tile_is_quartered(spark, monkeypatch):
    a = some_darts(40, 5)
    rows = polygons(spark, [(1, p) for p in a])
    plain = overlay.dissolve(rows, "key", 500.0).areas().first().area
    edges = np.array([[e[c] for c in ("ax", "ay", "bx", "by")] for e in overlay.directed_edges(rows, ["key"]).collect()])
    monkeypatch.setattr(overlay, "LIMIT", 20)
    area, parts = overlay.overlay_tile(edges, np.zeros(len(edges)), (0, 0, 500, 500), "union")
    assert math.isclose(area, plain, rel_tol=1e-9)
    assert math.isclose(sum(map(overlay.ring_area, overlay.stitched(parts))), plain, rel_tol=1e-7)


def test_shared_area(spark):
    pairs = [(p, q) for p in some_darts(6, 7) for q in some_darts(6, 8)] + [([square(0, 0, 10), square(2, 2, 4)], [square(1, 1, 5)]), ([square(0, 0, 5)], [square(5, 0, 5)])]
    df = spark.createDataFrame(pairs, f"a {POLYGON}, b {POLYGON}")
    rows = df.select("a", "b", overlay.shared_area(F.col("a"), F.col("b")).alias("n"), g.overlap_area(F.col("a"), F.col("b")).alias("other")).collect()
    assert all(abs(r.n - r.other) < 1e-6 for r in rows) and sum(r.n > 1 for r in rows) > 8 and rows[-2].n == 9 and rows[-1].n == 0


# -- segments -----------------------------------------------------------------


def brute_distance(p, q):
    def segs(s):
        if isinstance(s, dict):
            return [(s, s)]
        if s and isinstance(s[0], list):
            return [(r[i - 1], r[i]) for r in s for i in range(len(r))]
        return list(zip(s, s[1:])) or [(s[0], s[0])]

    def turn(a, b, c):
        return np.sign((b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"]))

    def to(p, a, b):
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        t = max(0, min(1, ((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy) / (dx * dx + dy * dy))) if dx or dy else 0
        return math.hypot(p["x"] - a["x"] - t * dx, p["y"] - a["y"] - t * dy)

    best = min(0 if turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0 else min(to(a, c, d), to(b, c, d), to(c, a, b), to(d, a, b)) for a, b in segs(p) for c, d in segs(q))
    first = lambda s: s if isinstance(s, dict) else s[0] if isinstance(s[0], dict) else s[0][0]
    for one, two in ((p, q), (q, p)):
        if isinstance(two, list) and isinstance(two[0], list) and inside(two, first(one)["x"], first(one)["y"]):
            best = 0
    return best


@pytest.mark.parametrize("crowded", [None, 3])
def test_distances_and_meeting_of_all_kinds(spark, crowded):
    rng = random.Random(9)
    xy = lambda: (rng.randrange(120), rng.randrange(120))
    kinds = {
        PLACE: [point(*xy()) for _ in range(12)],
        f"array<{PLACE}>": [ring(*[xy() for _ in range(rng.choice([1, 2, 3]))]) for _ in range(10)],
        POLYGON: [*some_darts(8, 10), [square(0, 0, 119), square(5, 5, 100)]],
    }
    for one in kinds:
        for two in kinds:
            a, b = (spark.createDataFrame(list(enumerate(kinds[k])), f"id long, shape {k}") for k in (one, two))
            want = {(i, j): d for i, p in enumerate(kinds[one]) for j, q in enumerate(kinds[two]) if (d := brute_distance(p, q)) <= 15}
            got = {(r.a_key, r.b_key): r.distance for r in shapes.near(a, b, "id", "id", 15, 20.0, crowded=crowded).collect()}
            assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
            met = [tuple(r) for r in shapes.meeting(a, b, "id", "id", 20.0, crowded=crowded).collect()]
            assert len(met) == len(set(met)) and set(met) == {k for k, d in want.items() if d == 0}


def test_crowded_tiles_lose_and_double_nothing(spark):
    rng = random.Random(11)
    rows = [(i, *(xy := (rng.gauss(30, 9), rng.gauss(30, 9))), xy[0] + rng.random() * 2, xy[1] + rng.random() * 2) for i in range(400)] + [(400 + i, float(x), float(x), x + 30.0, x + 30.0) for i, x in enumerate(range(-100, 200, 40))]
    df = spark.createDataFrame(rows, "id long, xmin double, ymin double, xmax double, ymax double")
    plain = sorted(map(tuple, spatial.box_join(df, df, 64.0, 0.5).select("a_id", "b_id").collect()))
    split = spatial.box_join(df, df, 64.0, 0.5, crowded=20)
    assert sorted(map(tuple, split.select("a_id", "b_id").collect())) == plain and len(plain) == len(set(plain)) > 1000
    left = spatial._tiled(spatial.prefixed(df, "a_"), "a_", 64.0, 0.5)
    depth = spatial._depths(left, spatial._tiled(spatial.prefixed(df, "b_"), "b_", 64.0, 0.0), 20)
    parts = spatial._quartered(left, "a_", F.lit(64.0), 0.5, depth).groupBy("_tx", "_ty", "_sx", "_sy").count()
    assert parts.agg(F.max("count")).first()[0] < 150 < left.groupBy("_tx", "_ty").count().agg(F.max("count")).first()[0]


def test_shared_borders(spark):
    a = polygons(spark, [(1, [square(0, 0, 10)]), (2, [ring((20, 0), (30, 10), (20, 10))])])
    b = polygons(spark, [(5, [square(10, 5, 10)]), (6, [square(0, 0, 10)]), (7, [ring((20, 0), (32, 12), (32, 0))]), (8, [square(10, 10, 4)])])
    got = {(r.a_key, r.b_key): r.length for r in shapes.shared_border(a, b, "key", "key", 8.0, "polygon", "polygon").collect()}
    assert {k: round(v, 6) for k, v in got.items()} == {(1, 5): 5, (1, 6): 40, (2, 7): round(math.hypot(10, 10), 6), (2, 5): 5}


def test_tags_of_areas(spark):
    areas = polygons(spark, [(1, [dart(0, 0, 30, 30)]), (2, [square(100, 100, 10)]), (3, [square(200, 0, 10)])])
    lines = [(1, ring((-5, 15), (8, 15)), "x", None), (2, ring((2, 20), (2, 35)), None, "b"), (3, ring((101, 101), (102, 103)), "x", "q"), (4, ring((90, 110), (120, 110)), "x", "q"), (5, ring((101, 101), (102, 103)), None, None), (6, ring((8, 15), (9, 15)), "hollow", None)]
    features = spark.createDataFrame(lines, f"id long, shape array<{PLACE}>, a string, b string")
    got = {r["key"]: r.t for r in shapes.associate_tags(areas, features, "key", "id", ["a", "b"], 25.0, "t").collect()}
    # Lines 1 and 6 end in and lie in the notch between the dart's wings; line 2 crosses the upper wing.
    assert got == {1: ['{"b":"b"}'], 2: ['{"a":"x","b":"q"}'], 3: None}


def test_memberships(spark):
    layers = [polygons(spark, [(1, [square(0, 0, 10)]), (2, [square(5, 5, 10)])]), polygons(spark, [(1, [dart(0, 0, 20, 20)])]), polygons(spark, [(1, [square(0, 0, 100)])])]
    points = spark.createDataFrame([(i, RNG.uniform(-2, 25), RNG.uniform(-2, 25)) for i in range(80)], "id long, x double, y double")
    rows = [[p.polygon for p in df.collect()] for df in layers]
    want = {r.id: sum(1 << i for i, ps in enumerate(rows) if any(inside(p, r.x, r.y) for p in ps)) for r in points.collect()}
    assert {r.id: r.layers for r in shapes.memberships(points, layers, "id", 8.0).collect()} == want
    assert {r.id for r in shapes.in_all(points, layers, "id", 8.0).collect()} == {i for i, v in want.items() if v == 7}


# -- lines --------------------------------------------------------------------


def test_points_along_bent_lines_and_rings(spark):
    lines = [ring((0, 0), (30, 40), (30, 100)), ring((0, 0), (0, 0), (60, 0)), ring((5, 5), (5, 5)), ring((0, 0), (90, 0))]
    df = spark.createDataFrame([(i, 10 * i, 10 * i + 1, x) for i, x in enumerate(lines)], f"ogc_fid long, u long, v long, line array<{PLACE}>")
    got = sorted((r.edge_ogc_fid, r.metres, r.n1_distance, r.n2_distance, round(r.x, 6), round(r.y, 6)) for r in linear.sample_polylines(df).collect())
    assert got[:4] == [(0, 0, 0, 110, 0, 0), (0, 30, 30, 80, 18, 24), (0, 60, 60, 50, 30, 50), (0, 90, 90, 20, 30, 80)]
    assert got[4:] == [(1, 0, 0, 60, 0, 0), (1, 30, 30, 30, 30, 0), (1, 60, 60, 0, 60, 0), (2, 0, 0, 0, 5, 5), (3, 0, 0, 90, 0, 0), (3, 30, 30, 60, 30, 0), (3, 60, 60, 30, 60, 0), (3, 90, 90, 0, 90, 0)]
    for row in linear.points_along(df.where("ogc_fid = 0"), ["ogc_fid"], 7.0).join(df, "ogc_fid").withColumn("at", g.interpolate(F.col("line"), F.col("metres"))).collect():
        assert math.isclose(row.x, row["at"].x, abs_tol=1e-9) and math.isclose(row.y, row["at"].y, abs_tol=1e-9)
    rings = polygons(spark, [(1, [square(0, 0, 30)])]).withColumn("part", F.lit(1)).unionByName(polygons(spark, [(1, [square(100, 0, 5)])]).withColumn("part", F.lit(2)))
    nodes = sorted(tuple(r) for r in parks.outline_nodes(rings, "key").select("node", "x", "y").collect())
    assert nodes == [(1, 0, 0), (2, 20, 0), (3, 30, 10), (4, 30, 30), (5, 10, 30), (6, 0, 20), (7, 0, 0), (8, 100, 0), (9, 100, 0)]


def test_associate_bent_edges(spark):
    edges = spark.createDataFrame([(1, 10, 11, ring((0, 0), (30, 40), (90, 40))), (2, 11, 12, ring((90, 40), (90, 0)))], f"ogc_fid long, u long, v long, line array<{PLACE}>")
    points = spark.createDataFrame([(1, 60.0, 43.0), (2, 95.0, 10.0), (3, 15.0, 20.0)], "id long, x double, y double")
    got = {r.id: tuple(r)[1:] for r in linear.associate_polylines(points, edges, "id").select("id", "edge_ogc_fid", "n1", "n2", "n1_distance", "n2_distance", "match_distance", "mx", "my").collect()}
    assert got == {1: (1, 10, 11, 80, 30, 3.0, 60.0, 40.0), 2: (2, 11, 12, 30, 10, 5.0, 90.0, 10.0), 3: (1, 10, 11, 25, 85, 0.0, 15.0, 20.0)}


# -- network ------------------------------------------------------------------


def test_reach_by_tile_equals_reach(spark):
    rng = random.Random(12)
    at = {i: (rng.uniform(0, 1000), rng.uniform(0, 1000)) for i in range(120)}
    rows = []
    for i in at:
        for j in sorted(at, key=lambda k: math.dist(at[i], at[k]))[1:4]:
            rows.append((i, j, round(math.dist(at[i], at[j]) * rng.choice([0.8, 1.0, 1.4]), 3), *at[i], *at[j]))
    edges = spark.createDataFrame(rows, "u long, v long, length double, ux double, uy double, vx double, vy double")
    sources = spark.createDataFrame([(i,) for i in [*range(0, 120, 7), 999]], "osmid long")
    plain = {(r.src, r.node): r.dist for r in network.reach(edges, sources, 300.0).collect()}
    for cell in (60.0, 300.0, 5000.0):
        rows = network.reach_by_tile(edges, sources, 300.0, cell=cell).collect()
        assert len(rows) == len(plain) and all(abs(plain[r.src, r.node] - r.dist) < 1e-9 for r in rows)


def test_merged_discs(spark):
    spots = [(1, 0, 0), (2, 30, 0), (3, 15, 25), (4, 15, 25), (5, 200, 7), (6, 300, 0), (7, 320, 0), (8, 340, 0), (9, 320, 18)]
    nodes = spark.createDataFrame([(i, {1: 1, 2: 1, 3: 1, 4: 1, 5: 5}.get(i, 6), float(x) + 5e5, float(y) + 6e6) for i, x, y in spots], "osmid long, component long, x double, y double")
    got = {r.component: r for r in network.merged_discs(nodes, "component", 20.0).collect()}
    assert got[1].members == 4 and got[5].members == 1
    for k, row in got.items():
        own = [(x, y) for i, x, y in spots if {1: 1, 2: 1, 3: 1, 4: 1, 5: 5}.get(i, 6) == k]
        at = np.arange(-30, 380, 0.1) + 0.05
        x, y = np.meshgrid(at, np.arange(-30, 60, 0.1) + 0.05)
        hit = np.zeros(x.shape, bool)
        for a, b in own:
            hit |= (x - a) ** 2 + (y - b) ** 2 <= 400
        assert abs(row.area - hit.sum() * 0.01) < 3 and abs(row.x - 5e5 - x[hit].mean()) < 0.02 and abs(row.y - 6e6 - y[hit].mean()) < 0.02


# -- open space ---------------------------------------------------------------


def test_cut_out_and_clusters_of_cut_shapes(spark):
    spaces = polygons(spark, [(1, [square(0, 0, 100)]), (2, [square(100, 0, 50)]), (3, [square(300, 0, 40)]), (4, [square(500, 0, 20)])])
    excluded = polygons(spark, [(1, [square(40, -5, 20, 200)]), (2, [square(295, -5, 60)])])
    cut = parks.cut_out(spaces, excluded, "key", 64.0)
    assert sorted((r["key"], r.part) for r in cut.collect()) == [(1, 1), (1, 2), (2, 1), (4, 1)]
    sizes = {r["key"]: r for r in parks.measured(cut, "key").collect()}
    assert {k: round(r.area_ha * 10000, 6) for k, r in sizes.items()} == {1: 8000, 2: 2500, 4: 400}
    assert math.isclose(sizes[1].diameter, math.hypot(100, 100)) and math.isclose(sizes[4].roundness, 2 / math.pi)
    flags = spark.createDataFrame([(1, True, False), (2, True, True), (4, False, False)], "key long, public_access boolean, water_feature boolean")
    flags = flags.withColumns({"within_public": F.lit(False), "linear_feature": F.lit(False), "linear_tag": F.lit(None).cast("boolean"), "acceptable_linear_feature": F.lit(None).cast("boolean")})
    areas = parks.OpenSpaceAreas(flags, cut, "key", 64.0)
    got = {r.aos_id: r for r in areas.areas().collect()}
    assert got.keys() == {1, 4} and got[1].members == 2 and got[1].has_water_feature and not got[4].has_water_feature
    assert (round(got[1].aos_ha, 6), round(got[1].aos_ha_public, 6), round(got[1].aos_ha_water, 6), round(got[4].aos_ha_not_public, 6)) == (1.05, 1.05, 0.25, 0.04)
    assert round(got[1].water_percent, 6) == round(25 / 1.05, 6)
    shapes_of = areas.shapes().collect()
    assert sorted((r.aos_id, r.part) for r in shapes_of) == [(1, 1), (1, 2), (4, 1)]
    # The right half of 1 and its neighbour 2 are one polygon.
    assert max(len(r.polygon[0]) for r in shapes_of) == 6


def test_custom_layers(spark):
    region = polygons(spark, [(1, [square(0, 0, 100)])]).drop("key")
    layer = polygons(spark, [(1, [square(90, 90, 30)], "a"), (2, [square(300, 0, 10)], "a"), (3, [square(0, 0, 10)], "b")], "kind string")
    use = lambda config: parks.open_space_areas(config, {"own": layer}, region, lambda: "tagged", "key", 50.0)
    assert use(None) == use({"data": None}) == "tagged"
    assert [(r["key"], r.aos_ha_public) for r in use({"data": "own", "where": "kind = 'a'"}).collect()] == [(1, 0.09)]
    with pytest.raises(ValueError):
        use({"data": "own", "where": "kind = 'none'"})
    with pytest.raises(KeyError):
        use({"data": "other"})


def test_configured_pois(spark):
    tagged = spark.createDataFrame([("1", "food", 0.0, 0.0), ("2", "park", 1.0, 1.0), ("3", "school", 2.0, 2.0)], "osm_id string, dest_name string, x double, y double")
    layers = {"p": spark.createDataFrame([(5.0, 6.0)], "x double, y double"), "q": polygons(spark, [(1, [square(0, 0, 10)])])}
    known = spark.createDataFrame([("food", "All food", "F")], "dest_name string, dest_full_name string, domain string")
    config = {"food": {"data": "p", "dest_name_full": "unused"}, "park": {"data": "q", "replace": True, "domain": "Green"}, "new": {"data": "q"}, "school": {"data": None, "replace": True}}
    found, types = places.configured_pois(tagged, config, layers, known)
    assert sorted(map(tuple, types.collect())) == [("food", "All food", "F", 2), ("new", "new", "Custom", 1), ("park", "park", "Green", 1)]
    assert sorted((r.osm_id or "", r.dest_name, r.x, r.y) for r in found.collect()) == [("", "food", 5, 6), ("", "new", 5, 5), ("", "park", 5, 5), ("1", "food", 0, 0)]
    with pytest.raises(KeyError):
        places.configured_pois(tagged, {"new": {"data": "none"}}, layers, known)


def test_geojson_of_shapes(spark):
    df = polygons(spark, [(1, [square(0, 0, 1)])])
    assert '"coordinates":[[[0.0,0.0],[1.0,0.0],[1.0,1.0],[0.0,1.0],[0.0,0.0]]]' in writers.geojson_features(df, ["key"]).first().value
    line = spark.createDataFrame([(1, ring((0, 0), (1, 2)))], f"key long, line array<{PLACE}>")
    assert '"type":"LineString","coordinates":[[0.0,0.0],[1.0,2.0]]' in writers.geojson_features(line, ["key"]).first().value
