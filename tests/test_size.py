"""Steps that have to stay bounded as tables grow."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from urbanframe import session
from urbanframe.functions import geometry as g
from urbanframe.functions import scalars
from urbanframe.operators import graph, network, overlay, parks, shapes, unions
from urbanframe.plans import catalogue
from urbanframe.plans.fixtures import view


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_tiled_joins_pass_nothing_through_the_driver(spark, data):
    """sides of tiled joins were broadcast, as file sizes miss what tiles add."""
    queries = catalogue.queries()
    for name in ("shape_meet", "shape_near", "pos_tags"):
        assert "Broadcast" not in plan_of(queries[name](spark, data)), name


def _random_tiles(n):
    r, edges, side, group = np.random.default_rng(5), [], [], []
    for i in range(n):
        for k in range(int(r.integers(1, 60 if i % 50 == 0 else 5))):
            angle, middle = np.sort(r.uniform(0, 2 * np.pi, 6)), r.uniform(-50, 250, 2)
            ring = middle + np.stack([np.cos(angle), np.sin(angle)], 1) * r.uniform(20, 150)
            e = np.concatenate([ring, np.roll(ring, -1, 0)], 1)
            edges.append(e)
            side.append(np.full(len(e), k % 2, np.int8))
            group.append(np.full(len(e), i))
    return np.concatenate(edges), np.concatenate(side), np.concatenate(group), np.tile([0.0, 0.0, 200.0, 200.0], (n, 1))


def test_tiles_share_sweeps():
    """every tile had a sweep of its own; together they give the same, crowded and empty ones too."""
    edges, side, group, tiles = _random_tiles(200)
    for op in overlay.KEPT:
        areas, parts = overlay.overlay_tiles(edges, side, group, tiles, op)
        for i, tile in enumerate(tiles):
            area, lines = overlay.overlay_tile(edges[group == i], side[group == i], tuple(tile), op)
            assert abs(area - areas[i]) < 1e-6
            assert len(lines) == len(parts[i])
    assert overlay.overlay_tiles(np.zeros((0, 4)), np.zeros(0, np.int8), np.zeros(0, np.int64), np.zeros((0, 4)), "union")[1] == []


def test_unions_are_stitched_by_cluster(spark):
    """all polygons of a key were stitched as one group."""
    corner = F.col("id") * 100.0
    boxes = spark.range(40).select((F.col("id") % 2).alias("kind"), g.rectangle(corner, F.lit(0.0), corner + F.when(F.col("id") % 4 == 0, 250.0).otherwise(50.0), F.lit(30.0)).alias("polygon"))
    union, kinds = overlay.dissolve_clusters(boxes, "kind", 200.0)
    shapes = union.shapes().join(kinds, "cluster")
    found = {r.kind: r.area for r in shapes.groupBy("kind").agg(F.sum(g.area(F.col("polygon"))).alias("area")).collect()}
    whole = {r.kind: r.area for r in overlay.dissolve(boxes, "kind", 200.0).areas().collect()}
    assert found.keys() == whole.keys() and all(abs(found[k] - whole[k]) < 1e-6 for k in whole)
    assert shapes.select("cluster").distinct().count() == 30


def test_component_covers_the_whole_network(spark, data):
    """stars of customers and nations had taken the network's place."""
    found = catalogue.queries()["net_component"](spark, data)
    edges = view(spark, data, "f_edges").select("ogc_fid")
    assert found.count() == edges.count() > 0
    assert found.exceptAll(edges).count() == 0


def test_edges_pass_nothing_through_the_driver(spark, data):
    """all nodes were broadcast twice to make the edges."""
    assert "Broadcast" not in plan_of(catalogue.queries()["pos_access"](spark, data))


def test_nearest_places_by_batches(spark):
    """the pairs of a join had their places found by nested columns in its condition."""
    r = np.random.default_rng(3)
    rows = [(i, [(float(x), float(y)) for x, y in r.integers(0, 9, (int(r.integers(0, 5)), 2))], float(r.integers(0, 9)), float(r.uniform(0, 9))) for i in range(300)]
    df = spark.createDataFrame([*rows, (300, None, 1.0, 1.0)], "id int, line array<struct<x: double, y: double>>, x double, y double")
    plain = g.nearest_on_line(F.col("line"), g.make_point(F.col("x"), F.col("y")))
    found = df.select(g.nearest_place(F.col("line"), F.col("x"), F.col("y")).alias("n"), plain.alias("p")).select("n.*", "p.distance", "p.before", "p.point.x", "p.point.y").collect()
    assert all(tuple(row[:4]) == tuple(row[4:]) for row in found) and len({row[0] for row in found}) > 100


def test_points_held_by_batches(spark):
    """as ``contains``, holes, borders, empty and missing polygons too."""
    r = np.random.default_rng(4)
    ring = lambda: [(float(x), float(y)) for x, y in r.integers(0, 9, (int(r.integers(0, 6)), 2))]
    rows = [(i, [ring() for _ in range(int(r.integers(0, 3)))], float(r.integers(0, 9)), float(r.uniform(0, 9))) for i in range(300)]
    df = spark.createDataFrame([*rows, (300, None, 1.0, 1.0)], "id int, polygon array<array<struct<x: double, y: double>>>, x double, y double")
    plain = F.coalesce(g.contains(F.col("polygon"), g.make_point(F.col("x"), F.col("y"))), F.lit(False))
    found = df.select(g.holds(F.col("polygon"), F.col("x"), F.col("y")).alias("n"), plain.alias("p")).collect()
    assert all(row.n == row.p for row in found) and {row.n for row in found} == {True, False}


def joins_of(df):
    return [line for line in plan_of(df).splitlines() if "SortMergeJoin" in line]


def test_pairs_are_tested_outside_the_join(spark, data):
    """distances of segments stood in the join's condition, too large a code to be compiled."""
    for name in ("shape_catchment", "shape_near", "shape_meet", "pos_shape_access", "green_access"):
        joins = joins_of(catalogue.queries()[name](spark, data))
        assert joins and not any("sqrt" in j.lower() or "signum" in j.lower() or "aggregate(" in j for j in joins), name


def test_segments_meet_and_apart(spark):
    cases = [((0, 0, 4, 0), (2, -1, 2, 1), 0.0), ((0, 0, 4, 0), (4, 0, 9, 9), 0.0), ((0, 0, 4, 0), (5, 0, 9, 0), 1.0), ((1, 1, 1, 1), (1, 4, 9, 4), 3.0), ((0, 0, 0, 0), (3, 4, 3, 4), 5.0)]
    names = [f"{s}_{e}" for s in "ab" for e in shapes.ENDS]
    df = spark.createDataFrame([[float(v) for v in (*p, *q)] for p, q, _ in cases], names)
    ends = tuple(F.col(c) for c in names[:4]), tuple(F.col(c) for c in names[4:])
    found = df.select(shapes.segment_distance(*ends).alias("d"), shapes.segments_meet(*ends).alias("m")).collect()
    assert [(row.d, row.m) for row in found] == [(d, d == 0) for *_, d in cases]


def test_distances_of_many_sources_at_once(spark):
    """distances were combined segment by segment along rows of edges."""
    r = np.random.default_rng(6)
    ends, length = r.integers(0, 60, (150, 2)), r.integers(1, 30, 150).astype(float)
    sources = np.unique(ends)
    found = {(s, n): d for s, n, d in zip(*(c.tolist() for c in network.relaxed(np.tile(sources, 3), ends, length, 50.0)))}
    far = np.full((60, 60), np.inf)
    far[sources, sources] = 0
    for (u, v), w in zip(ends, length):
        far[u, v] = far[v, u] = min(far[u, v], w)
    for k in range(60):
        far = np.minimum(far, far[:, k, None] + far[None, k, :])
    assert found == {(int(s), int(n)): far[s, n] for s, n in zip(*np.nonzero(far <= 50.0))}


def test_members_have_tasks_by_rows(spark, data, monkeypatch):
    """a fixed number of tasks had to sort all points and polygons."""
    monkeypatch.setattr(session, "ROWS", 20)
    df = catalogue.queries()["in_both"](spark, data)
    rows = view(spark, data, "f_nodes").count() + view(spark, data, "f_areas").count() + view(spark, data, "f_parks").count()
    assert f", {-(-rows // 20)}), REPARTITION_BY_NUM" in plan_of(df)


def test_shared_areas_by_batches(spark):
    """Polygons of a pair became Python objects; holes, turned rings, missing and empty ones count as before."""
    def ring(x, y, side, back=False):
        p = [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]
        return p[::-1] if back else p

    holed = [ring(0.0, 0.0, 10.0), ring(2.0, 2.0, 4.0)]
    rows = [(holed, [ring(1.0, 1.0, 3.0, True)], 5.0), ([ring(0.0, 0.0, 2.0)], [ring(2.0, 0.0, 2.0)], 0.0), (holed, holed, 84.0), ([], holed, 0.0), ([[]], holed, 0.0), (None, holed, None)]
    kind = "array<array<struct<x: double, y: double>>>"
    df = spark.createDataFrame(rows, f"p {kind}, q {kind}, want double").coalesce(1)
    found = df.select(overlay.shared_area(F.col("p"), F.col("q")).alias("area"), "want").collect()
    assert [row.area for row in found] == [row.want for row in found]
    spots = [[{"x": x, "y": y} for x, y in r] for r in holed]
    edges, owner = overlay.turned_edges(pa.array([spots[:1], None, spots], pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))))
    assert owner.tolist() == [0] * 4 + [2] * 8 and len(edges) == 12


def test_many_holes_in_a_large_shell(monkeypatch):
    """F8: every hole made an array of every shell anew; boxes of shells are looked at first."""
    asked = []
    plain = overlay._encloses
    monkeypatch.setattr(overlay, "_encloses", lambda shell, *place: asked.append(1) or plain(shell, *place))
    square = lambda x, y, side: [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]
    island = square(40.0, 40.0, 5.0)
    holes = [square(10.0 * k, 1.0, 2.0)[::-1] for k in range(1, 9)] + [square(30.0, 30.0, 40.0)[::-1], square(41.0, 41.0, 1.0)[::-1]]
    far = [square(1000.0 + 10 * k, 0.0, 5.0) for k in range(50)]
    found = overlay.as_polygons([*far, island, *holes, square(0.0, 0.0, 100.0)])
    assert [len(p) for p in found] == [10, 2] + [1] * 50 and found[1] == [island, holes[-1]]
    assert len(asked) <= len(holes) + 1


def test_access_nodes_without_pairs(spark, data):
    """outlines were made four times, each node was dealt to several tiles and shuffled with every edge near by."""
    for name in ("pos_shape_access", "green_access"):
        plan = plan_of(catalogue.queries()[name](spark, data)).split("Initial Plan")[0]
        assert plan.count("sequence(_low") == 1 and plan.count("LeftSemi") >= 2, name


def test_green_areas_alone_are_outlined(spark):
    """all areas' outlines were made before the green ones were picked."""
    corner = F.col("id") * 1000.0
    boxes = spark.range(6).select("id", F.lit(1).alias("part"), g.rectangle(corner, F.lit(0.0), corner + 200.0, F.lit(200.0)).alias("polygon"))
    edges = spark.createDataFrame([([(0.0, 0.0), (5000.0, 0.0)],), ([(0.0, 900.0)],)], "line array<struct<x: double, y: double>>")
    green = boxes.where("id % 2 = 0").select("id", F.lit(4.0).alias("aos_ha_public"))
    found = parks.green_access(boxes, green, edges, "id", d=20.0)
    rows = sorted((r.id, r.node) for r in found.collect())
    assert rows == sorted((i, n) for i in (0, 2, 4) for n in [*range(1, 13), 40, 41])
    assert plan_of(found).split("Initial Plan")[0].count("sequence(_low") == 1


def test_points_near_lines(spark):
    """the semi join by tile gives the same points as the pairs of ``near``."""
    r = np.random.default_rng(8)
    line = lambda n: [(float(x), float(y)) for x, y in r.integers(-40, 400, (n, 2))]
    lines = spark.createDataFrame([(i, line(int(r.integers(0, 4)))) for i in range(12)] + [(12, None)], "k int, line array<struct<x: double, y: double>>").where("line IS NULL OR size(line) > 0")
    dots = [(i, float(x), float(y)) for i, (x, y) in enumerate(r.integers(-80, 450, (600, 2)))]
    points = spark.createDataFrame([*dots, (600, None, 1.0)], "id int, x double, y double")
    found = sorted(row.id for row in shapes.points_near(points, lines, 30.0, 50.0, "line").collect())
    pairs = shapes.near(points.withColumn("shape", g.make_point(F.col("x"), F.col("y"))), lines, "id", "k", 30.0, 50.0, "shape", "line")
    assert found == sorted(row.a_key for row in pairs.select("a_key").distinct().collect()) and 50 < len(found) < 550
    assert shapes._square_up_to(30.0) >= 900.0 and np.sqrt(np.nextafter(shapes._square_up_to(30.0), np.inf)) > 30.0


def test_areas_by_batches(spark):
    """areas were nested columns, and their filter ran in the few tasks that read the file."""
    r = np.random.default_rng(9)
    ring = lambda: [(float(x), float(y)) for x, y in r.uniform(0, 9, (int(r.integers(0, 6)), 2))]
    df = spark.createDataFrame([(i, [ring() for _ in range(int(r.integers(1, 4)))]) for i in range(200)] + [(200, None)], "id int, polygon array<array<struct<x: double, y: double>>>")
    assert all(row.a == row.b for row in df.select(g.extent(F.col("polygon")).alias("a"), g.area(F.col("polygon")).alias("b")).collect())
    assert df.select(g.extent(F.array().cast("array<array<struct<x: double, y: double>>>")).alias("a")).first().a is None


def test_edges_are_made_once(spark, data):
    """associating, tiling and measuring each joined the nodes to edges anew; distances are the same by wide tiles."""
    for name in ("net_nearest_poi", "net_seed_distance"):
        assert "c_custkey" not in plan_of(catalogue.queries()[name](spark, data)), name
    edges, sources = view(spark, data, "f_edges"), view(spark, data, "f_nodes").where("osmid % 7 = 0")
    narrow, wide = (sorted(map(tuple, network.reach_by_tile(edges, sources, 500, cell=c).collect())) for c in (None, 1500.0))
    assert narrow == wide and len(wide) > 100


def test_trips_meet_once(spark, data):
    """stop times were shuffled to be grouped and again by trip; their clock texts repeated the fill nine times each."""
    assert plan_of(catalogue.queries()["gtfs_interpolate"](spark, data)).count("Exchange hashpartitioning") == 1
    clocks = spark.createDataFrame([(0, "00:00:00"), (59, "00:00:59"), (36061, "10:01:01"), (360064, "100:01:04"), (None, None)], "s long, want string")
    assert all(r.found == r.want for r in clocks.select(scalars.clock_of(F.col("s")).alias("found"), "want").collect())
    assert scalars.clock_of(F.col("long_name"))._jc.toString().count("long_name") <= 4


def test_boxes_swept_by_batches(spark, monkeypatch):
    """strips were nested columns over a tile's edges; empty rows, copies, shared edges and narrow chunks count each place once."""
    r = np.random.default_rng(10)
    rows = [[(x, y, x + w, y + h) for x, y, w, h in r.integers(1, 9, (int(r.integers(0, 12)), 4)).tolist()] for _ in range(60)]
    rows = [*rows, [(0, 0, 2, 2)] * 3, [], [(0, 0, 1, 4), (1, 0, 2, 4), (1, 4, 2, 5)]]
    want = [float(len({(x, y) for a, b, c, d in row for x in range(a, c) for y in range(b, d)})) for row in rows]
    boxes = pa.array([None if row is None else [dict(zip(unions.BOX, map(float, box))) for box in row] for row in [*rows, None]], pa.list_(pa.struct([(c, pa.float64()) for c in unions.BOX])))
    for size in (1, 7, 100, 1_000_000):
        monkeypatch.setattr(unions, "SWEPT", size)
        assert unions._union_area(boxes).to_pylist() == [*want, 0.0], size
    flat = spark.createDataFrame([(i, *map(float, box)) for i, row in enumerate(rows) for box in row], "id int, xmin double, ymin double, xmax double, ymax double")
    found = {row.id: row.area for row in unions.union_areas(flat, ["id"], 4.0).collect()}
    assert found == {i: want[i] for i, row in enumerate(rows) if row}
    assert "arrays_zip" not in plan_of(unions.union_areas(flat, ["id"], 4.0))


def test_components_of_neighbours(spark, monkeypatch):
    """links of all places were joined in rounds over the whole table; now only the blocks' borders are."""
    r = np.random.default_rng(11)
    spots = r.uniform(0, 400, (300, 2))
    near = [(i, j, *(spots[i] // 100).tolist()) for i in range(300) for j in range(i) if np.hypot(*(spots[i] - spots[j])) < 22]
    links = spark.createDataFrame([*near, (5, 5, 0.0, 0.0), (None, 7, 0.0, 0.0)], "a long, b long, x double, y double")
    want = sorted(map(tuple, graph.components(links).collect()))
    sizes, plain = [], graph.components
    monkeypatch.setattr(graph, "components", lambda df, *more: sizes.append(df.count()) or plain(df, *more))
    for one_task, joined in ((3, "false"), (200_000, "false"), (3, "true")):
        # So small a table would have one task for all blocks, and no borders.
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", joined)
        try:
            assert sorted(map(tuple, graph.components_by_place(links, ["x", "y"], one_task=one_task).collect())) == want
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(want) > 200 and 0 < max(sizes) < len(near) / 3
    assert graph.components_by_place(links.where("FALSE"), ["x", "y"]).count() == 0


def test_green_boxes_are_written(spark, data):
    """areas were measured twice, and filters on nested boxes ran over all shapes in the few tasks that read them."""
    plan = plan_of(catalogue.queries()["green_areas"](spark, data))
    assert "lambda" not in plan and "_extent" not in plan and "xmin" in plan


def test_access_nodes_by_any_tile(spark, data, monkeypatch):
    """edges were dealt to tiles of 100 m, four each; the tile decides on the work alone."""
    want = sorted(map(tuple, catalogue.queries()["pos_shape_access"](spark, data).collect()))
    monkeypatch.setattr(parks, "REACH", 45.0)
    assert len(want) > 10 and sorted(map(tuple, catalogue.queries()["pos_shape_access"](spark, data).collect())) == want


def test_areas_stitch_no_shapes(spark, monkeypatch):
    """whole shapes of clusters were stitched, and dealt to all tiles of their boxes, to tell what water they meet."""
    square = lambda x, y, w: [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    # 1 and 2 have water in a hole alone; 4 meets water of another class, its neighbour 9 does not.
    rows = [(1, [square(0.0, 0.0, 100.0), square(30.0, 30.0, 40.0)[::-1]]), (2, [square(100.0, 0.0, 50.0)]), (3, [square(40.0, 40.0, 10.0)]), (4, [square(300.0, 0.0, 20.0)]), (5, [square(320.0, 0.0, 20.0)]), (9, [square(280.0, 0.0, 20.0)])]
    parts = spark.createDataFrame(rows, "key long, polygon array<array<struct<x: double, y: double>>>").withColumn("part", F.lit(1))
    no = F.lit(None).cast("boolean")
    spaces = parts.select("key", (~F.col("key").isin(3, 5)).alias("public_access"), F.col("key").isin(3, 5).alias("water_feature"))
    spaces = spaces.withColumns({"within_public": F.lit(False), "linear_feature": F.lit(False), "linear_tag": no, "acceptable_linear_feature": no})
    areas = parks.OpenSpaceAreas(spaces, parts, "key", 64.0)
    whole = {(r.aos_id, r.part) for r in areas.shapes().collect()}
    alone = parks.OpenSpaceAreas(spaces, parts, "key", 64.0)
    monkeypatch.setattr(overlay, "stitched", None)
    monkeypatch.setattr(overlay.Overlay, "shapes", None)
    for found in (areas, alone):
        got = {r.aos_id: (r.members, r.has_water_feature, round(r.aos_ha * 10000, 6)) for r in found.areas().collect()}
        assert got == {1: (2, False, 10900.0), 3: (1, True, 100.0), 4: (2, True, 800.0), 5: (1, True, 400.0)}
    assert {i for i, _ in whole} == got.keys()
    # Layers of all members are like all: none is swept twice.
    assert alone.overlay.areas().count() == 4
    assert {(r.aos_id, round(r.aos_ha_public * 10000, 6), round(r.aos_ha_not_public * 10000, 6), round(r.aos_ha_water * 10000, 6)) for r in alone.areas().collect()} == {(1, 10900, 0, 0), (3, 0, 100, 100), (4, 800, 0, 0), (5, 0, 400, 400)}
    assert "parts" not in alone.overlay._over_tiles(False).columns and "tiles" not in alone.overlay.__dict__


def test_no_pairs_wait_on_disk(spark, data):
    """the rows of all pairs waited for a Python column's results, uncompressed on disk where memory was short."""
    for name in ("shape_meet", "shape_near"):
        plan = plan_of(catalogue.queries()[name](spark, data))
        assert "MapInArrow" in plan and "EvalPython" not in plan, name
