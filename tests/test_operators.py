"""Small cases with known results."""

import random

import pytest
from pyspark.sql import functions as F

from urbanframe.functions import geometry as g
from urbanframe.functions import scalars as sc
from urbanframe.operators import graph, network, pixels, places, policy, timetable
from urbanframe.operators import indicators as ind
from urbanframe.sources import readers, writers


def one(df):
    return df.collect()[0]


def test_rounding_and_clock(spark):
    row = one(spark.range(1).select(sc.half_even(F.lit(2.5)).alias("a"), sc.half_even(F.lit(3.5)).alias("b"), sc.clock_of(F.lit(90600)).alias("c"), sc.seconds_of(F.lit("25:10:00")).alias("d"), sc.seconds_of(F.lit("bad")).alias("e")))
    assert (row.a, row.b, row.c, row.d, row.e) == (2.0, 4.0, "25:10:00", 90600, None)


@pytest.mark.parametrize("text,want", [("100m", 100.0), ("0m", None), ("m", None), ("2.5 m", 2.5), (None, None), ("-5m", None)])
def test_resolution(spark, text, want):
    assert one(spark.createDataFrame([(text,)], "t string").select(sc.resolution_metres(F.col("t")).alias("r"))).r == want


@pytest.mark.parametrize("end,want", [("07:59:00", 1.0), ("08:59:00", 2.0), ("23:00:00", 12.0)])
def test_frequency_weight(spark, end, want):
    assert one(spark.range(1).select(sc.overlap_hours(F.lit("07:00:00"), F.lit(end), "07:00:00", "19:00:00").alias("w"))).w == want


def test_interpolation(spark):
    rows = [(1, i, "s", t) for i, t in enumerate(["06:00:00", None, None, "06:30:00"])] + [(2, i, "s", t) for i, t in enumerate([None, "25:10:00", None])]
    got = timetable.interpolate_times(spark.createDataFrame(rows, "trip_id int, stop_sequence int, stop_id string, departure_time string")).orderBy("trip_id", "stop_sequence")
    assert [r.departure_time for r in got.collect()] == ["06:00:00", "06:10:00", "06:20:00", "06:30:00", None, "25:10:00", "25:10:00"]


def test_stop_id_check(spark):
    stops = spark.createDataFrame([(1,), (None,)], "stop_id int")
    assert {r.stop_id for r in timetable.check_stop_ids(stops).collect()} == {"1", "nan"}
    with pytest.raises(ValueError):
        timetable.check_stop_ids(stops.unionByName(stops))


def test_binary_access(spark):
    df = spark.createDataFrame([(500.0, None), (501.0, None), (None, None)], "a double, b double")
    assert [tuple(r) for r in ind.binary_access(df, {"a": "x", "b": "y"}).select("x", "y").collect()] == [(1, None), (0, None), (0, None)]


def test_row_functions(spark):
    df = spark.createDataFrame([(None, None), (1, None)], "a int, b int")
    assert [tuple(r) for r in df.select(sc.row_sum(F.col("a"), F.col("b")), ind.row_max("a", "b"), sc.row_mean(F.col("a"), F.col("b"))).collect()] == [(0.0, None, None), (1.0, 1, 1.0)]


def test_sum_of_z_ignores_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert [round(r.z, 6) for r in ind.sum_of_z(df, ["a", "b"], "z").collect()] == [-0.707107, 0.707107]


def test_keep_columns():
    assert ind.resolve_keep_columns("Name, ID,,other, name", "id", ["id", "name", "Other"]) == ["name", "Other"]
    assert ind.resolve_keep_columns(None, "id", ["id"]) == []


def test_weights():
    assert ind.resolve_weight("pop", ["pop"], ["pop"], True).source == "pop"
    assert ind.resolve_weight("pop", [], ["pop"], True).boundary == "pop"
    assert "points" in ind.resolve_weight("pop", ["pop"], [], False).note
    assert "neither" in ind.resolve_weight("x", [], [], True).note


def test_apportionment_halves_a_cell(spark):
    cells = spark.createDataFrame([(1, 0, 0, 10, 10, 80, 1.0), (2, 10, 0, 20, 10, 0, 3.0)], "grid_id int, xmin int, ymin int, xmax int, ymax int, pop int, v double")
    areas = spark.createDataFrame([(7, 5, 0, 10, 10), (8, 12, 0, 14, 5)], "area_id int, xmin int, ymin int, xmax int, ymax int")
    got = {r.area_id: (r.pop, r.pop_v) for r in ind.custom_aggregate(cells, areas, {"v": ""}, "area_id", True, 10.0, weight="pop").collect()}
    assert got == {7: (40.0, 1.0), 8: (0.0, None)}


def test_geometry(spark):
    square = g.rectangle(F.lit(0), F.lit(0), F.lit(4), F.lit(4))
    holed = F.concat(square, F.array(F.array(*[g.make_point(F.lit(x), F.lit(y)) for x, y in ((1, 1), (1, 2), (2, 2), (2, 1))])))
    line = F.array(*[g.make_point(F.lit(x), F.lit(y)) for x, y in ((0, 0), (3, 0), (3, 4))])
    row = one(spark.range(1).select(
        g.area(holed).alias("area"), g.overlap_area(holed, g.rectangle(F.lit(0), F.lit(0), F.lit(2), F.lit(2))).alias("overlap"), g.difference_area(square, holed).alias("rest"),
        g.contains(holed, g.make_point(F.lit(1.5), F.lit(1.5))).alias("in_hole"), g.contains(square, g.make_point(F.lit(0), F.lit(0))).alias("corner"), g.contains(square, g.make_point(F.lit(4), F.lit(4))).alias("far"),
        g.length(line).alias("length"), g.interpolate(line, F.lit(5.0)).alias("at"), g.locate(line, g.make_point(F.lit(9), F.lit(2))).alias("share"), g.centroid(square).alias("mid"), g.min_circle(square).alias("circle"),
        g.substring_length(line, F.lit(0.25), F.lit(0.75)).alias("part"),
    ))
    assert (row.area, round(row.overlap, 9), round(row.rest, 9), row.in_hole, row.corner, row.far) == (15.0, 3.0, 1.0, False, True, False)
    assert (row.length, tuple(row.at), round(row.share, 9), tuple(row.mid), round(row.circle.r, 6), row.part) == (7.0, (3.0, 2.0), round(5 / 7, 9), (2.0, 2.0), round(8**0.5, 6), 3.5)


def test_components_random(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_point_estimates(spark):
    nodes = spark.createDataFrame([(1, 100.0, 8.0), (2, 50.0, 4.0)], "node int, d double, v double")
    points = spark.createDataFrame([(1, 1, 2, 10, 30), (2, 1, 2, 0, 40), (3, 1, 9, 10, 30), (4, 8, 9, 5, 5), (5, 1, 1, 10, 30)], "point_id int, n1 int, n2 int, n1_distance int, n2_distance int")
    got = {r.point_id: (r.d, r.v) for r in network.point_estimates(points, nodes, ["d"], ["v"]).collect()}
    assert got == {1: (80.0, 7.0), 2: (100.0, 8.0), 3: (110.0, 6.0), 4: (None, 0.0), 5: (110.0, 8.0)}


def test_regrid_conserves_the_total(spark):
    rows = [(x, y, x + 1, y + 1, float(20 * y + x + 1)) for x in range(20) for y in range(20)]
    got = pixels.regrid_sum(spark.createDataFrame(rows, "xmin int, ymin int, xmax int, ymax int, v double"), "v", 3.0)
    assert abs(got.agg(F.sum("v")).first()[0] - 80200) < 0.1


def test_policy_marks(spark):
    rows = [(1, "a", "P", "Yes", "Unclear", None), (2, "b", "P", "No", "Yes", "Yes"), (3, "c", "P", "Yes", "Yes", "No"), (4, "d", None, None, None, None), (5, "e", "No", "Yes", "Yes", "Yes")]
    df = spark.createDataFrame(rows, "row_id int, measures string, policy string, qualifier string, measurable_target string, evidence_threshold string")
    got = {r.measures: tuple(r)[1:] for r in policy.policy_flags(df).collect()}
    assert got == {"a": ("✔", "✔", "✘", "✘"), "b": ("✔", "✘", "✔", "✔"), "c": ("✔", "✔/✘", "✔", "✘"), "d": ("✘", "-", "-", "-"), "e": ("✘", "-", "-", "-")}


def test_checklist(spark):
    rows = [(1, "Topic", None, None), (2, None, "m", "Yes, it helps"), (3, None, None, " p1 "), (4, None, None, "No, it harms"), (5, None, None, "p2")]
    got = policy.clean_checklist(spark.createDataFrame(rows, "row_id int, indicators string, measures string, policy string")).orderBy("row_id").collect()
    assert [(r.indicators, r.measures, r.policy, r.qualifier) for r in got] == [("Topic", "m", "p1", "Yes"), ("Topic", "m", "p2", "No")]


def test_legacy_checklist(spark):
    rows = [(1, "g", "old", "p", None, "Yes", None), (2, None, None, "p", None, "Yes", None), (3, "h", "unknown", "q", None, None, None)]
    df = spark.createDataFrame(rows, "row_id int, indicators string, measures string, policy string, qualifier string, measurable_target string, evidence_threshold string")
    got = policy.clean_legacy(df, {"old": "new"}, {"new": "group"}).collect()
    assert [(r.indicators, r.measures, r.row_id) for r in got] == [("group", "new", 1)]


def test_custom_pois_replace(spark):
    found = spark.createDataFrame([(1, "a", 0.0, 0.0), (2, "b", 0.0, 0.0)], "osm_id int, dest_name string, x double, y double")
    own = found.where("osm_id = 1").withColumn("osm_id", F.lit(9))
    assert {r.osm_id for r in places.add_pois(found, own, ["a"]).collect()} == {2, 9}
    assert places.add_pois(found, own, []).count() == 3


def test_tag_rules(spark):
    rules = readers.load_tag_rules(spark.createDataFrame([("m", "shop", None, None), ("m", "amenity", "x", "NOT")], "dest_name string, key string, value string, `pre-condition` string"))
    assert rules == {"m": [{"key": "shop", "value": "NULL", "condition": "OR"}, {"key": "amenity", "value": "x", "condition": "NOT"}]}
    df = spark.createDataFrame([(1, "s", "x", "no"), (2, "s", "x", None), (3, None, "y", None), (4, "s", "y", "no")], "osm_id int, shop string, amenity string, access string")
    assert {r.osm_id for r in places.classify_tags(df, rules).collect()} == {2, 4}


def test_filter_report_and_feeds(spark):
    kept, seen = readers.filter_report(spark.range(10), F.col("id") > 6)
    assert kept.count() == 3 and seen.get == {"before": 10, "after": 3}
    feeds = readers.concat_feeds([spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([(1, 1)], "id int, x int")])
    assert sorted(r.x or 0 for r in feeds.collect()) == [0, 1]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 0, 0, 2, 2), (2, "b", 5, 5, 6, 6)], "id int, name string, xmin int, ymin int, xmax int, ymax int")
    writers.save(df, f"{tmp_path}/t", by="name")
    assert readers.read_features(spark, str(tmp_path), "t", "id = 2").count() == 1
    assert readers.read_in_box(spark, f"{tmp_path}/t", (0, 0, 3, 3)).count() == 1
    (tmp_path / "f.geojson").write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"n": 3}, "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}]}')
    assert one(readers.read_features(spark, f"{tmp_path}/f.geojson")).n == 3
    df.createOrReplaceTempView("known_table")
    assert writers.export_all(spark, ["known_table", "unknown_table"], f"{tmp_path}/out") == ["unknown_table"]
    assert readers.read_table(df.withColumn("geom", F.lit(1)), exclude=["name"]).columns == ["id", "xmin", "ymin", "xmax", "ymax"]
    assert readers.load_frequencies(spark, str(tmp_path), False).count() == 0


def test_empty_inputs(spark):
    points = spark.createDataFrame([], "point_id long, x double, y double")
    areas = spark.createDataFrame([], "area_id long, xmin double, ymin double, xmax double, ymax double")
    assert ind.custom_aggregate(points.withColumn("v", F.lit(1)), areas, {"v": ""}, "area_id", False, 10.0).count() == 0
    assert timetable.interpolate_times(spark.createDataFrame([], "trip_id int, stop_sequence int, stop_id int, departure_time string")).count() == 0
    assert network.reach(spark.createDataFrame([], "u long, v long, length long"), spark.createDataFrame([(1,)], "osmid long"), 10).count() == 1
    assert places.with_ids(points, ["x"], "id").count() == 0
    assert readers.load_covariates(spark.createDataFrame([(1,)], "a int"), ["a", "b"], "a = 2").collect()[0].a is None


def union_area(boxes, inside=(0, 0, 10**6, 10**6)):
    """Unit squares under integer boxes."""
    return len({(x, y) for a, b, c, d in boxes for x in range(max(a, inside[0]), min(c, inside[2])) for y in range(max(b, inside[1]), min(d, inside[3]))})


BOXED = "osm_id long, xmin long, ymin long, xmax long, ymax long"


def test_overlapping_exclusions_count_once(spark):
    rng = random.Random(6)
    box = lambda far, size: (x := rng.randrange(far), y := rng.randrange(far), x + rng.randrange(1, size), y + rng.randrange(1, size))
    spaces = {i: box(60, 20) for i in range(60)} | {100: (200, 200, 210, 210), 101: (300, 300, 310, 310), 102: (400, 400, 410, 410)}
    out = [box(60, 15) for _ in range(60)] + [(200, 200, 205, 210)] * 2 + [(200, 200, 205, 209), (300, 300, 306, 310), (304, 290, 310, 320)]
    df = spark.createDataFrame([(i, *b) for i, b in spaces.items()], BOXED)
    ex = spark.createDataFrame([(i, *b) for i, b in enumerate(out)], BOXED)
    want = {i: (b[2] - b[0]) * (b[3] - b[1]) - union_area(out, b) for i, b in spaces.items()}
    got = {r.osm_id: round(r.area_ha * 10000) for r in places.cut_exclusions(df, ex, "osm_id", 16.0).collect()}
    assert got == {i: a for i, a in want.items() if a} and got[100] == 50 and 101 not in got


def test_clusters_have_the_area_of_their_union(spark):
    rng = random.Random(7)
    rows = []
    for i in range(90):
        x, y = rng.randrange(70), rng.randrange(70)
        rows.append((i, x, y, x + rng.randrange(1, 15), y + rng.randrange(1, 15), i % 3 != 0, i % 3 == 1, i % 4 == 0))
    rows += [(200 + i, 300, 300, 310, 310, True, False, i < 2) for i in range(5)]
    df = spark.createDataFrame(rows, BOXED + ", public_access boolean, within_public boolean, water_feature boolean").withColumns({"linear_feature": F.lit(False), "acceptable_linear_feature": F.lit(None).cast("boolean"), "linear_tag": F.lit(None).cast("boolean")})
    group = {r[0]: r[0] for r in rows}

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[5] == b[5] and a[1] <= b[3] and b[1] <= a[3] and a[2] <= b[4] and b[2] <= a[4]:
                low, high = sorted((find(a[0]), find(b[0])))
                group[high] = low
    want = {}
    for root in set(map(find, group)):
        own = [r for r in rows if find(r[0]) == root]
        want[root] = (len(own), union_area([r[1:5] for r in own]), *[union_area([r[1:5] for r in own if r[k]]) for k in (5, 7)])
    got = {r.aos_id: (r.members, *[round(a * 10000) for a in (r.aos_ha, r.aos_ha_public, r.aos_ha_water)]) for r in places.open_space_clusters(df, "osm_id", 16.0).collect()}
    assert got == want and got[200] == (5, 100, 100, 100)


def test_exact_quantiles(spark):
    import numpy as np

    from urbanframe.operators.quantiles import quantiles

    draw = np.random.default_rng(4)
    values = [*draw.normal(0, 1, 800).tolist(), *[2.5] * 700, 1e9, -1e9]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 5, "v double")
    shares = [0.0, 0.2, 0.5, 0.61, 0.8, 1.0]
    for few in (10, 10**6):
        assert np.allclose(quantiles(df, "v", shares, few), np.quantile(values, shares))
    assert quantiles(df.where("v > 1e12"), "v", shares) == [None] * 6


def test_components_in_rounds(spark):
    from urbanframe.operators import graph

    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    df = spark.createDataFrame(chain, "a long, b long")
    for one_task in (0, 10**6):
        got = {r.node: r.component for r in graph.components(df, one_task=one_task).collect()}
        assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_polygon_covers_and_far_edges(spark):
    from pyspark.sql import functions as F

    from urbanframe.functions import geometry as g
    from urbanframe.operators import spatial as sp

    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 9.0, 9.0), (3, 60_000.0, 0.0)], "id int, x double, y double")
    corner = [g.make_point(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (10.0, 0.0), (0.0, 10.0))]
    triangle = spark.range(1).select(F.lit(0.0).alias("xmin"), F.lit(0.0).alias("ymin"), F.lit(10.0).alias("xmax"), F.lit(10.0).alias("ymax"), F.array(F.array(*corner)).alias("polygon"))
    assert [r.id for r in sp.semi_any(points, [triangle], "id", 20.0).collect()] == [1]
    line = spark.range(1).select(F.lit(5).alias("ogc_fid"), F.array(*corner[:2]).alias("line"))
    found = {r.id: (r.ogc_fid, r.distance) for r in sp.nearest_edge(points, line, "id").collect()}
    assert found == {1: (5, 1.0), 2: (5, 9.0), 3: (5, 59_990.0)}


@pytest.mark.parametrize("config,want", [({}, "pop_est"), ({"population_denominator": "PEOPLE"}, "people"), ({"population_denominator": "Res", "vector_population_data_field": "RES"}, "pop_est"), ({"population_denominator": "jobs", "vector_population_data_field": "res"}, "jobs")])
def test_population_denominator(config, want):
    assert ind.population_denominator(config) == want


def test_identifying_keys_go(spark):
    tags = F.create_map(*[F.lit(v) for k in ("leisure", "Name:en", "addr:street", "phone", "surface") for v in (k, "x")])
    assert sorted(one(spark.range(1).select(F.map_keys(sc.without_keys(tags)).alias("k"))).k) == ["leisure", "surface"]


def test_hottest_third_runs_into_the_next_year(spark):
    rows = [(1, f"{y}-{m:02d}-15 00:00:00", float(v)) for y, m, v in [(2024, 10, 1), (2024, 11, 30), (2024, 12, 31), (2025, 1, 32), (2025, 2, 33), (2025, 3, 2), (2024, 2, 5), (2024, 6, 1)]]
    px = spark.createDataFrame(rows, "pixel_id int, t string, b double").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    assert sorted(r.b for r in pixels.in_hottest_third(px, "b", 2024).collect()) == [30.0, 31.0, 32.0, 33.0]
