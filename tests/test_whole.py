"""Registered queries over whole tables against plain Python."""

import heapq
import math
from collections import defaultdict

import pytest

from urbanframe.plans import catalogue
from urbanframe.plans.fixtures import view

QUERIES = catalogue.queries()


@pytest.fixture(scope="module")
def table(spark, data):
    return lambda name: view(spark, data, name).collect()


@pytest.fixture(scope="module")
def result(spark, data):
    return lambda name: QUERIES[name](spark, data).collect()


def open_spaces(table):
    return {r.osm_id for r in table("f_osm") if r.leisure is not None or r.landuse == "forest"}


def test_every_node_has_a_neighbourhood_of_a_kilometre(table, result):
    ways, place, people = defaultdict(list), {}, {r.grid_id: r.pop_est for r in table("f_grid")}
    for e in table("f_edges"):
        ways[e.u].append((e.v, e.length))
        ways[e.v].append((e.u, e.length))
    for n in table("f_nodes"):
        place[n.osmid] = (n.y // 250) * 1000 + n.x // 250
    want = {}
    for source in place:
        near, todo = {}, [(0, source)]
        while todo:
            d, n = heapq.heappop(todo)
            if n not in near:
                near[n] = d
                for m, w in ways[n]:
                    if d + w <= 1000:
                        heapq.heappush(todo, (d + w, m))
        cells = {place[n] for n in near}
        want[source] = round(sum(people[c] for c in cells) / len(cells), 4)
    assert {r.src: round(r.pop_est, 4) for r in result("net_neighbourhood")} == want


def test_points_of_every_edge_have_estimates(table, result):
    nearest = {r.node: r.food for r in result("net_nearest_poi")}
    want = {}
    for e in sorted(table("f_edges"), key=lambda e: e.ogc_fid):
        length = math.dist((e.ux, e.uy), (e.vx, e.vy))
        for m in range(0, round(length) + 1, 30):
            part = min(1.0, m / length)
            a, b = round(part * length), round(max(0.0, (1 - part) * length))
            ends = [(e.u, 0)] if a == 0 else [(e.v, 0)] if b == 0 else [(e.u, a), (e.v, b)]
            want[len(want) + 1] = min((nearest[n] + d for n, d in ends if nearest.get(n) is not None), default=None)
    assert {r.point_id: r.food for r in result("net_point_estimates")} == want


def test_all_edges_count_for_intersections(table, result):
    degree = defaultdict(int)
    for e in table("f_edges"):
        degree[e.u] += 1
        degree[e.v] += 1
    kept = [n for n in table("f_nodes") if degree[n.osmid] >= 2]
    root = {n.osmid: n.osmid for n in kept}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in kept:
        for b in kept:
            if a.osmid < b.osmid and math.dist((a.x, a.y), (b.x, b.y)) <= 70:
                low, high = sorted((find(a.osmid), find(b.osmid)))
                root[high] = low
    want = defaultdict(int)
    for n in kept:
        want[find(n.osmid)] += 1
    assert {r.component: r.members for r in result("net_intersections")} == want


def test_every_open_space_is_judged(table, result):
    linear, public = result("pos_linear"), result("pos_public")
    assert {r.osm_id for r in linear} == {r.osm_id for r in public} == open_spaces(table)
    shape = {r.osm_id: r for r in linear}
    unclassed = [r for r in public if r.within_public and not r.public_access and shape[r.osm_id].linear_feature and not shape[r.osm_id].acceptable_linear_feature and not shape[r.osm_id].linear_tag]
    assert sum(r.members for r in result("pos_clusters")) == len(public) - len(unclassed)


def test_every_feature_overlaps_what_it_meets(table, result):
    areas, want = table("f_areas"), {}
    for o in table("f_osm"):
        for a in areas:
            w, h = min(o.xmax, a.xmax) - max(o.xmin, a.xmin), min(o.ymax, a.ymax) - max(o.ymin, a.ymin)
            if w > 0 and h > 0:
                want[o.osm_id, a.area_id] = w * h
    assert {(r.osm_id, r.area_id): round(r.shared) for r in result("polygon_overlap")} == want


def test_all_rows_and_nodes_count(table, result):
    assert {r.row_id for r in result("src_policy")} == {r.p_partkey for r in table("part")}
    assert sum(r.intersection_count for r in result("grid_intersections")) == len(table("f_nodes"))
    cells = result("grid_intersections")
    inside = [c for c in cells if c.xmin <= 3600 and c.xmax >= 130 and c.ymin <= 3300 and c.ymax >= 130]
    assert result("region_totals")[0].intersection_count == sum(c.intersection_count for c in inside)
