"""Street network operators on edge and node tables."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanframe.functions.scalars import half_even
from urbanframe.operators.graph import components, components_by_place
from urbanframe.operators.spatial import block_of, nearest_edge, with_point_box, within_distance
from urbanframe.session import checkpointed


def oriented_edges(edges: DataFrame) -> DataFrame:
    """``from, to`` of every edge: as stored for key 2, else reversed."""
    kept = F.col("edge_key") == 2
    return edges.withColumns({"from": F.when(kept, F.col("u")).otherwise(F.col("v")), "to": F.when(kept, F.col("v")).otherwise(F.col("u"))})


def adjacency(edges: DataFrame) -> DataFrame:
    """``node, next, length`` in both directions, the shortest of parallel edges."""
    ways = F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("next")), F.struct(F.col("v").alias("node"), F.col("u").alias("next"))))
    return edges.select(ways.alias("w"), "length").groupBy("w.node", "w.next").agg(F.min("length").alias("length")).select("node", "next", "length")


def filter_components(edges: DataFrame, min_nodes: int = 0, retain_all: bool = True) -> DataFrame:
    """Edges of components with at least ``min_nodes`` nodes; else of the largest one (lowest id on ties)."""
    label = checkpointed(components(edges, "u", "v"))
    sizes = label.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    kept = sizes.where(F.col("n") >= min_nodes) if retain_all else sizes.orderBy(F.desc("n"), "component").limit(1)
    nodes = label.join(kept, "component", "left_semi").select(F.col("node").alias("u"))
    return edges.join(nodes, "u", "left_semi")


def compose(networks: list[DataFrame]) -> DataFrame:
    """Union of networks, an edge once per ``u, v, edge_key``."""
    out = networks[0]
    for n in networks[1:]:
        out = out.unionByName(n)
    return out.dropDuplicates(["u", "v", "edge_key"])


def subgraph(edges: DataFrame, nodes: DataFrame, key: str = "osmid") -> DataFrame:
    """Edges with both ends among the nodes."""
    ids = nodes.select(key).distinct()
    return edges.join(ids.withColumnRenamed(key, "u"), "u", "left_semi").join(ids.withColumnRenamed(key, "v"), "v", "left_semi")


def reach(edges: DataFrame, sources: DataFrame, limit: float, source: str = "osmid") -> DataFrame:
    """``src, node, dist``: network distances up to ``limit`` from each source, itself at 0.

    A frontier grows edge by edge. Only pairs that got nearer go on, distances
    are combined before each shuffle, each round's gains alone are written to the
    shared folder, and the loop ends when nothing improves. The nearest of all
    gains is the distance.
    """
    ways = checkpointed(adjacency(edges))
    frontier = checkpointed(sources.select(F.col(source).alias("src")).distinct().select("src", F.col("src").alias("node"), F.lit(0).cast(ways.schema["length"].dataType).alias("dist")))
    known = frontier
    while True:
        step = frontier.join(ways, "node").select("src", F.col("next").alias("node"), (F.col("dist") + F.col("length")).alias("dist")).where(F.col("dist") <= limit)
        step = step.withColumn("new", F.lit(True)).unionByName(known.withColumn("new", F.lit(False)))
        best = step.groupBy("src", "node").agg(F.min(F.when(F.col("new"), F.col("dist"))).alias("dist"), F.min(F.when(~F.col("new"), F.col("dist"))).alias("_old"))
        frontier = checkpointed(best.where("dist IS NOT NULL AND (_old IS NULL OR dist < _old)").drop("_old"))
        if not frontier.limit(1).count():
            return known.groupBy("src", "node").agg(F.min("dist").alias("dist"))
        known = known.unionByName(frontier)


#: Sources handled at a time in a task.
SOURCES = 128


def relaxed(sources: np.ndarray, ends: np.ndarray, length: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sources, nodes and their distances up to ``limit`` along edges (``ends`` has two columns), all sources of a block at once.

    Nodes of most ways come first, so the k-th ways of all nodes that have as
    many are one step over whole rows of distances.
    """
    node, ends = np.unique(ends, return_inverse=True)
    ends = ends.reshape(-1, 2)
    a, b = np.concatenate([ends[:, 0], ends[:, 1]]), np.concatenate([ends[:, 1], ends[:, 0]])
    degree = np.bincount(b, minlength=len(node))
    place = np.empty(len(node), np.int64)
    place[np.argsort(-degree, kind="stable")] = np.arange(len(node))
    named = np.empty_like(node)
    named[place] = node
    order = np.argsort(place[b], kind="stable")
    a, b, weight = place[a][order], place[b][order], np.tile(length, 2)[order]
    rank = np.arange(len(b)) - np.searchsorted(b, b)
    steps = [(a[rank == k], weight[rank == k, None]) for k in range(degree.max())]
    out = []
    for i in range(0, len(sources), SOURCES):
        src = sources[i : i + SOURCES]
        far = np.full((len(node), len(src)), np.inf)
        far[place[np.searchsorted(node, src)], np.arange(len(src))] = 0
        better = True
        while better:
            better = False
            for back, long in steps:
                way = far[back] + long
                nearer = (way < far[: len(back)]) & (way <= limit)
                if nearer.any():
                    np.copyto(far[: len(back)], way, where=nearer)
                    better = True
        column, row = np.nonzero(np.isfinite(far).T)
        out.append((src[column], named[row], far[row, column]))
    return tuple(np.concatenate(c) for c in zip(*out))


def reach_by_tile(edges: DataFrame, sources: DataFrame, limit: float, source: str = "osmid", cell: float | None = None) -> DataFrame:
    """As ``reach``, from edges with their ends' places (``ux, uy, vx, vy``), in one shuffle.

    A way of at most ``limit`` stays within ``limit`` of its source as the crow
    flies (less, where an edge is shorter than the straight line between its
    ends; the smallest such ratio is measured). So sources are dealt to tiles,
    every edge to the tiles that it may serve, and each task has all it needs:
    it relaxes all edges for many sources at once until nothing improves.
    """
    cell = float(cell or limit)
    kind = edges.schema["length"].dataType
    span = F.sqrt((F.col("ux") - F.col("vx")) ** 2 + (F.col("uy") - F.col("vy")) ** 2)
    ratio = edges.agg(F.min(F.when(span > 0, F.col("length") / span))).first()[0]
    wide = float(limit) / min(1.0, ratio) if ratio else float(limit)
    tile = lambda c, m: F.floor((c + m) / F.lit(cell)).cast("bigint")
    ends_of = F.explode(F.array(*[F.struct(F.col(n).alias("node"), F.col(f"{n}x").cast("double").alias("x"), F.col(f"{n}y").cast("double").alias("y")) for n in "uv"]))
    places = edges.select(ends_of.alias("e")).groupBy("e.node").agg(F.min("e.x").alias("x"), F.min("e.y").alias("y"))
    ids = checkpointed(sources.select(F.col(source).alias("node")).distinct().join(places, "node", "left"))
    own = ids.where("x IS NOT NULL").select(F.col("node").alias("src"), tile(F.col("x"), 0.0).alias("_tx"), tile(F.col("y"), 0.0).alias("_ty"))
    low, high = {c: F.least(f"u{c}", f"v{c}") for c in "xy"}, {c: F.greatest(f"u{c}", f"v{c}") for c in "xy"}
    served = edges.select("u", "v", F.col("length").cast("double").alias("length"), *[F.sequence(tile(low[c], -wide), tile(high[c], wide)).alias(f"_{c}s") for c in "xy"])
    served = served.select("u", "v", "length", F.explode("_xs").alias("_tx"), "_ys").select("u", "v", "length", "_tx", F.explode("_ys").alias("_ty"))

    def relax(starts: pd.DataFrame, ways: pd.DataFrame) -> pd.DataFrame:
        src = starts["src"].to_numpy()
        if len(src) and len(ways):
            found = relaxed(src, ways[["u", "v"]].to_numpy(), ways["length"].to_numpy(), limit)
        else:
            found = (src, src, np.zeros(len(src)))
        return pd.DataFrame(dict(zip(("src", "node", "dist"), found))).astype({"src": "int64", "node": "int64", "dist": "float64"})

    keys = ["_tx", "_ty"]
    found = own.groupBy(*keys).cogroup(served.join(own.select(*keys).distinct(), keys, "left_semi").groupBy(*keys)).applyInPandas(relax, "src long, node long, dist double")
    alone = ids.where("x IS NULL").select(F.col("node").alias("src"), "node", F.lit(0.0).alias("dist"))
    return found.unionByName(alone).withColumn("dist", F.col("dist").cast(kind))


def associate(points: DataFrame, edges: DataFrame, point_id: str, farthest: float | None = None) -> DataFrame:
    """Points with their nearest edge's ends and whole-metre offsets along it:
    ``edge_ogc_fid, n1, n2, n1_distance, n2_distance, match_distance``."""
    found = nearest_edge(points, edges, point_id, farthest=farthest)
    shape = edges.select("ogc_fid", F.col("u").alias("n1"), F.col("v").alias("n2"), F.sqrt((F.col("ux") - F.col("vx")) ** 2 + (F.col("uy") - F.col("vy")) ** 2).alias("_line"))
    joined = found.join(shape, "ogc_fid")
    return joined.select(
        point_id,
        F.col("ogc_fid").alias("edge_ogc_fid"),
        "n1",
        "n2",
        F.rint("before").cast("int").alias("n1_distance"),
        F.rint(F.greatest(F.lit(0.0), F.col("_line") - F.col("before"))).cast("int").alias("n2_distance"),
        F.col("distance").alias("match_distance"),
    )


def ends(pois: DataFrame, *keep: str) -> DataFrame:
    """``node, offset`` of both ends of every associated point, in one pass."""
    both = F.explode(F.array(F.struct(F.col("n1").alias("node"), F.col("n1_distance").alias("offset")), F.struct(F.col("n2").alias("node"), F.col("n2_distance").alias("offset"))))
    return pois.select(*keep, both.alias("_e")).select(*keep, "_e.node", "_e.offset")


def seed_nodes(layers: list[DataFrame]) -> DataFrame:
    """Distinct end nodes of associated points of all layers."""
    out = None
    for layer in layers:
        rows = ends(layer).select(F.col("node").alias("osmid"))
        out = rows if out is None else out.unionByName(rows)
    return out.distinct()


def nearest_poi(distances: DataFrame, pois: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Per node the distance to the nearest point of each condition, offsets included.

    ``distances`` goes from seeds (``src``) to nodes. All conditions share one
    shuffle; an offset may carry the total past the search distance.
    """
    flags = pois.withColumns({f"_c_{k}": c for k, c in conditions.items()})
    seeds = ends(flags, *[f"_c_{k}" for k in conditions]).groupBy(F.col("node").alias("src")).agg(*[F.min(F.when(F.col(f"_c_{k}"), F.col("offset"))).alias(k) for k in conditions])
    return distances.join(seeds, "src").groupBy("node").agg(*[F.min(F.col("dist") + F.col(k)).alias(k) for k in conditions])


def point_estimates(points: DataFrame, nodes: DataFrame, distances: list[str], densities: list[str], point_id: str = "point_id") -> DataFrame:
    """Node values carried to points between two nodes.

    A point on a node takes that node's values. Others take the least of value
    plus offset for distances, and for densities the sum weighted by nearness,
    without renewed weights where an end has no value (none at all gives 0).
    """
    whole = F.greatest(F.col("n1_distance") + F.col("n2_distance"), F.lit(1))
    end = lambda n, offset, weight, on: F.struct(F.col(n).alias("node"), offset.cast("double").alias("offset"), weight.cast("double").alias("weight"), F.lit(on).alias("on_node"))
    zero, one = F.lit(0.0), F.lit(1.0)
    spots = F.when(F.col("n1_distance") == 0, F.array(end("n1", zero, one, True))).when(F.col("n2_distance") == 0, F.array(end("n2", zero, one, True))).otherwise(
        F.array(end("n1", F.col("n1_distance"), 1 - F.col("n1_distance") / whole, False), end("n2", F.col("n2_distance"), 1 - F.col("n2_distance") / whole, False))
    )
    rows = points.select(point_id, F.explode(spots).alias("e")).select(point_id, "e.*").join(nodes, "node", "left")
    outs = [F.min(F.col(c) + F.col("offset")).alias(c) for c in distances]
    for c in densities:
        total = F.sum(F.col(c) * F.col("weight"))
        outs.append(F.when(F.first("on_node"), total).otherwise(F.coalesce(total, F.lit(0.0))).alias(c))
    return rows.groupBy(point_id).agg(*outs)


def neighbourhood_mean(reached: DataFrame, node_cell: DataFrame, grid: DataFrame, columns: list[str]) -> DataFrame:
    """Per source the plain mean over distinct grid cells of the nodes it reaches."""
    cells = reached.join(node_cell.where("grid_id IS NOT NULL"), "node").select("src", "grid_id").distinct()
    return cells.join(grid.select("grid_id", *columns), "grid_id").groupBy("src").agg(*[F.avg(c).alias(c) for c in columns])


def evaluated_nodes(node_cell: DataFrame, points: DataFrame | None = None) -> DataFrame:
    """Nodes in a grid cell, and those that points use where these are given."""
    nodes = node_cell.where("grid_id IS NOT NULL").select(F.col("node").alias("osmid"))
    return nodes.unionByName(seed_nodes([points])).distinct() if points is not None else nodes.distinct()


def require_both_nodes(points: DataFrame, nodes: DataFrame, key: str = "osmid") -> DataFrame:
    """Points both of whose end nodes are evaluated."""
    ids = nodes.select(key).distinct()
    return points.join(ids.withColumnRenamed(key, "n1"), "n1", "left_semi").join(ids.withColumnRenamed(key, "n2"), "n2", "left_semi")


def _labelled(nodes: DataFrame, edges: DataFrame, tolerance: float) -> DataFrame:
    """Nodes of two edges or more with the ``component`` of those within twice the tolerance of each other."""
    degree = ends(edges.select(F.col("u").alias("n1"), F.lit(0).alias("n1_distance"), F.col("v").alias("n2"), F.lit(0).alias("n2_distance"))).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    kept = checkpointed(nodes.join(degree.where("degree >= 2").select(F.col("node").alias("osmid")), "osmid", "left_semi").select("osmid", "x", "y"))
    boxed = with_point_box(kept)
    near = within_distance(boxed, boxed, 2 * tolerance).where("a_osmid < b_osmid")
    label = components_by_place(near.select(F.col("a_osmid").alias("a"), F.col("b_osmid").alias("b"), *block_of(max(5 * tolerance, 1.0))), ["_bx", "_by"])
    return kept.join(label.withColumnRenamed("node", "osmid"), "osmid", "left").withColumn("component", F.coalesce("component", "osmid"))


def consolidate_intersections(nodes: DataFrame, edges: DataFrame, tolerance: float = 12.0) -> DataFrame:
    """Intersections within reach of each other's tolerance as one: ``component, x, y, members``.

    Dead ends are left out. The place is the mean of the merged nodes.
    """
    merged = _labelled(nodes, edges, tolerance)
    return merged.groupBy("component").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.count(F.lit(1)).alias("members"))


def merged_discs(nodes: DataFrame, group: str, radius: float) -> DataFrame:
    """``group, members, area, x, y``: area and centroid of the union of discs around each group's nodes (``osmid, x, y``).

    The union's boundary is what each circle's neighbours leave of it; area and
    moments are line integrals along these arcs (Green's theorem), so they are
    exact and need one row a node. Nodes on one place have one disc.
    """
    corner = nodes.groupBy(group).agg(F.min("x").cast("double").alias("_ox"), F.min("y").cast("double").alias("_oy"), F.count(F.lit(1)).alias("members"))
    spots = checkpointed(nodes.select(group, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).distinct().join(corner.select(group, "_ox", "_oy"), group))
    spots = spots.withColumn("_id", F.struct(group, "x", "y"))
    boxed = with_point_box(spots.select("_id", "x", "y"))
    pairs = within_distance(boxed, boxed, 2 * radius).where((F.col("a__id") != F.col("b__id")) & (F.col(f"a__id.{group}") == F.col(f"b__id.{group}")) & (F.col("distance") < 2 * radius))
    turn, half = F.atan2(F.col("b_y") - F.col("a_y"), F.col("b_x") - F.col("a_x")), F.acos(F.col("distance") / (2 * radius))
    whole = F.lit(2 * math.pi)
    low = F.pmod(turn - half, whole)
    covered = F.array_agg(F.struct(low.alias("lo"), (low + 2 * half).alias("hi"))).alias("_covered")
    rows = spots.join(pairs.groupBy(F.col("a__id").alias("_id")).agg(covered), "_id", "left")
    # An interval over the start of the circle is two.
    split = F.flatten(F.transform(F.coalesce("_covered", F.array().cast("array<struct<lo: double, hi: double>>")), lambda c: F.when(c["hi"] > whole, F.array(F.struct(F.lit(0.0).alias("lo"), (c["hi"] - whole).alias("hi")), F.struct(c["lo"].alias("lo"), whole.alias("hi")))).otherwise(F.array(c))))
    start = F.struct(F.lit(0.0).alias("at"), F.array().cast("array<struct<lo: double, hi: double>>").alias("free"))

    def step(s, c):
        gap = F.when(c["lo"] > s["at"], F.concat(s["free"], F.array(F.struct(s["at"].alias("lo"), c["lo"].alias("hi"))))).otherwise(s["free"])
        return F.struct(F.greatest(s["at"], c["hi"]).alias("at"), gap.alias("free"))

    last = F.array(F.struct(whole.alias("lo"), whole.alias("hi")))
    arcs = rows.select(group, (F.col("x") - F.col("_ox")).alias("cx"), (F.col("y") - F.col("_oy")).alias("cy"), F.explode(F.aggregate(F.concat(F.array_sort(split), last), start, step)["free"]).alias("_arc"))
    cx, cy, r = F.col("cx"), F.col("cy"), F.lit(float(radius))

    def between(f):
        return f(F.col("_arc.hi")) - f(F.col("_arc.lo"))

    area = between(lambda t: r * r * t + r * (cx * F.sin(t) - cy * F.cos(t))) / 2
    mx = between(lambda t: r * (cx * cx * F.sin(t) + 2 * cx * r * (t / 2 + F.sin(2 * t) / 4) + r * r * (F.sin(t) - F.sin(t) * F.sin(t) * F.sin(t) / 3))) / 2
    my = between(lambda t: r * (-cy * cy * F.cos(t) + 2 * cy * r * (t / 2 - F.sin(2 * t) / 4) + r * r * (F.cos(t) * F.cos(t) * F.cos(t) / 3 - F.cos(t)))) / 2
    sums = arcs.groupBy(group).agg(F.sum(area).alias("area"), F.sum(mx).alias("_mx"), F.sum(my).alias("_my"))
    return sums.join(corner, group).select(group, "members", "area", (F.col("_ox") + F.col("_mx") / F.col("area")).alias("x"), (F.col("_oy") + F.col("_my") / F.col("area")).alias("y"))


def consolidate_discs(nodes: DataFrame, edges: DataFrame, tolerance: float = 12.0) -> DataFrame:
    """As ``consolidate_intersections``, at the centroid of the merged discs of radius ``tolerance``: ``component, members, area, x, y``."""
    return merged_discs(_labelled(nodes, edges, tolerance), "component", tolerance)


def whole_metres(df: DataFrame, columns: list[str], unreached: float | None = -999) -> DataFrame:
    """Distances as integers, halves to even; the mark for not reached becomes null."""
    return df.withColumns({c: F.when(F.col(c) != unreached, half_even(F.col(c)).cast("int")) for c in columns})
