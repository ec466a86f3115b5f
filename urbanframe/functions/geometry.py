"""Geometry as column expressions.

A point is ``struct<x, y>``, a line ``array<struct<x, y>>``, a polygon an array
of rings (ring 0 the shell, the others holes), each an array of points; rings
may or may not repeat their first point. Higher-order functions keep all of it
in the plan.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def make_point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"]))


def rectangle(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    """A rectangle as a polygon of one ring."""
    return F.array(F.array(make_point(xmin, ymin), make_point(xmax, ymin), make_point(xmax, ymax), make_point(xmin, ymax)))


def _segments(line: Column, closed: bool = False) -> Column:
    """Array of ``struct<a, b>`` of consecutive points."""
    n = F.size(line)
    last = n if closed else n - 1
    point = lambda i: F.element_at(line, i)
    steps = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda i: F.struct(point(i).alias("a"), point(F.when(i < n, i + 1).otherwise(F.lit(1))).alias("b")))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def ring_signed_area(ring: Column) -> Column:
    cross = F.transform(_segments(ring, True), lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"])
    return _total(cross) / 2


def area(polygon: Column) -> Column:
    """Area of a polygon: its shell less its holes."""
    each = F.transform(polygon, lambda r: F.abs(ring_signed_area(r)))
    return F.element_at(each, 1) * 2 - _total(each)


def length(line: Column) -> Column:
    return _total(F.transform(_segments(line), lambda s: distance(s["a"], s["b"])))


def contains(polygon: Column, point: Column) -> Column:
    """Ray-crossing parity over all rings; half-open, so a point on a border shared
    by two polygons is in one of them."""
    def crossings(ring: Column) -> Column:
        def crosses(s: Column) -> Column:
            a, b = s["a"], s["b"]
            straddles = (a["y"] > point["y"]) != (b["y"] > point["y"])
            at = F.when(straddles, (b["x"] - a["x"]) * (point["y"] - a["y"]) / (b["y"] - a["y"]) + a["x"])
            return F.when(straddles & (point["x"] < at), 1.0).otherwise(0.0)

        return _total(F.transform(_segments(ring, True), crosses))

    return _total(F.transform(polygon, crossings)) % 2 == 1


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _numbers(values: pa.Array) -> np.ndarray:
    return values.to_numpy(zero_copy_only=False).astype(np.float64)


def _xy(points: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    x, y = points.flatten()[:2]
    return _numbers(x), _numbers(y)


def closed_edges(rings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edges of closed rings (rows ``ax, ay, bx, by``), each edge's ring, and each ring's number of points."""
    size = _sizes(rings)
    x, y = _xy(rings.flatten())
    after, stop = np.arange(len(x)) + 1, np.cumsum(size)
    after[stop[size > 0] - 1] = (stop - size)[size > 0]
    return np.stack([x, y, x[after], y[after]], 1), np.repeat(np.arange(len(rings)), size), size


def _held(polygon: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
    edges, ring, _ = closed_edges(polygon.flatten())
    row = np.repeat(np.arange(len(polygon)), _sizes(polygon))[ring]
    (ax, ay, bx, by), px, py = edges.T, _numbers(x)[row], _numbers(y)[row]
    straddles = (ay > py) != (by > py)
    with np.errstate(divide="ignore", invalid="ignore"):
        crosses = straddles & (px < (bx - ax) * (py - ay) / (by - ay) + ax)
    return pa.array(np.bincount(row[crosses], minlength=len(polygon)) % 2 == 1)


def holds(polygon: Column, x: Column, y: Column) -> Column:
    """As ``contains``, by batches: for the many pairs of a join.

    Marked as nondeterministic so that the planner neither moves it into the join's
    condition nor repeats it.
    """
    return F.arrow_udf(_held, "boolean").asNondeterministic()(polygon, x, y)


def _extent(polygon: pa.Array) -> pa.Array:
    n = _sizes(polygon)
    edges, ring, size = closed_edges(polygon.flatten())
    ax, ay, bx, by = edges.T
    each = np.abs(np.bincount(ring, ax * by - bx * ay, len(size)) / 2)
    out = -np.bincount(np.repeat(np.arange(len(polygon)), n), each, len(polygon)).astype(float)
    out[n > 0] += 2 * each[(np.cumsum(n) - n)[n > 0]]
    return pa.array(out, mask=(n == 0) | np.isnan(out))


def extent(polygon: Column) -> Column:
    """As ``area``, by batches: for whole tables (see ``holds``; nor does a filter on it go below a shuffle).

    A polygon without rings has none.
    """
    return F.arrow_udf(_extent, "double").asNondeterministic()(polygon)


def segment_position(a: Column, b: Column, p: Column) -> Column:
    """Fraction of the way from ``a`` to ``b`` that is nearest to ``p``."""
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    t = F.try_divide((p["x"] - a["x"]) * dx + (p["y"] - a["y"]) * dy, dx * dx + dy * dy)
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(t, F.lit(0.0))))


def _along(a: Column, b: Column, t: Column) -> Column:
    return make_point(a["x"] + (b["x"] - a["x"]) * t, a["y"] + (b["y"] - a["y"]) * t)


def nearest_on_line(line: Column, p: Column) -> Column:
    """``struct<distance, before, point>`` of the nearest place of a line, where
    ``before`` is the length up to it; ties take the first segment."""
    def place(s: Column) -> Column:
        t = segment_position(s["a"], s["b"], p)
        at = _along(s["a"], s["b"], t)
        return F.struct(distance(at, p).alias("distance"), (distance(s["a"], s["b"]) * t).alias("part"), distance(s["a"], s["b"]).alias("length"), at.alias("point"))

    places = F.transform(_segments(line), place)
    none = F.lit(None)
    start = F.struct(none.cast("double").alias("distance"), none.cast("double").alias("before"), none.cast("struct<x: double, y: double>").alias("point"), F.lit(0.0).alias("run"))

    def step(s: Column, q: Column) -> Column:
        better = s["distance"].isNull() | (q["distance"] < s["distance"])
        return F.struct(
            F.when(better, q["distance"]).otherwise(s["distance"]).alias("distance"),
            F.when(better, s["run"] + q["part"]).otherwise(s["before"]).alias("before"),
            F.when(better, q["point"]).otherwise(s["point"]).alias("point"),
            (s["run"] + q["length"]).alias("run"),
        )

    return F.aggregate(places, start, step)


def _nearest(line: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
    size, (lx, ly) = _sizes(line), _xy(line.flatten())
    first, px, py = np.cumsum(size) - size, _numbers(x), _numbers(y)
    best, before, mx, my = (np.full(len(line), np.nan) for _ in range(4))
    run, known = np.zeros(len(line)), np.zeros(len(line), bool)
    # Segment by segment, so that lengths add up in the order of the line.
    for k in range(1, int(size.max(initial=0))):
        i = np.flatnonzero(size > k)
        a = first[i] + k - 1
        ax, ay, bx, by = lx[a], ly[a], lx[a + 1], ly[a + 1]
        dx, dy = bx - ax, by - ay
        square = dx * dx + dy * dy
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.where(square == 0, 0.0, ((px[i] - ax) * dx + (py[i] - ay) * dy) / square)
        t = np.maximum(0.0, np.minimum(1.0, t))
        sx, sy = ax + dx * t, ay + dy * t
        far = np.sqrt((sx - px[i]) * (sx - px[i]) + (sy - py[i]) * (sy - py[i]))
        long = np.sqrt((ax - bx) * (ax - bx) + (ay - by) * (ay - by))
        better = ~known[i] | (far < best[i])
        j = i[better]
        best[j], before[j], mx[j], my[j] = far[better], run[j] + (long * t)[better], sx[better], sy[better]
        known[i] = True
        run[i] += long
    return pa.StructArray.from_arrays([pa.array(c, mask=~known) for c in (best, before, mx, my)], names=["distance", "before", "x", "y"])


def nearest_place(line: Column, x: Column, y: Column) -> Column:
    """As ``nearest_on_line``, by batches, with the place as ``x, y``: for the many pairs of a join (see ``holds``)."""
    return F.arrow_udf(_nearest, "struct<distance: double, before: double, x: double, y: double>").asNondeterministic()(line, x, y)


def locate(line: Column, p: Column) -> Column:
    """Fraction of a line's length at its place nearest to ``p``."""
    return F.coalesce(F.try_divide(nearest_on_line(line, p)["before"], length(line)), F.lit(0.0))


def substring_length(line: Column, f1: Column, f2: Column) -> Column:
    """Length of the part of a line between two fractions."""
    return F.abs(f2 - f1) * length(line)


def interpolate(line: Column, metres: Column) -> Column:
    """Point at a distance along a line, held to its ends."""
    start = F.struct(F.lit(0.0).alias("run"), F.element_at(line, 1).cast("struct<x: double, y: double>").alias("point"))

    def step(s: Column, seg: Column) -> Column:
        d = distance(seg["a"], seg["b"])
        t = F.coalesce(F.try_divide(metres - s["run"], d), F.lit(0.0))
        point = F.when(metres > s["run"], _along(seg["a"], seg["b"], F.least(F.lit(1.0), t))).otherwise(s["point"])
        return F.struct((s["run"] + d).alias("run"), point.alias("point"))

    return F.aggregate(_segments(line), start, step)["point"]


def bbox(polygon: Column) -> Column:
    """``struct<xmin, ymin, xmax, ymax>`` of a polygon."""
    shell = F.element_at(polygon, 1)
    xs, ys = F.transform(shell, lambda p: p["x"]), F.transform(shell, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def expand(box: Column, d: float) -> Column:
    return F.struct((box["xmin"] - d).alias("xmin"), (box["ymin"] - d).alias("ymin"), (box["xmax"] + d).alias("xmax"), (box["ymax"] + d).alias("ymax"))


def box_overlap_area(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Shared area of two rectangles given as ``xmin, ymin, xmax, ymax``."""
    w = F.least(a["xmax"], b["xmax"]) - F.greatest(a["xmin"], b["xmin"])
    h = F.least(a["ymax"], b["ymax"]) - F.greatest(a["ymin"], b["ymin"])
    return F.greatest(F.lit(0), w) * F.greatest(F.lit(0), h)


def box_distance(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Distance of two rectangles (a point is an empty one); 0 where they meet."""
    gap = lambda lo, hi: F.greatest(F.lit(0), a[lo] - b[hi], b[lo] - a[hi])
    dx, dy = gap("xmin", "xmax").cast("double"), gap("ymin", "ymax").cast("double")
    return F.sqrt(dx * dx + dy * dy)


def box_shared_border(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Length of the border that two touching rectangles share; 0 if they overlap or are apart."""
    w = F.least(a["xmax"], b["xmax"]) - F.greatest(a["xmin"], b["xmin"])
    h = F.least(a["ymax"], b["ymax"]) - F.greatest(a["ymin"], b["ymin"])
    return F.when((w == 0) & (h >= 0), h).when((h == 0) & (w >= 0), w).otherwise(0)


def _signed_area(ring: list[tuple[float, float]]) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1])) / 2


def _fan(polygon: list) -> list[tuple[float, list[tuple[float, float]]]]:
    """Signed fan triangles of all rings, each counter-clockwise; holes count against."""
    out = []
    for i, ring in enumerate(polygon):
        points = [(p["x"], p["y"]) for p in ring]
        turn = (1 if _signed_area(points) >= 0 else -1) * (1 if i == 0 else -1)
        for a, b in zip(points[1:], points[2:]):
            t = [points[0], a, b]
            signed = _signed_area(t)
            if signed:
                out.append((turn if signed > 0 else -turn, t if signed > 0 else t[::-1]))
    return out


def _clipped(ring: list[tuple[float, float]], triangle: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Part of a convex ring inside a counter-clockwise triangle."""
    for a, b in zip(triangle, triangle[1:] + triangle[:1]):
        side = [(b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) for p in ring]
        out = []
        for i, (p, s) in enumerate(zip(ring, side)):
            q, r = ring[i - 1], side[i - 1]
            if (s >= 0) != (r >= 0):
                t = r / (r - s)
                out.append((q[0] + (p[0] - q[0]) * t, q[1] + (p[1] - q[1]) * t))
            if s >= 0:
                out.append(p)
        ring = out
        if not ring:
            break
    return ring


def overlap_area(p: Column, q: Column) -> Column:
    """Shared area of two simple polygons, holes included.

    Signed sums over pairs of fan triangles, in one vectorised UDF call per
    batch: as nested column lambdas the expression passes the analyzer's limit.
    Rectangles have ``box_overlap_area``, which stays in the plan.
    """

    @F.pandas_udf("double")
    def run(ps: pd.Series, qs: pd.Series) -> pd.Series:
        out = []
        for a, b in zip(ps, qs):
            if a is None or b is None:
                out.append(None)
                continue
            fan_b = _fan(b)
            out.append(sum(s * t * abs(_signed_area(c)) for s, one in _fan(a) for t, two in fan_b if (c := _clipped(one, two))))
        return pd.Series(out, dtype="float64")

    return run(p, q)


def difference_area(p: Column, q: Column) -> Column:
    """Area of ``p`` outside ``q``."""
    return F.greatest(F.lit(0.0), area(p) - overlap_area(p, q))


def centroid(polygon: Column) -> Column:
    """Area-weighted centroid; a shape without area gives the mean of its points."""
    def moments(ring: Column, i: Column) -> Column:
        segs = _segments(ring, True)
        cross = lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]
        turn = F.signum(ring_signed_area(ring)) * F.when(i > 0, -1.0).otherwise(1.0)
        return F.struct(
            (turn * _total(F.transform(segs, cross)) / 2).alias("m"),
            (turn * _total(F.transform(segs, lambda s: (s["a"]["x"] + s["b"]["x"]) * cross(s))) / 6).alias("mx"),
            (turn * _total(F.transform(segs, lambda s: (s["a"]["y"] + s["b"]["y"]) * cross(s))) / 6).alias("my"),
        )

    each = F.transform(polygon, moments)
    shell = F.element_at(polygon, 1)
    part = lambda name: _total(F.transform(each, lambda m: m[name]))
    mean = lambda axis: _total(F.transform(shell, lambda p: p[axis].cast("double"))) / F.size(shell)
    return make_point(F.coalesce(F.try_divide(part("mx"), part("m")), mean("x")), F.coalesce(F.try_divide(part("my"), part("m")), mean("y")))


def exterior(polygon: Column) -> Column:
    return F.element_at(polygon, 1)


def parts(multipolygon: Column) -> Column:
    """One row per polygon of a multipolygon."""
    return F.explode(multipolygon)


def min_circle(polygon: Column) -> Column:
    """``struct<x, y, r>`` of the smallest circle around a polygon's shell.

    Incremental construction in one vectorised UDF call per batch; the order of
    points is fixed, so results repeat.
    """

    @F.pandas_udf("struct<x: double, y: double, r: double>")
    def run(shells: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_circle([(p["x"], p["y"]) for p in s]) if s is not None and len(s) else (None, None, None) for s in shells], columns=["x", "y", "r"])

    return run(exterior(polygon))


def _circle(points: list[tuple[float, float]]) -> tuple[float, float, float]:
    def two(a, b):
        x, y = (a[0] + b[0]) / 2, (a[1] + b[1]) / 2
        return x, y, ((a[0] - x) ** 2 + (a[1] - y) ** 2) ** 0.5

    def three(a, b, c):
        d = 2 * (a[0] * (b[1] - c[1]) + b[0] * (c[1] - a[1]) + c[0] * (a[1] - b[1]))
        if not d:
            return max((two(a, b), two(a, c), two(b, c)), key=lambda q: q[2])
        sq = [p[0] ** 2 + p[1] ** 2 for p in (a, b, c)]
        x = (sq[0] * (b[1] - c[1]) + sq[1] * (c[1] - a[1]) + sq[2] * (a[1] - b[1])) / d
        y = (sq[0] * (c[0] - b[0]) + sq[1] * (a[0] - c[0]) + sq[2] * (b[0] - a[0])) / d
        return x, y, ((a[0] - x) ** 2 + (a[1] - y) ** 2) ** 0.5

    out = lambda c, p: (p[0] - c[0]) ** 2 + (p[1] - c[1]) ** 2 > c[2] ** 2 * (1 + 1e-12) + 1e-12
    circle = (*points[0], 0.0)
    for i, p in enumerate(points):
        if out(circle, p):
            circle = (*p, 0.0)
            for j, q in enumerate(points[:i]):
                if out(circle, q):
                    circle = two(p, q)
                    for r in points[:j]:
                        if out(circle, r):
                            circle = three(p, q, r)
    return circle


def roundness(polygon: Column) -> Column:
    """Area over the area of the smallest circle around it."""
    r = min_circle(polygon)["r"]
    return F.try_divide(area(polygon), F.lit(3.141592653589793) * r * r)
