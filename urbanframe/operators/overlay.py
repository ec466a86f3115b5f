"""Unions, differences and intersections of polygons, as areas and as shapes.

Polygons are dealt to tiles as directed edges (interior on the left; holes run
the other way). An edge goes to the tiles it meets and to those on its right
that its polygon may cover, where it stands at the left border; so every tile
knows on its own what covers it, and a polygon of any size is spread over many
tasks. In a tile, edges are split where they cross; between neighbouring
heights they don't, so a sweep from left to right that sums up the windings of
both sides finds the covered spans. Areas are sums over tiles. The boundaries
that tiles find are stitched: what two tiles report from both sides of a common
border cancels, the rest is linked to rings.

Rings may run either way and may or may not repeat their first point. Polygons
have to be simple (no ring crosses itself); they may overlap each other in any
number. Coordinates closer than ``EPS`` are one.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanframe.functions.geometry import _segments, _sizes, bbox, closed_edges, ring_signed_area
from urbanframe.operators.graph import components_by_place
from urbanframe.operators.spatial import BOX, block_of, box_join
from urbanframe.session import shuffled, written

#: Edges of a tile above which it is quartered before its sweep.
LIMIT = 256
DEEPEST = 16
#: Squares of edge counts of the tiles that share a sweep.
WORK = 200_000
EPS = 1e-7

KEPT = {
    "union": lambda a, b: (a > 0) | (b > 0),
    "difference": lambda a, b: (a > 0) & (b <= 0),
    "intersection": lambda a, b: (a > 0) & (b > 0),
}


def with_box(df: DataFrame, polygon: str = "polygon") -> DataFrame:
    """Boxes of polygons."""
    box = bbox(F.col(polygon))
    return df.withColumns({c: box[c] for c in BOX})


def _turned(polygon: Column) -> Column:
    """Segments of all rings, the interior on their left."""
    def turned(ring: Column, i: Column) -> Column:
        ahead = (ring_signed_area(ring) >= 0) == (i == 0)
        return F.transform(_segments(ring, True), lambda s: F.when(ahead, s).otherwise(F.struct(s["b"].alias("a"), s["a"].alias("b"))))

    return F.flatten(F.transform(polygon, turned))


def directed_edges(df: DataFrame, keys: list[str], polygon: str = "polygon") -> DataFrame:
    """``keys, ax, ay, bx, by, right``: edges that are not level, interior on the left; ``right`` is the polygon's xmax."""
    rows = df.select(*keys, bbox(F.col(polygon))["xmax"].cast("double").alias("right"), F.explode(_turned(F.col(polygon))).alias("_e"))
    return rows.select(*keys, *[F.col(f"_e.{p}.{c}").cast("double").alias(f"{p}{c}") for p in "ab" for c in "xy"], "right").where("ay <> by")


class _Pieces:
    """Parts of edges inside their tiles: heights ``lo`` to ``hi``, and ``x`` as a function of the height; in order of ``group``, the tile's number."""

    def __init__(self, edges: np.ndarray, side: np.ndarray, group: np.ndarray, tiles: np.ndarray):
        x0, y0, x1, y1 = tiles[group].T
        ax, ay, bx, by = edges.T
        up = by > ay
        lx, ly, hx, hy = np.where(up, ax, bx), np.where(up, ay, by), np.where(up, bx, ax), np.where(up, by, ay)
        slope = (hx - lx) / (hy - ly)
        lo, hi = np.maximum(ly, y0), np.minimum(hy, y1)
        with np.errstate(divide="ignore", invalid="ignore"):
            at = np.stack([ly + (x - lx) / slope for x in (x0, x1)])
        at = np.sort(np.clip(np.where(np.isfinite(at), at, lo), lo, hi), 0)
        cuts = np.stack([lo, *at, hi])
        parts = []
        for k in range(3):
            low, high = cuts[k], cuts[k + 1]
            i = np.flatnonzero(high > low)
            middle = lx[i] + ((low[i] + high[i]) / 2 - ly[i]) * slope[i]
            left, right = middle < x0[i], middle > x1[i]
            out = left | right
            parts.append((i, low[i], high[i], np.where(left, x0[i], np.where(right, x1[i], lx[i])), np.where(out, 0, ly[i]), np.where(out, 0, slope[i]), np.where(left, x0[i], np.where(right, x1[i], hx[i]))))
        i, *columns = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(group[i], kind="stable")
        i = i[order]
        self.lo, self.hi, self.x, self.y, self.slope, self.top_x = (c[order] for c in columns)
        self.top = hy[i]
        self.delta = np.where(up, -1, 1)[i]
        self.second = side[i].astype(bool)
        self.group = group[i]
        self.tiles = tiles

    def __len__(self) -> int:
        return len(self.lo)

    def at(self, i: np.ndarray, y: np.ndarray) -> np.ndarray:
        x = np.where(y == self.top[i], self.top_x[i], self.x[i] + (y - self.y[i]) * self.slope[i])
        return np.clip(x, self.tiles[self.group[i], 0], self.tiles[self.group[i], 2])

    def crossings(self) -> tuple[np.ndarray, np.ndarray]:
        """Tiles and heights at which two parts cross."""
        i, j = _ranges(np.arange(len(self)) + 1, np.searchsorted(self.group, self.group, "right"))
        low, high = np.maximum(self.lo[i], self.lo[j]), np.minimum(self.hi[i], self.hi[j])
        both = (high > low) & (self.slope[i] != self.slope[j])
        i, j, low, high = i[both], j[both], low[both], high[both]
        first, last = self.at(i, low) - self.at(j, low), self.at(i, high) - self.at(j, high)
        cross = (first * last < 0) & (np.abs(first) > EPS) & (np.abs(last) > EPS)
        first, last, low, high = first[cross], last[cross], low[cross], high[cross]
        return self.group[i[cross]], low + (high - low) * first / (first - last)


def _ranges(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row's number and each number from its ``start`` up to before its ``stop``."""
    n = stop - start
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + start[row]


def _swept(p: _Pieces, op: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Area kept in each tile, and the directed boundaries (rows ``x, y, x, y``, interior on the left) with their tiles, in order."""
    n = len(p.tiles)
    none = np.zeros(n), np.zeros((0, 4)), np.zeros(0, np.int64)
    crossed, heights = p.crossings()
    tile, ys = np.concatenate([p.group, p.group, crossed]), np.concatenate([p.lo, p.hi, heights])
    by = np.lexsort((ys, tile))
    tile, ys = tile[by], ys[by]
    own = np.concatenate([[True], (tile[1:] != tile[:-1]) | (np.diff(ys) > EPS / 100)])[: len(ys)]
    tile, ys = tile[own], ys[own]
    low = np.flatnonzero(tile[1:] == tile[:-1])
    if not len(low):
        return none
    middle = (ys[low + 1] + ys[low]) / 2
    strip, piece = _ranges(np.searchsorted(p.group, tile[low]), np.searchsorted(p.group, tile[low], "right"))
    active = (p.lo[piece] <= middle[strip]) & (p.hi[piece] >= middle[strip])
    strip, piece = strip[active], piece[active]
    x = p.x[piece] + (middle[strip] - p.y[piece]) * p.slope[piece]
    by = np.lexsort((x, strip))
    strip, piece, x = strip[by], piece[by], x[by]
    if not len(x):
        return none
    new = np.concatenate([[True], strip[1:] != strip[:-1]])
    begin = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    delta, second = p.delta[piece], p.second[piece]

    def winding(d: np.ndarray) -> np.ndarray:
        total = np.cumsum(d)
        return total - (total - d)[begin]

    covered = KEPT[op](winding(np.where(second, 0, delta)), winding(np.where(second, delta, 0)))
    last = np.flatnonzero(np.concatenate([new[1:] | (x[1:] - x[:-1] > EPS), [True]]))
    row, state = low[strip[last]], covered[last]
    before = np.concatenate([[False], state[:-1]]) & np.concatenate([[False], row[1:] == row[:-1]])
    turn = np.flatnonzero(state != before)
    row, start, edge, x = row[turn], state[turn], piece[last[turn]], x[last[turn]]
    if not len(row):
        return none
    area = np.bincount(tile[row], np.where(start, -x, x) * (ys[row + 1] - ys[row]), n)
    # Ends at each height, those closer than EPS made one.
    level = np.concatenate([row, row + 1])
    end_x = np.concatenate([p.at(edge, ys[row]), p.at(edge, ys[row + 1])])
    for side in (0, 2):
        border = p.tiles[tile[level], side]
        end_x = np.where(np.abs(end_x - border) < EPS, border, end_x)
    by = np.lexsort((end_x, level))
    sorted_level, sorted_x = level[by], end_x[by]
    new = np.concatenate([[True], (sorted_level[1:] != sorted_level[:-1]) | (np.diff(sorted_x) > EPS)])
    sorted_x = sorted_x[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    end_x[by] = sorted_x
    bottom, top = end_x[: len(row)], end_x[len(row) :]
    lower = np.stack([bottom, ys[row]], 1)
    upper_end = np.stack([top, ys[row + 1]], 1)
    sides = np.where(start[:, None], np.concatenate([upper_end, lower], 1), np.concatenate([lower, upper_end], 1))
    # Level parts: where only the strip above or only the strip below is covered.
    above = np.concatenate([np.ones(len(row), bool), np.zeros(len(row), bool)])[by]
    upper = np.cumsum(above)
    first = np.arange(0, len(by), 2)
    base = np.searchsorted(sorted_level, sorted_level[first])
    inside = (upper[first] - np.where(base > 0, upper[base - 1], 0)) % 2 == 1
    a, b, y = sorted_x[first], sorted_x[first + 1], ys[sorted_level[first]]
    level_parts = np.stack([np.where(inside, a, b), y, np.where(inside, b, a), y], 1)[b > a]
    of = np.concatenate([tile[row], tile[sorted_level[first]][b > a]])
    by = np.argsort(of, kind="stable")
    return area, np.concatenate([sides, level_parts])[by], of[by]


def _near(edges: np.ndarray, side: np.ndarray, group: np.ndarray, tiles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Edges at their tile's heights, and which of them are its own, not beyond its left or right border."""
    x0, y0, x1, y1 = tiles[group].T
    near = (np.minimum(edges[:, 1], edges[:, 3]) < y1) & (np.maximum(edges[:, 1], edges[:, 3]) > y0)
    own = (np.maximum(edges[:, 0], edges[:, 2]) > x0) & (np.minimum(edges[:, 0], edges[:, 2]) < x1)
    return edges[near], side[near], group[near], own[near]


def overlay_tile(edges: np.ndarray, side: np.ndarray, tile: tuple[float, float, float, float], op: str, depth: int = 0) -> tuple[float, np.ndarray]:
    """Area and boundary of ``op`` of two sides' polygons in a tile."""
    tiles = np.array([tile], float)
    edges, side, group, own = _near(edges, side, np.zeros(len(edges), np.int64), tiles)
    if own.sum() > LIMIT and depth < DEEPEST:
        x0, y0, x1, y1 = tile
        mx, my = (x0 + x1) / 2, (y0 + y1) / 2
        parts = [overlay_tile(edges, side, t, op, depth + 1) for t in ((x0, y0, mx, my), (mx, y0, x1, my), (x0, my, mx, y1), (mx, my, x1, y1))]
        return sum(a for a, _ in parts), np.concatenate([b for _, b in parts])
    # Edges beyond the tile only matter by the winding at its borders; those on its right needn't be there.
    area, parts, _ = _swept(_Pieces(*_border_merged(edges, side, group, own, tiles), tiles), op)
    return float(area[0]), parts


def overlay_tiles(edges: np.ndarray, side: np.ndarray, group: np.ndarray, tiles: np.ndarray, op: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """``overlay_tile`` of many tiles at once, the edges in order of ``group``, the tile's number: areas, and a boundary for each tile.

    Most tiles have a few edges, so a sweep of its own for each would be mostly
    calls. Tiles share sweeps of about ``WORK`` pairs of edges; crowded ones go alone.
    """
    n = len(tiles)
    edges, side, group, own = _near(edges, side, group, tiles)
    areas, parts = np.zeros(n), [np.zeros((0, 4))] * n
    if not len(edges):
        return areas, parts
    size = np.bincount(group, minlength=n)
    crowded = np.bincount(group[own], minlength=n) > LIMIT
    stop = np.cumsum(size)
    for g in np.flatnonzero(crowded):
        rows = slice(stop[g] - size[g], stop[g])
        areas[g], parts[g] = overlay_tile(edges[rows], side[rows], tuple(tiles[g]), op)
    share = np.cumsum(np.where(crowded, 0, size * size)) // WORK
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(share)) + 1, [n]])
    for low, high in zip(cuts[:-1], cuts[1:]):
        rows = slice(stop[low] - size[low] if low < n else 0, stop[high - 1])
        few = ~crowded[group[rows]]
        if not few.any():
            continue
        some = tiles[low:high]
        area, lines, of = _swept(_Pieces(*_border_merged(edges[rows][few], side[rows][few], group[rows][few] - low, own[rows][few], some), some), op)
        own_parts = np.split(lines, np.searchsorted(of, np.arange(1, high - low)))
        for g in np.flatnonzero(~crowded[low:high]):
            areas[low + g], parts[low + g] = area[g], own_parts[g]
    return areas, parts


def _border_merged(edges: np.ndarray, side: np.ndarray, group: np.ndarray, own: np.ndarray, tiles: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tiles' own edges; those on their left as net windings along the left border; what is open then is closed along the right one."""
    beyond = ~own & (np.maximum(edges[:, 0], edges[:, 2]) <= tiles[group, 0])
    rows, sides, groups = [edges[own]], [side[own]], [group[own]]
    for column, some, sign in ((0, beyond, 1), (2, own | beyond, -1)):
        e, g, s = edges[some], group[some], side[some]
        y0, y1 = tiles[g, 1], tiles[g, 3]
        y = np.concatenate([np.clip(np.minimum(e[:, 1], e[:, 3]), y0, y1), np.clip(np.maximum(e[:, 1], e[:, 3]), y0, y1)])
        up = np.where(e[:, 3] > e[:, 1], sign, -sign)
        step, g, s = np.concatenate([up, -up]), np.concatenate([g, g]), np.concatenate([s, s])
        order = np.lexsort((y, s, g))
        y, g, s, net = y[order], g[order], s[order], np.cumsum(step[order])
        at = np.flatnonzero((g[1:] == g[:-1]) & (s[1:] == s[:-1]) & (y[1:] > y[:-1]) & (net[:-1] != 0))
        at = np.repeat(at, np.abs(net[at]))
        bottom, top, rise = y[at], y[at + 1], net[at] > 0
        x = tiles[g[at], column]
        rows.append(np.stack([x, np.where(rise, bottom, top), x, np.where(rise, top, bottom)], 1))
        sides.append(s[at])
        groups.append(g[at])
    return np.concatenate(rows), np.concatenate(sides), np.concatenate(groups)


def _net(lines: np.ndarray) -> np.ndarray:
    """Directed parts of parallel lines (rows ``line, from, to``) with what runs both ways taken out."""
    if not len(lines):
        return lines
    low, high = np.minimum(lines[:, 1], lines[:, 2]), np.maximum(lines[:, 1], lines[:, 2])
    way = np.where(lines[:, 2] > lines[:, 1], 1, -1)
    line, at, step = np.concatenate([lines[:, 0]] * 2), np.concatenate([low, high]), np.concatenate([way, -way])
    order = np.lexsort((at, line))
    line, at, total = line[order], at[order], np.cumsum(step[order])
    kept = np.flatnonzero((line[1:] == line[:-1]) & (at[1:] - at[:-1] > EPS) & (total[:-1] != 0))
    ahead = total[kept] > 0
    return np.stack([line[kept], np.where(ahead, at[kept], at[kept + 1]), np.where(ahead, at[kept + 1], at[kept])], 1)


def stitched(parts: np.ndarray) -> list[list[tuple[float, float]]]:
    """Rings of directed boundary parts: shells run counter-clockwise, holes clockwise."""
    upright, level = parts[:, 0] == parts[:, 2], parts[:, 1] == parts[:, 3]
    v, h = _net(parts[upright][:, [0, 1, 3]]), _net(parts[level & ~upright][:, [1, 0, 2]])
    parts = np.concatenate([parts[~upright & ~level], np.stack([v[:, 0], v[:, 1], v[:, 0], v[:, 2]], 1), np.stack([h[:, 1], h[:, 0], h[:, 2], h[:, 0]], 1)])
    # Rounded places name the ends; they are made for all at once.
    named = np.rint(parts * 1e5).astype(np.int64).tolist()
    starts, stops = [(n[0], n[1]) for n in named], [(n[2], n[3]) for n in named]
    leaving: dict[tuple[int, int], list[int]] = defaultdict(list)
    rows = parts.tolist()
    for i, (start, stop) in enumerate(zip(starts, stops)):
        if start != stop:
            leaving[start].append(i)
    rings = []
    for first, begin in enumerate(starts):
        if first not in leaving.get(begin, ()):
            continue
        ring, at = [], first
        while True:
            ax, ay, bx, by = rows[at]
            leaving[starts[at]].remove(at)
            ring.append((ax, ay))
            here = stops[at]
            if here == begin:
                break
            ways = leaving.get(here) or _beside(leaving, here)
            if not ways:
                break
            at = ways[0] if len(ways) == 1 else max(ways, key=lambda k: _left_turn((bx - ax, by - ay), (rows[k][2] - rows[k][0], rows[k][3] - rows[k][1])))
        ring = _corners(ring)
        if len(ring) > 2:
            rings.append(ring)
    return rings


def _beside(leaving: dict, at: tuple[int, int]) -> list[int]:
    """Parts that leave from a neighbouring rounded place."""
    for dx in (-1, 0, 1):
        for dy in (-1, 0, 1):
            if found := leaving.get((at[0] + dx, at[1] + dy)):
                return found
    return []


def _left_turn(a: tuple[float, float], b: tuple[float, float]) -> float:
    return float(np.arctan2(a[0] * b[1] - a[1] * b[0], a[0] * b[0] + a[1] * b[1]))


def _corners(ring: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """The ring without points on straight lines."""
    if len(ring) < 3:
        return []
    p = np.array(ring)
    before = p - np.concatenate([p[-1:], p[:-1]])
    after = np.concatenate([before[1:], before[:1]])
    cross = before[:, 0] * after[:, 1] - before[:, 1] * after[:, 0]
    scale = np.hypot(*before.T) * np.hypot(*after.T)
    return [tuple(q) for q in p[np.abs(cross) > 1e-9 * np.maximum(scale, 1e-9)].tolist()]


def ring_area(ring: list[tuple[float, float]]) -> float:
    x, y = np.array([*ring, ring[0]]).T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def as_polygons(rings: list[list[tuple[float, float]]]) -> list[list[list[tuple[float, float]]]]:
    """Shells with their holes, in order of their lowest left corner."""
    areas = [ring_area(r) for r in rings]
    found = sorted(((r, a) for r, a in zip(rings, areas) if a > 0), key=lambda s: min(s[0]))
    out = [[r] for r, _ in found]
    size = np.array([a for _, a in found])
    # Arrays of the shells are made once: a large union has thousands of holes in one of as many corners.
    closed = [np.array([*r, r[0]]).T for r, _ in found]
    x0, y0, x1, y1 = np.array([[*c.min(1), *c.max(1)] for c in closed]).reshape(-1, 4).T
    for hole in (r for r, a in zip(rings, areas) if a < 0):
        (ax, ay), (bx, by) = hole[0], hole[1]
        span = max(np.hypot(bx - ax, by - ay), 1e-12)
        # A place just outside the hole, so on the shell's side.
        px, py = (ax + bx) / 2 - (by - ay) / span * 1e-6, (ay + by) / 2 + (bx - ax) / span * 1e-6
        near = np.flatnonzero((x0 <= px) & (px <= x1) & (y0 <= py) & (py <= y1))
        for k in near[np.argsort(size[near], kind="stable")]:
            if _encloses(closed[k], px, py):
                out[k].append(hole)
                break
    return out


def _encloses(closed: np.ndarray, px: float, py: float) -> bool:
    """Whether a closed ring (rows ``x`` and ``y``) holds a place."""
    y = closed[1] > py
    i = np.flatnonzero(y[1:] != y[:-1])
    (x, y), (u, v) = closed[:, i], closed[:, i + 1]
    return int((x + (py - y) * (u - x) / (v - y) > px).sum()) % 2 == 1


def _holds(ring: list[tuple[float, float]], point: tuple[float, float]) -> bool:
    return _encloses(np.array([*ring, ring[0]]).T, *point)


def by_group(df: DataFrame, keys: list[str], of: Callable[[pd.DataFrame, np.ndarray], list[tuple]], schema: str, columns: list[str]) -> DataFrame:
    """Rows that ``of`` makes of groups of ``keys``: it gets whole groups, one after the other, and the rows at which they begin.

    Many small groups share a batch, where ``groupBy.applyInPandas`` would send
    each on its own; a group that ends in another batch is carried over.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            change = np.zeros(len(frame), bool)
            for key in keys:
                change[1:] |= frame[key].to_numpy()[1:] != frame[key].to_numpy()[:-1]
            begin = np.concatenate([[0], np.flatnonzero(change)])
            rows = of(frame.iloc[: begin[-1]], begin[:-1]) if len(begin) > 1 else None
            rest = frame.iloc[begin[-1] :]
            if rows:
                yield pd.DataFrame(rows, columns=columns)
        if rest is not None and len(rest):
            yield pd.DataFrame(of(rest, np.zeros(1, np.int64)), columns=columns)

    # A number of parts is given, as few bytes may be much work: they shall not be merged by their size.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


class Overlay:
    """``op`` of the polygons of each key: of all on side 0, or of side 0 against side 1.

    ``shapes()`` reads the tiles' boundaries, which are written once; ``areas()``
    reads them only where they are there already, else it makes areas alone.
    """

    def __init__(self, edges: DataFrame, key: str, cell: float, op: str):
        self.edges, self.key, self.size, self.op = edges, key, float(cell), op

    def _over_tiles(self, bounds: bool) -> DataFrame:
        """``key, area`` of each tile with any, and its ``parts`` of the boundary where ``bounds``."""
        key, size, op = self.key, self.size, self.op
        kind = dict(self.edges.dtypes)[key]
        low, high = F.least("ay", "by"), F.greatest("ay", "by")
        tile = lambda c: F.floor(c / F.lit(size)).cast("bigint")
        dealt = self.edges.withColumn("_tx", F.explode(F.sequence(tile(F.least("ax", "bx")), tile(F.greatest(F.col("right"), F.least("ax", "bx"))))))
        dealt = dealt.withColumn("_ty", F.explode(F.sequence(tile(low), tile(high))))

        def sweep(frame: pd.DataFrame, begin: np.ndarray) -> list[tuple]:
            corner = frame[["_tx", "_ty"]].to_numpy()[begin] * size
            group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(frame))))
            areas, parts = overlay_tiles(frame[["ax", "ay", "bx", "by"]].to_numpy(), frame["_side"].to_numpy(), group, np.concatenate([corner, corner + size], 1), op)
            found = zip(frame[key].to_numpy()[begin].tolist(), areas.tolist(), parts)
            return [(name, area, p.reshape(-1)) if bounds else (name, area) for name, area, p in found if len(p)]

        schema = f"`{key}` {kind}, area double" + ", parts array<double>" * bounds
        return written(by_group(dealt.drop("right"), [key, "_tx", "_ty"], sweep, schema, [key, "area", "parts"][: 2 + bounds]))

    @cached_property
    def tiles(self) -> DataFrame:
        return self._over_tiles(True)

    def areas(self) -> DataFrame:
        """``key, area`` where any is left."""
        tiles = self.tiles if "tiles" in self.__dict__ else self._over_tiles(False)
        return tiles.groupBy(self.key).agg(F.sum("area").alias("area")).where(F.col("area") > EPS)

    def shapes(self) -> DataFrame:
        """``key, part, polygon``: the disjoint polygons of each key, holes included, numbered from 1."""
        key, kind = self.key, dict(self.tiles.dtypes)[self.key]

        def stitch(frame: pd.DataFrame, begin: np.ndarray) -> list[tuple]:
            names, parts, out = frame[key].to_numpy().tolist(), frame["parts"].tolist(), []
            for low, high in zip(begin, [*begin[1:], len(parts)]):
                rings = stitched(np.concatenate(parts[low:high]).reshape(-1, 4))
                out += [(names[low], i, [[{"x": x, "y": y} for x, y in ring] for ring in polygon]) for i, polygon in enumerate(as_polygons(rings), 1)]
            return out

        schema = f"`{key}` {kind}, part int, polygon array<array<struct<x: double, y: double>>>"
        return by_group(self.tiles.select(key, "parts"), [key], stitch, schema, [key, "part", "polygon"])


def dissolve(df: DataFrame, key: str, cell: float, polygon: str = "polygon") -> Overlay:
    """The union of each key's polygons."""
    return Overlay(directed_edges(df, [key], polygon).withColumn("_side", F.lit(0).cast("byte")), key, cell, "union")


def dissolve_clusters(df: DataFrame, key: str, cell: float, polygon: str = "polygon") -> tuple[Overlay, DataFrame]:
    """The union of each key's polygons by ``cluster``, those whose boxes meet one another, and each cluster's ``key``.

    No ring of a union and none of its holes reaches beyond a cluster, so they are
    stitched by cluster, and a key of any number of polygons is spread over many tasks.
    """
    rows = written(df.where(F.col(polygon).isNotNull()).select(key, polygon).withColumn("_id", F.monotonically_increasing_id()))
    slim = with_box(rows, polygon).select("_id", key, *BOX)
    links = box_join(slim, slim, cell).where(F.col("a__id") < F.col("b__id")).where(F.col(f"a_{key}").eqNullSafe(F.col(f"b_{key}")))
    label = components_by_place(links.select(F.col("a__id").alias("a"), F.col("b__id").alias("b"), *block_of(cell)), ["_bx", "_by"]).select(F.col("node").alias("_id"), "component")
    named = written(rows.join(shuffled(label), "_id", "left").select(F.coalesce("component", "_id").alias("cluster"), "_id", key, polygon))
    return dissolve(named, "cluster", cell, polygon), named.where("cluster = _id").select("cluster", key)


def against(a: DataFrame, b: DataFrame, key: str, cell: float, op: str, polygon: str = "polygon") -> Overlay:
    """Each polygon of ``a`` (one per ``key``) less, or within, the union of ``b``'s polygons that meet its box."""
    # Written, as the nested expressions of boxes cost the planner minutes where steps repeat them.
    own, other = written(with_box(a.select(key, polygon), polygon)), written(with_box(b.select(polygon), polygon))
    met = box_join(own.select(key, *BOX), other, cell).select(F.col(f"a_{key}").alias(key), F.col(f"b_{polygon}").alias(polygon))
    first = directed_edges(own, [key], polygon).withColumn("_side", F.lit(0).cast("byte"))
    second = directed_edges(met, [key], polygon).withColumn("_side", F.lit(1).cast("byte"))
    return Overlay(first.unionByName(second), key, cell, op)


def difference(a: DataFrame, b: DataFrame, key: str, cell: float, polygon: str = "polygon") -> Overlay:
    return against(a, b, key, cell, "difference", polygon)


def clip(a: DataFrame, b: DataFrame, key: str, cell: float, polygon: str = "polygon") -> Overlay:
    return against(a, b, key, cell, "intersection", polygon)


def turned_edges(polygon: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Edges of all rings of more than two points, the interior on their left, and their polygons' numbers."""
    count = _sizes(polygon)
    edges, ring, size = closed_edges(polygon.flatten())
    x, y, u, v = edges.T
    shell = np.zeros(len(size), bool)
    shell[(np.cumsum(count) - count)[count > 0]] = True
    ahead = (np.bincount(ring, x * v - u * y, len(size)) >= 0) == shell
    edges = np.where(ahead[ring, None], edges, edges[:, [2, 3, 0, 1]])
    kept = size[ring] > 2
    return edges[kept], np.repeat(np.arange(len(polygon)), count)[ring[kept]]


def _shared(p: pa.Array, q: pa.Array) -> pa.Array:
    n = len(p)
    sides = [turned_edges(polygon) for polygon in (p, q)]
    box = np.full((2, 4, n), np.inf)
    for (e, g), (x0, y0, x1, y1) in zip(sides, box):
        for low, high, c in ((x0, x1, 0), (y0, y1, 1)):
            np.minimum.at(low, np.tile(g, 2), np.concatenate([e[:, c], e[:, c + 2]]))
            np.minimum.at(high, np.tile(g, 2), -np.concatenate([e[:, c], e[:, c + 2]]))
    # A side without edges has a box that begins at infinity, so none is shared.
    tiles = np.concatenate([box[:, :2].max(0), -box[:, 2:].max(0)]).T
    both = (tiles[:, 0] < tiles[:, 2]) & (tiles[:, 1] < tiles[:, 3])
    number = np.cumsum(both) - 1
    edges, group = (np.concatenate([s[i] for s in sides]) for i in (0, 1))
    side = np.repeat(np.array([0, 1], np.int8), [len(e) for e, _ in sides])
    kept = both[group] & (edges[:, 1] != edges[:, 3])
    edges, side, group = edges[kept], side[kept], number[group[kept]]
    order = np.argsort(group, kind="stable")
    area = np.zeros(n)
    area[both] = overlay_tiles(edges[order], side[order], group[order], tiles[both], "intersection")[0]
    return pa.array(area, mask=pc.or_(p.is_null(), q.is_null()).to_numpy(zero_copy_only=False))


def shared_area(a: Column, b: Column) -> Column:
    """Area that two polygons share, holes included: pairs share sweeps, and no polygon becomes a Python object."""
    return F.arrow_udf(_shared, "double").asNondeterministic()(a, b)
