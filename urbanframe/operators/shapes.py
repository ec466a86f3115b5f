"""Predicates and distances of lines and polygons, by their segments.

A shape is a point, a line or a polygon (see ``functions.geometry``). Shapes are
cut into segments, segments into parts of at most a tile's length, and parts
are joined by tile, so the work grows with what lies close together and a long
shape is spread over many tasks; no shape meets another one's box as a whole.
Results of a pair's segments are combined before they are shuffled. Shapes
that hold others without crossing them are found by one point of each.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanframe.functions.geometry import _held, _numbers, _segments, holds
from urbanframe.operators.overlay import with_box
from urbanframe.operators.spatial import _tiled, box_join
from urbanframe.session import shuffled, tasks_for

ENDS = ("ax", "ay", "bx", "by")
PAIR = [f"{side}_{c}" for side in "ab" for c in ENDS]


def kind_of(df: DataFrame, shape: str) -> str:
    """``point``, ``line`` or ``polygon``, by the column's type."""
    kind = dict(df.dtypes)[shape]
    return "polygon" if kind.startswith("array<array<") else "line" if kind.startswith("array<") else "point"


def segments(df: DataFrame, key: str, shape: str) -> DataFrame:
    """``key, ax, ay, bx, by``: the segments of every shape; a point, or a line of one point, is one without length."""
    kind = kind_of(df, shape)
    if kind == "point":
        parts = F.array(F.struct(F.col(shape).alias("a"), F.col(shape).alias("b")))
    elif kind == "line":
        only = F.element_at(shape, 1)
        parts = F.when(F.size(shape) > 1, _segments(F.col(shape))).otherwise(F.array(F.struct(only.alias("a"), only.alias("b"))))
    else:
        parts = F.flatten(F.transform(shape, lambda ring: _segments(ring, True)))
    rows = df.where(F.col(shape).isNotNull()).select(key, F.explode(parts).alias("_s"))
    return rows.select(key, *[F.col(f"_s.{p}.{c}").cast("double").alias(f"{p}{c}") for p in "ab" for c in "xy"])


def _short_boxes(df: DataFrame, cell: float) -> DataFrame:
    """A row with a box for each part of a segment that is at most ``cell`` long."""
    longest = F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay")))
    n = F.greatest(F.lit(1), F.ceil(longest / F.lit(float(cell))).cast("int"))
    rows = df.withColumn("_n", n).withColumn("_i", F.explode(F.sequence(F.lit(0), n - 1)))
    at = lambda c, i: F.col(f"a{c}") + (F.col(f"b{c}") - F.col(f"a{c}")) * (i / F.col("_n"))
    here, there = {c: at(c, F.col("_i")) for c in "xy"}, {c: at(c, F.col("_i") + 1) for c in "xy"}
    return rows.withColumns({f"{c}min": F.least(here[c], there[c]) for c in "xy"} | {f"{c}max": F.greatest(here[c], there[c]) for c in "xy"}).drop("_n", "_i")


def _turn(ax, ay, bx, by, cx, cy) -> Column:
    """Sign of the turn from a over b to c."""
    return F.signum((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))


def _met(ax, ay, bx, by, cx, cy, dx, dy):
    """Whether segments share a point, as numpy arrays."""

    def turn(ax, ay, bx, by, cx, cy):
        return np.sign((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))

    boxes = (np.maximum(ax, bx) >= np.minimum(cx, dx)) & (np.maximum(cx, dx) >= np.minimum(ax, bx)) & (np.maximum(ay, by) >= np.minimum(cy, dy)) & (np.maximum(cy, dy) >= np.minimum(ay, by))
    apart_q = turn(ax, ay, bx, by, cx, cy) * turn(ax, ay, bx, by, dx, dy)
    apart_p = turn(cx, cy, dx, dy, ax, ay) * turn(cx, cy, dx, dy, bx, by)
    return boxes & (apart_q <= 0) & (apart_p <= 0)


def _squared(px, py, ax, ay, bx, by):
    """Squared distance of points and segments."""
    dx, dy = bx - ax, by - ay
    square = dx * dx + dy * dy
    with np.errstate(divide="ignore", invalid="ignore"):
        t = np.where(square == 0, 0.0, ((px - ax) * dx + (py - ay) * dy) / square)
    t = np.maximum(0.0, np.minimum(1.0, t))
    ox, oy = px - (ax + t * dx), py - (ay + t * dy)
    return ox * ox + oy * oy


def _gaps(*e: np.ndarray) -> np.ndarray:
    """Distances of segments, as numpy arrays."""
    p, q = e[:4], e[4:]
    least = np.minimum(np.minimum(_squared(*p[:2], *q), _squared(*p[2:], *q)), np.minimum(_squared(*q[:2], *p), _squared(*q[2:], *p)))
    return np.where(_met(*e), 0.0, np.sqrt(least))


def _all_met(*ends: pd.Series) -> pd.Series:
    return pd.Series(_met(*[e.to_numpy(float) for e in ends]))


def _apart(*ends: pd.Series) -> pd.Series:
    return pd.Series(_gaps(*[e.to_numpy(float) for e in ends]))


def segments_meet(p: tuple[Column, ...], q: tuple[Column, ...]) -> Column:
    """Whether two closed segments (``ax, ay, bx, by``) share a point; either may be a point.

    By batches: as nested columns the test would stand in the join's condition and
    make its code too large to be compiled. So do the others here.
    """
    return F.pandas_udf(_all_met, "boolean").asNondeterministic()(*p, *q)


def segment_distance(p: tuple[Column, ...], q: tuple[Column, ...]) -> Column:
    """Distance of two segments; 0 where they meet."""
    return F.pandas_udf(_apart, "double").asNondeterministic()(*p, *q)


def _pair_columns() -> tuple[tuple[Column, ...], tuple[Column, ...]]:
    return tuple(F.col(f"a_{c}") for c in ENDS), tuple(F.col(f"b_{c}") for c in ENDS)


def _tested(pairs: DataFrame, a_key: str, b_key: str, columns: list[str], of: Callable[..., tuple], more: str = "") -> DataFrame:
    """``a_key, b_key`` of the pairs that ``of`` keeps by their ``columns``, as Arrow arrays, and what ``more`` it tells of them.

    A Python column would have the rows of all pairs wait for its results, on the
    executors' disks where memory is short; here only the results come back.
    """
    kinds = dict(pairs.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, *told = of(*batch.columns[2:])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *map(pa.array, told)], names).filter(pa.array(kept))

    schema = f"a_key {kinds[f'a_{a_key}']}, b_key {kinds[f'b_{b_key}']}{more}"
    names = ["a_key", "b_key"] + more.split()[1::2]
    return pairs.select(F.col(f"a_{a_key}").alias("a_key"), F.col(f"b_{b_key}").alias("b_key"), *columns).mapInArrow(run, schema)


def _one_point(df: DataFrame, key: str, shape: str) -> DataFrame:
    """``key, x, y``: a point of every shape."""
    kind = kind_of(df, shape)
    point = F.col(shape) if kind == "point" else F.element_at(F.flatten(shape) if kind == "polygon" else F.col(shape), 1)
    return df.select(key, point["x"].cast("double").alias("x"), point["y"].cast("double").alias("y")).where("x IS NOT NULL")


def _holding(points: DataFrame, polygons: DataFrame, a_key: str, b_key: str, shape: str, cell: float) -> DataFrame:
    """``a_key, b_key`` of points and the polygons that hold them."""
    boxed = points.withColumns({"xmin": F.col("x"), "ymin": F.col("y"), "xmax": F.col("x"), "ymax": F.col("y")})
    pairs = box_join(boxed, with_box(polygons.select(b_key, shape), shape), cell)
    return _tested(pairs, a_key, b_key, [f"b_{shape}", "a_x", "a_y"], lambda polygon, x, y: (_held(polygon, x, y),))


def _inside(a: DataFrame, b: DataFrame, a_key: str, b_key: str, a_shape: str, b_shape: str, cell: float) -> DataFrame | None:
    """Pairs of which one holds a point of the other; None where neither side has an inside."""
    found = None
    if kind_of(b, b_shape) == "polygon":
        found = _holding(_one_point(a, a_key, a_shape), b, a_key, b_key, b_shape, cell)
    if kind_of(a, a_shape) == "polygon":
        other = _holding(_one_point(b, b_key, b_shape), a, b_key, a_key, a_shape, cell).select(F.col("b_key").alias("a_key"), F.col("a_key").alias("b_key"))
        found = other if found is None else found.unionByName(other)
    return found


def meeting(a: DataFrame, b: DataFrame, a_key: str, b_key: str, cell: float, a_shape: str = "shape", b_shape: str = "shape", crowded: int | None = None) -> DataFrame:
    """``a_key, b_key``, once each, of the shapes that share at least one point (borders belong to shapes).

    ``crowded`` splits tiles of more segments, as in ``box_join``.
    """
    pairs = box_join(_short_boxes(segments(a, a_key, a_shape), cell), _short_boxes(segments(b, b_key, b_shape), cell), cell, crowded=crowded)
    found = _tested(pairs, a_key, b_key, PAIR, lambda *ends: (_met(*map(_numbers, ends)),))
    if (held := _inside(a, b, a_key, b_key, a_shape, b_shape, cell)) is not None:
        found = found.unionByName(held)
    return found.distinct()


def near(a: DataFrame, b: DataFrame, a_key: str, b_key: str, d: float, cell: float | None = None, a_shape: str = "shape", b_shape: str = "shape", crowded: int | None = None) -> DataFrame:
    """``a_key, b_key, distance`` of the shapes at most ``d`` apart; 0 where they meet or one holds the other."""
    cell = cell or max(float(d), 1.0)
    pairs = box_join(_short_boxes(segments(a, a_key, a_shape), cell), _short_boxes(segments(b, b_key, b_shape), cell), cell, margin=d, crowded=crowded)

    def close(*ends: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        gap = _gaps(*map(_numbers, ends))
        return gap <= d, gap

    found = _tested(pairs, a_key, b_key, PAIR, close, ", distance double")
    if (held := _inside(a, b, a_key, b_key, a_shape, b_shape, cell)) is not None:
        found = found.unionByName(held.withColumn("distance", F.lit(0.0)))
    return found.groupBy("a_key", "b_key").agg(F.min("distance").alias("distance"))


def points_near(points: DataFrame, lines: DataFrame, d: float, cell: float, shape: str = "shape") -> DataFrame:
    """Rows of ``points`` (``x, y``) at most ``d`` from a line.

    Segments are dealt to all tiles that they may serve, a point to its own one
    alone, so that one semi join by tile tells each point once, without pairs.
    """
    # Slack against rounding: the distance decides.
    dealt = _tiled(_short_boxes(segments(lines.withColumn("_k", F.lit(1)), "_k", shape), cell), "", cell, d * (1 + 1e-9))
    dealt = dealt.select(F.col("_tx").alias("_sx"), F.col("_ty").alias("_sy"), *[F.col(c).alias(f"_{c}") for c in ENDS])
    tile = {f"_t{c}": F.floor(F.col(c) / F.lit(float(cell))).cast("bigint") for c in "xy"}
    near_by = (F.col("_tx") == F.col("_sx")) & (F.col("_ty") == F.col("_sy")) & (_point_squared() <= _square_up_to(d))
    return points.withColumns(tile).join(shuffled(dealt), near_by, "left_semi").drop("_tx", "_ty")


def _point_squared() -> Column:
    """As ``_squared`` of ``x, y`` and a segment, a short enough column to be compiled."""
    x, y, ax, ay, bx, by = (F.col(c) for c in ("x", "y", "_ax", "_ay", "_bx", "_by"))
    dx, dy = bx - ax, by - ay
    t = F.coalesce(F.try_divide((x - ax) * dx + (y - ay) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    square = lambda ox, oy: ox * ox + oy * oy
    return F.least(square(x - (ax + t * dx), y - (ay + t * dy)), square(x - ax, y - ay), square(x - bx, y - by))


def _square_up_to(d: float) -> float:
    """The largest number whose root is at most ``d``."""
    square = float(d) * float(d)
    while math.sqrt(after := math.nextafter(square, math.inf)) <= d:
        square = after
    while math.sqrt(square) > d:
        square = math.nextafter(square, 0.0)
    return square


def shared_border(a: DataFrame, b: DataFrame, a_key: str, b_key: str, cell: float, a_shape: str = "shape", b_shape: str = "shape") -> DataFrame:
    """``a_key, b_key, length``: how much of their borders two shapes have in common (collinear overlap of segments)."""
    pairs = box_join(_whole_boxes(segments(a, a_key, a_shape)), _whole_boxes(segments(b, b_key, b_shape)), cell)
    (ax, ay, bx, by), (cx, cy, dx, dy) = _pair_columns()
    one_line = (_turn(ax, ay, bx, by, cx, cy) == 0) & (_turn(ax, ay, bx, by, dx, dy) == 0)
    long = F.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))
    along = lambda x, y: F.try_divide((x - ax) * (bx - ax) + (y - ay) * (by - ay), long)
    low, high = F.least(along(cx, cy), along(dx, dy)), F.greatest(along(cx, cy), along(dx, dy))
    common = F.least(long, high) - F.greatest(F.lit(0.0), low)
    found = pairs.where(one_line & (long > 0)).select(F.col(f"a_{a_key}").alias("a_key"), F.col(f"b_{b_key}").alias("b_key"), common.alias("length")).where("length > 0")
    return found.groupBy("a_key", "b_key").agg(F.sum("length").alias("length"))


def _whole_boxes(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{c}min": F.least(f"a{c}", f"b{c}") for c in "xy"} | {f"{c}max": F.greatest(f"a{c}", f"b{c}") for c in "xy"})


def associate_tags(areas: DataFrame, features: DataFrame, key: str, feature_key: str, tags: list[str], cell: float, name: str, area_shape: str = "polygon", feature_shape: str = "shape") -> DataFrame:
    """``areas`` with ``name``: the distinct tag sets, as sorted JSON objects, of the features that meet each area.

    Null tags are left out of an object, features without any tag out of the
    list; an area without tagged features has null. Equal tag sets of an area
    are made one before they are shuffled.
    """
    tagged = features.where(F.coalesce(*[F.col(f"`{t}`").cast("string") for t in tags]).isNotNull())
    found = meeting(areas, tagged, key, feature_key, cell, area_shape, feature_shape)
    object_ = F.to_json(F.struct(*[F.col(f"`{t}`") for t in tags]))
    named = found.join(shuffled(tagged.select(F.col(feature_key).alias("b_key"), object_.alias("_tags"))), "b_key")
    lists = named.groupBy(F.col("a_key").alias(key)).agg(F.array_sort(F.collect_set("_tags")).alias(name))
    return areas.join(shuffled(lists), key, "left")


def memberships(points: DataFrame, layers: list[DataFrame], point_id: str, cell: float, polygon: str = "polygon") -> DataFrame:
    """``points`` with ``layers``: a bit for each layer (the first is 1) that holds the point, all found in one tiled pass."""
    each = [with_box(df.select(polygon), polygon).withColumn("_bit", F.lit(1 << i)) for i, df in enumerate(layers)]
    rows = each[0]
    for df in each[1:]:
        rows = rows.unionByName(df)
    boxed = points.select(point_id, "x", "y").withColumns({"xmin": F.col("x"), "ymin": F.col("y"), "xmax": F.col("x"), "ymax": F.col("y")})
    inside = holds(F.col(f"b_{polygon}"), F.col("a_x"), F.col("a_y"))
    bits = box_join(boxed, rows, cell, parts=tasks_for(points, *layers)).where(inside).groupBy(F.col(f"a_{point_id}").alias(point_id)).agg(F.bit_or("b__bit").alias("layers"))
    return points.join(shuffled(bits), point_id, "left").withColumn("layers", F.coalesce("layers", F.lit(0)))


def in_all(points: DataFrame, layers: list[DataFrame], point_id: str, cell: float, polygon: str = "polygon") -> DataFrame:
    """Points inside every layer at once."""
    return memberships(points, layers, point_id, cell, polygon).where(F.col("layers") == (1 << len(layers)) - 1).drop("layers")
