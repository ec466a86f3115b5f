"""Spatial joins by tiles.

Features carry a bounding box in four columns. Both sides are dealt to square
tiles, joined on the tile, and a pair is kept only in the tile of the lower
left corner of their shared box, so each pair of boxes that meet comes once and
no distinct is needed. Exact predicates follow. The tile size is the caller's:
about the size of the larger side's boxes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanframe.functions.geometry import holds, nearest_place
from urbanframe.session import broadcast_if_small, checkpointed, shuffled

BOX = ("xmin", "ymin", "xmax", "ymax")
#: Levels that a crowded tile is split at most.
DEEPEST = 10
#: Tiles along a side of the blocks whose links one task joins.
BLOCK = 20


def box_of(df: DataFrame, prefix: str = "") -> dict[str, Column]:
    return {c: F.col(prefix + c) for c in BOX}


def with_point_box(df: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """Boxes of points."""
    return df.withColumns({"xmin": F.col(x), "ymin": F.col(y), "xmax": F.col(x), "ymax": F.col(y)})


def with_line_box(df: DataFrame, line: str = "line") -> DataFrame:
    xs, ys = F.transform(F.col(line), lambda p: p["x"]), F.transform(F.col(line), lambda p: p["y"])
    return df.withColumns({"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)})


def prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def _tiled(df: DataFrame, side: str, cell: float, margin: float) -> DataFrame:
    tile = lambda c, m: F.floor((F.col(side + c) + m) / F.lit(float(cell))).cast("bigint")
    return df.withColumn("_tx", F.explode(F.sequence(tile("xmin", -margin), tile("xmax", margin)))).withColumn("_ty", F.explode(F.sequence(tile("ymin", -margin), tile("ymax", margin))))


def box_join(a: DataFrame, b: DataFrame, cell: float, margin: float = 0.0, crowded: int | None = None, parts: int | None = None) -> DataFrame:
    """Pairs whose boxes meet, ``a``'s widened by ``margin``. Columns get the prefixes ``a_`` and ``b_``.

    With ``crowded``, tiles that more features of a side fall into are counted
    first and quartered as often as it takes to get about below that number (a
    quadtree of at most ``DEEPEST`` levels): only features on a quarter's border
    are dealt to several, and a city centre spreads over many tasks. ``parts``
    is the number of tasks, where that of the session is not to be taken.
    """
    left, right = _tiled(prefixed(a, "a_"), "a_", cell, margin), _tiled(prefixed(b, "b_"), "b_", cell, 0.0)
    by, side = ["_tx", "_ty"], F.lit(float(cell))
    if crowded is not None:
        depth = _depths(left, right, crowded)
        left, right = (_quartered(df, name, side, m, depth) for df, name, m in ((left, "a_", margin), (right, "b_", 0.0)))
        by, side = ["_tx", "_ty", "_sx", "_sy"], F.lit(float(cell)) / F.pow(F.lit(2.0), F.col("_depth"))
        right = right.drop("_depth")
    low_x, low_y = F.greatest(F.col("a_xmin") - margin, F.col("b_xmin")), F.greatest(F.col("a_ymin") - margin, F.col("b_ymin"))
    meets = (F.col("a_xmin") - margin <= F.col("b_xmax")) & (F.col("b_xmin") <= F.col("a_xmax") + margin) & (F.col("a_ymin") - margin <= F.col("b_ymax")) & (F.col("b_ymin") <= F.col("a_ymax") + margin)
    home = (F.floor(low_x / side) == F.col(by[-2])) & (F.floor(low_y / side) == F.col(by[-1]))
    if parts is not None:
        left, right = left.repartition(parts, *by), right.repartition(parts, *by)
    return left.join(shuffled(right), by).where(meets & home).drop(*by, "_depth")


def block_of(cell: float, side: str = "a_") -> list[Column]:
    """``_bx, _by``: the block of ``BLOCK`` by ``BLOCK`` tiles that a box's corner lies in."""
    return [F.floor(F.col(f"{side}{c}min") / F.lit(float(cell * BLOCK))).alias(f"_b{c}") for c in "xy"]


def _depths(left: DataFrame, right: DataFrame, crowded: int) -> DataFrame:
    """``_tx, _ty, _depth`` of the tiles to be split; a row a crowded tile."""
    both = left.select("_tx", "_ty", F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(right.select("_tx", "_ty", F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    counts = both.groupBy("_tx", "_ty").agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b")).where("_a > 0 AND _b > 0")
    over = F.greatest("_a", "_b") / F.lit(float(crowded))
    return checkpointed(counts.where(over > 1).select("_tx", "_ty", F.least(F.ceil(F.log(over) / F.log(F.lit(4.0))), F.lit(DEEPEST)).cast("int").alias("_depth")))


def _quartered(df: DataFrame, name: str, side: Column, margin: float, depth: DataFrame) -> DataFrame:
    """Rows dealt on to the parts of split tiles that they meet: ``_sx, _sy, _depth``."""
    out = df.join(broadcast_if_small(depth), ["_tx", "_ty"], "left").withColumn("_depth", F.coalesce("_depth", F.lit(0)))
    parts = F.pow(F.lit(2.0), F.col("_depth"))
    for c in "xy":
        at = lambda edge, m: F.floor((F.col(f"{name}{c}{edge}") + m) / (side / parts)).cast("bigint")  # noqa: B023, E731
        first = (F.col(f"_t{c}") * parts).cast("bigint")
        low, high = F.greatest(at("min", -margin), first), F.least(at("max", margin), first + parts.cast("bigint") - 1)
        out = out.withColumn(f"_s{c}", F.explode(F.sequence(low, high)))
    return out


def scan_box(df: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Features whose box meets a query box; plain comparisons, so Parquet can prune."""
    return df.where((F.col("xmin") <= xmax) & (F.col("xmax") >= xmin) & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))


def in_box(x: Column, y: Column, box: dict[str, Column]) -> Column:
    """Point in a half-open rectangle: a shared border belongs to one side."""
    return (x >= box["xmin"]) & (x < box["xmax"]) & (y >= box["ymin"]) & (y < box["ymax"])


def points_in_areas(points: DataFrame, areas: DataFrame, cell: float, crowded: int | None = None) -> DataFrame:
    """Pairs of points (``x, y``) and the areas that hold them (half-open). Areas with
    a ``polygon`` column are tested exactly, others as rectangles; ``crowded`` as in ``box_join``."""
    pairs = box_join(with_point_box(points), areas, cell, crowded=crowded)
    inside = in_box(F.col("a_x"), F.col("a_y"), {c: F.col(f"b_{c}") for c in BOX})
    if "polygon" in areas.columns:
        inside = holds(F.col("b_polygon"), F.col("a_x"), F.col("a_y"))
    return pairs.where(inside)


def attach_area(points: DataFrame, areas: DataFrame, point_id: str, area_id: str, cell: float, keep_unmatched: bool = True, field: str | None = None) -> DataFrame:
    """Points with the id (or ``field``) of their area; of several the lowest id."""
    value = field or area_id
    best = F.min_by(f"b_{value}", f"b_{area_id}") if field else F.min(f"b_{area_id}")
    hits = points_in_areas(points, areas, cell).groupBy(F.col(f"a_{point_id}").alias(point_id)).agg(best.alias(value))
    return points.join(hits, point_id, "left" if keep_unmatched else "inner")


def cell_id(x: Column, y: Column, size: float, columns: int = 1000) -> Column:
    """Id of a point's cell in a regular grid, by arithmetic: no join is needed."""
    return F.floor(y / F.lit(float(size))).cast("bigint") * columns + F.floor(x / F.lit(float(size))).cast("bigint")


def semi(points: DataFrame, areas: DataFrame, point_id: str, cell: float) -> DataFrame:
    """Points inside at least one area."""
    hits = points_in_areas(points, areas, cell).select(F.col(f"a_{point_id}").alias(point_id))
    return points.join(hits, point_id, "left_semi")


def anti(points: DataFrame, areas: DataFrame, point_id: str, cell: float) -> DataFrame:
    """Points inside no area."""
    hits = points_in_areas(points, areas, cell).select(F.col(f"a_{point_id}").alias(point_id))
    return points.join(hits, point_id, "left_anti")


def semi_any(points: DataFrame, covers: list[DataFrame], point_id: str, cell: float) -> DataFrame:
    """Points inside any area of any cover, rectangles or polygons."""
    hits = None
    for cover in covers:
        found = points_in_areas(points, cover.select(*BOX, *(c for c in ("polygon",) if c in cover.columns)), cell).select(F.col(f"a_{point_id}").alias(point_id))
        hits = found if hits is None else hits.unionByName(found)
    return points.join(hits, point_id, "left_semi")


def anti_below(points: DataFrame, cells: DataFrame, point_id: str, measure: str, least: float, cell: float, exempt: DataFrame | None = None) -> DataFrame:
    """Points not in a cell whose ``measure`` is under ``least``, unless an exempt area holds them."""
    low = points_in_areas(points, cells.where(F.col(measure) < least), cell).select(F.col(f"a_{point_id}").alias(point_id))
    if exempt is not None:
        spared = points_in_areas(points, exempt, cell).select(F.col(f"a_{point_id}").alias(point_id))
        low = low.join(spared, point_id, "left_anti")
    return points.join(low, point_id, "left_anti")


def boxes_meeting(a: DataFrame, b: DataFrame, a_id: str, cell: float) -> DataFrame:
    """Boxes of ``a`` that touch or overlap one of ``b``."""
    hits = box_join(a, b, cell).select(F.col(f"a_{a_id}").alias(a_id))
    return a.join(hits, a_id, "left_semi")


def within_distance(a: DataFrame, b: DataFrame, d: float, cell: float | None = None) -> DataFrame:
    """Pairs of boxes (points are empty boxes) at most ``d`` apart, with their ``distance``."""
    from urbanframe.functions.geometry import box_distance

    pairs = box_join(a, b, cell or max(d, 1.0), margin=d)
    apart = box_distance({c: F.col(f"a_{c}") for c in BOX}, {c: F.col(f"b_{c}") for c in BOX})
    return pairs.withColumn("distance", apart).where(F.col("distance") <= d)


def overlap_filter(cells: DataFrame, regions: DataFrame, cell_key: str, least: float, cell: float) -> DataFrame:
    """Cells of which at least the share ``least`` of their area lies in the regions, each place counted once."""
    from urbanframe.operators.unions import clipped_boxes, union_areas

    inside = union_areas(clipped_boxes(cells, regions, cell_key, cell), [cell_key], cell).withColumnRenamed("area", "_inside")
    own = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    return cells.join(inside, cell_key).where(F.col("_inside") / own >= least).drop("_inside")


def covered_by_other(shapes: DataFrame, key: str, cell: float) -> DataFrame:
    """Pairs of an inner box and another one that covers it: ``inner, outer``."""
    pairs = box_join(shapes, shapes, cell).where(F.col(f"a_{key}") != F.col(f"b_{key}"))
    covers = (F.col("a_xmin") >= F.col("b_xmin")) & (F.col("a_xmax") <= F.col("b_xmax")) & (F.col("a_ymin") >= F.col("b_ymin")) & (F.col("a_ymax") <= F.col("b_ymax"))
    return pairs.where(covers).select(F.col(f"a_{key}").alias("inner"), F.col(f"b_{key}").alias("outer"))


def nearest_edge(points: DataFrame, edges: DataFrame, point_id: str, edge_id: str = "ogc_fid", radius: float = 150.0, farthest: float | None = None) -> DataFrame:
    """Each point's nearest edge: ``point_id, edge_id, distance, before, mx, my``.

    ``before`` is the length of the edge up to the nearest place ``mx, my``.
    Candidates come from tiles within ``radius``; only points without one are
    looked for again, four times as far, up to ``farthest`` or, without it, until
    every point has its edge. Equal distances take the lowest edge id.
    """
    lines = with_line_box(edges.select(edge_id, "line"))
    todo = points.select(point_id, "x", "y")
    out = None
    while True:
        pairs = box_join(with_point_box(todo), lines, radius, margin=radius)
        pairs = pairs.withColumn("_n", nearest_place(F.col("b_line"), F.col("a_x"), F.col("a_y"))).where(F.col("_n.distance") <= radius)
        rank = F.struct(F.round("_n.distance", 9), F.col(f"b_{edge_id}"))
        best = F.min_by(F.struct(F.col(f"b_{edge_id}").alias(edge_id), F.col("_n.distance").alias("distance"), F.col("_n.before").alias("before"), F.col("_n.x").alias("mx"), F.col("_n.y").alias("my")), rank)
        found = checkpointed(pairs.groupBy(F.col(f"a_{point_id}").alias(point_id)).agg(best.alias("b")).select(point_id, "b.*"))
        out = found if out is None else out.unionByName(found)
        radius *= 4
        todo = checkpointed(todo.join(found, point_id, "left_anti"))
        if not todo.limit(1).count():
            return out
        if farthest is None:
            # Beyond this radius every edge has been looked at.
            both = with_point_box(todo).select(*BOX).unionByName(lines.select(*BOX))
            width, height = both.agg(F.max("xmax") - F.min("xmin"), F.max("ymax") - F.min("ymin")).first()
            farthest = float(width + height) if lines.limit(1).count() else 0.0
        if radius > farthest * 4:
            return out


def snap(points: DataFrame, edges: DataFrame, point_id: str, tolerance: float = 500.0) -> DataFrame:
    """Nearest edges no farther than ``tolerance``."""
    return nearest_edge(points, edges, point_id, farthest=tolerance).where(F.col("distance") <= tolerance)
