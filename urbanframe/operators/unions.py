"""Areas of unions of rectangles, each place counted once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanframe.functions.geometry import _sizes
from urbanframe.operators.spatial import BOX, box_join

#: Pieces of boxes in strips that are swept at once, or those of one strip.
SWEPT = 1_000_000


def clipped_boxes(a: DataFrame, b: DataFrame, key: str, cell: float) -> DataFrame:
    """``key`` of ``a`` and the part of its box that each box of ``b`` shares with it."""
    return box_join(a, b, cell).select(F.col(f"a_{key}").alias(key), *[f(f"a_{c}", f"b_{c}").alias(c) for c, f in zip(BOX, (F.greatest, F.greatest, F.least, F.least))])


def _heights(first: np.ndarray, last: np.ndarray, low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Height that boxes cover in each of ``n`` strips, counted once; a box spans the strips from ``first`` up to before ``last``."""
    out = np.zeros(n)
    held = np.cumsum(np.cumsum(np.bincount(first, minlength=n) - np.bincount(last, minlength=n)))
    cuts = np.searchsorted(held, np.arange(SWEPT, held[-1] + 1, SWEPT)) + 1
    cuts = np.unique(np.concatenate([[0], cuts, [n]]))
    for start, stop in zip(cuts[:-1], cuts[1:]):
        box = np.flatnonzero((first < stop) & (last > start))
        since, until = np.maximum(first[box], start), np.minimum(last[box], stop)
        times = until - since
        strip = np.repeat(since - (np.cumsum(times) - times), times) + np.arange(times.sum())
        box = np.repeat(box, times)
        order = np.lexsort((low[box], strip))
        strip, bottom = strip[order], low[box[order]]
        tops, rank = np.unique(high[box[order]], return_inverse=True)
        # The highest top so far: strips ascend, so the one of a strip before is lower than any of this one.
        known = np.maximum.accumulate(strip * len(tops) + rank)[:-1]
        reach = np.full(len(strip), -np.inf)
        reach[1:] = np.where(strip[1:] == strip[:-1], tops[known % len(tops)], -np.inf)
        out += np.bincount(strip, np.maximum(0.0, tops[rank] - np.maximum(bottom, reach)), n)
    return out


def _union_area(boxes: pa.Array) -> pa.Array:
    n, flat = _sizes(boxes), boxes.flatten()
    if not len(flat):
        return pa.array(np.zeros(len(boxes)))
    xmin, ymin, xmax, ymax = (flat.field(c).to_numpy(zero_copy_only=False) for c in BOX)
    # Strips lie between neighbouring x edges of a row's boxes.
    row, x = np.tile(np.repeat(np.arange(len(boxes)), n), 2), np.concatenate([xmin, xmax])
    order = np.lexsort((x, row))
    row, x = row[order], x[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (x[1:] != x[:-1])])
    place = np.empty(len(order), int)
    place[order] = np.cumsum(new) - 1
    row, x = row[new], x[new]
    heights = _heights(*np.split(place, 2), ymin, ymax, len(x))
    return pa.array(np.bincount(row, np.append(np.diff(x), 0.0) * heights, len(boxes)))


def union_area(boxes: Column) -> Column:
    """Area of the union of an array of boxes (structs of doubles), by batches."""
    return F.arrow_udf(_union_area, "double").asNondeterministic()(boxes)


def union_areas(boxes: DataFrame, keys: list[str], cell: float) -> DataFrame:
    """``keys, area`` of the union of each key's boxes, from the parts in each tile."""
    side = F.lit(float(cell))
    tile = lambda c: F.floor(F.col(c) / side).cast("bigint")
    dealt = boxes.withColumn("_tx", F.explode(F.sequence(tile("xmin"), tile("xmax")))).withColumn("_ty", F.explode(F.sequence(tile("ymin"), tile("ymax"))))
    low = {"xmin": F.greatest("xmin", F.col("_tx") * side), "ymin": F.greatest("ymin", F.col("_ty") * side)}
    high = {"xmax": F.least("xmax", (F.col("_tx") + 1) * side), "ymax": F.least("ymax", (F.col("_ty") + 1) * side)}
    parts = dealt.withColumns(low | high).where("xmin < xmax AND ymin < ymax")
    # Copies of a box are made one before they are shuffled.
    tiles = parts.groupBy(*keys, "_tx", "_ty").agg(F.collect_set(F.struct(*[F.col(c).cast("double").alias(c) for c in BOX])).alias("_all"))
    found = tiles.select(*keys, union_area(F.col("_all")).alias("area")).groupBy(*keys).agg(F.sum("area").alias("area"))
    return boxes.select(*keys).distinct().join(found, keys, "left").withColumn("area", F.coalesce("area", F.lit(0.0)))
