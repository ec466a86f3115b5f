"""Pixel table operators: masks, indices, composites, zones.

A pixel table is long: one row per pixel and observation, with band columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanframe.functions.geometry import box_overlap_area
from urbanframe.functions.scalars import bits_clear, clamp, row_mean
from urbanframe.operators.indicators import with_stats
from urbanframe.operators.quantiles import quantiles
from urbanframe.operators.spatial import BOX, box_join, points_in_areas, semi
from urbanframe.operators.unions import clipped_boxes, union_areas

# Cloud and cirrus bits, and the five low bits, of quality bands.
CLOUD_BITS = 1 << 10 | 1 << 11
LOW_BITS = 0b11111


def mask_scale(px: DataFrame, qa: str, mask: int, bands: list[str], scale: float = 1.0, offset: float = 0.0) -> DataFrame:
    """Observations without a flagged bit, with their bands scaled."""
    return px.where(bits_clear(F.col(qa), mask)).withColumns({b: F.col(b) * scale + offset for b in bands})


def norm_diff(a: Column, b: Column) -> Column:
    """(a - b) / (a + b); null where the sum is 0."""
    return F.try_divide((a - b).cast("double"), (a + b).cast("double"))


def albedo(b2: Column, b4: Column, b5: Column, b6: Column, b7: Column) -> Column:
    """Short-wave albedo from five bands."""
    return 0.356 * b2 + 0.130 * b4 + 0.373 * b5 + 0.085 * b6 + 0.072 * b7 - 0.0018


def mean_composite(px: DataFrame, band: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Mean per pixel over a time range (end excluded)."""
    if start:
        px = px.where((F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))
    return px.groupBy("pixel_id").agg(F.avg(band).alias(band))


def monthly_max_mean(px: DataFrame, band: str) -> DataFrame:
    """Largest value per month and pixel, then the mean over pixels of each month."""
    peak = px.groupBy(F.month("ts").alias("month"), "pixel_id").agg(F.max(band).alias(band))
    return peak.groupBy("month").agg(F.avg(band).alias(band))


def hottest_third(monthly: DataFrame, band: str) -> DataFrame:
    """Start month and mean of the hottest four months in a row, the year taken as a ring.

    A month that is missing leaves the mean to the others; the lowest month wins ties.
    """
    spread = monthly.select(F.explode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (F.col("month") - i + 11) % 12 + 1)).alias("start"), band)
    return spread.groupBy("start").agg(F.avg(band).alias(band)).agg(F.max_by(F.struct("start", band), F.struct(F.col(band), -F.col("start"))).alias("b")).select("b.*")


def in_hottest_third(px: DataFrame, band: str, year: int, months: int = 4) -> DataFrame:
    """Pixels of the hottest third of the year that starts in ``year``: from the first of its start month on
    for ``months`` months, past the end of the year where the start month is late."""
    start = hottest_third(monthly_max_mean(px, band), band).select(F.make_date(F.lit(year), "start", F.lit(1)).cast("timestamp_ntz").alias("_from"), F.add_months(F.make_date(F.lit(year), "start", F.lit(1)), months).cast("timestamp_ntz").alias("_to"))
    return px.crossJoin(F.broadcast(start)).where((F.col("ts") >= F.col("_from")) & (F.col("ts") < F.col("_to"))).drop("_from", "_to")  # one row


def invert(x: Column, top: float) -> Column:
    return F.lit(top) - x


def remap(x: Column, ranks: dict[int, int]) -> Column:
    """Classes to ranks; others are null."""
    return F.try_element_at(F.create_map(*[F.lit(v) for kv in ranks.items() for v in kv]), x)


def normalise(px: DataFrame, column: str, out: str, land: Column | None = None, fill: float | None = None) -> DataFrame:
    """Min-max to 0..100, times a land share in percent where given, held to 0..100."""
    own = with_stats(px, {"_lo": F.min(column), "_hi": F.max(column)})
    share = F.try_divide((F.col(column) - F.col("_lo")).cast("double"), (F.col("_hi") - F.col("_lo")).cast("double")) * 100
    if land is not None:
        share = share * land / 100
    value = clamp(share, 0.0, 100.0)
    return own.withColumn(out, value if fill is None else F.coalesce(value, F.lit(fill))).drop("_lo", "_hi")


def land_share(cells: DataFrame, water: DataFrame, key: str, cell: float) -> DataFrame:
    """Percentage of each cell that is not water; overlapping waters count once."""
    own = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    wet = union_areas(clipped_boxes(cells, water, key, cell), [key], cell).withColumnRenamed("area", "_wet")
    return cells.join(wet, key, "left").withColumn("land_pct", F.greatest(F.lit(0.0), 100 - 100.0 * F.coalesce("_wet", F.lit(0.0)) / own)).drop("_wet")


def age_ratios(px: DataFrame, young: list[str], working: list[str], old: list[str]) -> DataFrame:
    """Share of the young and old, and the young per working-age person, in percent; empty cells are null."""
    total = lambda cs: sum((F.coalesce(F.col(c), F.lit(0)) for c in cs[1:]), F.coalesce(F.col(cs[0]), F.lit(0))).cast("double")
    everyone = total(young) + total(working) + total(old)
    pct = lambda a, b: F.try_divide(100 * a, F.nullif(b, F.lit(0.0)))
    return px.withColumns({"vulnerable_pct": pct(total(young) + total(old), everyone), "child_dependency": pct(total(young), total(working))})


def equal_weight(px: DataFrame, columns: list[str], out: str) -> DataFrame:
    return px.withColumn(out, row_mean(*map(F.col, columns)))


def quintile_class(px: DataFrame, column: str, out: str) -> DataFrame:
    """Classes 1 to 5: one more for each quintile limit that a value passes; null stays null."""
    limits = quantiles(px, column, [0.2, 0.4, 0.6, 0.8])
    passed = sum((F.when(F.col(column) > F.lit(q), 1).otherwise(0) for q in limits), F.lit(1))
    return px.withColumn(out, F.when(F.col(column).isNotNull(), passed))


def zonal_mean(px: DataFrame, zones: DataFrame, key: str, bands: list[str], cell: float, least: tuple[str, float] | None = None) -> DataFrame:
    """Mean of bands per zone; zones without a value in any band go, as do those under a floor."""
    means = points_in_areas(px, zones, cell).groupBy(F.col(f"b_{key}").alias(key)).agg(*[F.avg(f"a_{b}").alias(b) for b in bands]).dropna(subset=bands)
    return means.where(F.col(least[0]) >= least[1]) if least else means


def clip_pixels(px: DataFrame, region: DataFrame, cell: float) -> DataFrame:
    """Pixels inside a region."""
    return semi(px, region, "pixel_id", cell)


def has_valid(px: DataFrame, column: str) -> DataFrame:
    """One row: whether any value lies in [-1, 1]."""
    return px.agg(F.coalesce(F.bool_or(F.col(column).between(-1, 1)), F.lit(False)).alias("valid"))


def greenery_pct(px: DataFrame, column: str, least: float = 0.2) -> DataFrame:
    """One row: percentage of valid pixels that are vegetated."""
    return px.agg(F.try_divide(100.0 * F.count_if(F.col(column) >= least), F.count(column).cast("double")).alias("greenery_pct"))


def mosaic(px: DataFrame, band: str, order: list[str]) -> DataFrame:
    """Last known value of each pixel."""
    return px.where(F.col(band).isNotNull()).groupBy("pixel_id").agg(F.max_by(band, F.struct(*order)).alias(band))


def grid_step(width: float, height: float) -> float:
    """Cell size for a region of a width and height in metres: finer under 25 square kilometres."""
    return 100.0 if width * height < 25e6 else 1000.0


def uniform_grid(extent: DataFrame, step: float) -> DataFrame:
    """Square cells over an extent of one row: ``gx, gy`` and box."""
    xs, ys = (F.sequence(F.floor(F.col(f"{a}min") / step), F.ceil(F.col(f"{a}max") / step) - 1) for a in "xy")
    rows = extent.select(F.explode(xs).alias("gx"), ys.alias("_ys")).select("gx", F.explode("_ys").alias("gy"))
    return rows.withColumns({"xmin": F.col("gx") * step, "ymin": F.col("gy") * step, "xmax": (F.col("gx") + 1) * step, "ymax": (F.col("gy") + 1) * step})


def regrid_sum(cells: DataFrame, value: str, step: float) -> DataFrame:
    """Values moved to square cells of another size by shared area; the total stays."""
    tile = lambda c: F.floor(F.col(c) / step).cast("bigint")
    last = lambda c: (F.ceil(F.col(c) / step) - 1).cast("bigint")
    rows = cells.withColumn("gx", F.explode(F.sequence(tile("xmin"), last("xmax")))).withColumn("gy", F.explode(F.sequence(tile("ymin"), last("ymax"))))
    target = {"xmin": F.col("gx") * step, "ymin": F.col("gy") * step, "xmax": (F.col("gx") + 1) * step, "ymax": (F.col("gy") + 1) * step}
    own = (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))
    share = box_overlap_area({c: F.col(c) for c in BOX}, target) / own
    return rows.groupBy("gx", "gy").agg(F.sum(F.col(value) * share).alias(value))
