"""Scores, composites, roll-ups and comparison of indicators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.functions.geometry import box_overlap_area
from urbanframe.functions.scalars import half_even, row_sum
from urbanframe.operators.spatial import BOX, attach_area, box_join, overlap_filter, points_in_areas, with_point_box, within_distance

# -- access scores ------------------------------------------------------------


def with_stats(df: DataFrame, stats: dict[str, Column]) -> DataFrame:
    """Adds whole-table aggregates as columns; the other side is one row."""
    return df.crossJoin(F.broadcast(df.agg(*[c.alias(n) for n, c in stats.items()])))


def binary_access(df: DataFrame, columns: dict[str, str], threshold: float = 500.0) -> DataFrame:
    """1 within the threshold, else 0; null distances give 0, but a column of nulls stays null."""
    counted = with_stats(df, {f"_n_{c}": F.count(c) for c in columns})
    scores = {out: F.when(F.col(f"_n_{c}") > 0, F.coalesce((F.col(c) <= threshold).cast("int"), F.lit(0))) for c, out in columns.items()}
    return counted.withColumns(scores).drop(*[f"_n_{c}" for c in columns])


def soft_access(df: DataFrame, columns: dict[str, str], threshold: float = 500.0, k: float = 5.0) -> DataFrame:
    """Logistic decline around the threshold; null gives 0."""
    return df.withColumns({out: F.coalesce(1 / (1 + F.exp(k * (F.col(c) - threshold) / threshold)), F.lit(0.0)) for c, out in columns.items()})


def gaussian_access(df: DataFrame, columns: dict[str, str], threshold: float = 500.0, k: float = 129842.0) -> DataFrame:
    """1 within the threshold, then a Gaussian decline of the distance beyond it; null gives 0."""
    def score(d: Column) -> Column:
        beyond = d - threshold
        return F.coalesce(F.when(d <= threshold, 1.0).otherwise(F.exp(-(beyond * beyond) / k)), F.lit(0.0))

    return df.withColumns({out: score(F.col(c)) for c, out in columns.items()})


# -- composites ---------------------------------------------------------------


def row_max(*columns: str) -> Column:
    """Largest of a row's values, nulls skipped; all null gives null."""
    return F.greatest(*map(F.col, columns)) if len(columns) > 1 else F.col(columns[0])


def sum_of_z(df: DataFrame, columns: list[str], out: str) -> DataFrame:
    """Sum of z-scores (sample deviation); a null or undefined z counts 0."""
    stats = {f"_m_{c}": F.avg(c) for c in columns} | {f"_s_{c}": F.stddev_samp(c) for c in columns}
    z = lambda c: F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}"))
    return with_stats(df, stats).withColumn(out, row_sum(*map(z, columns))).drop(*stats)


def gte_flag(x: Column, threshold: float) -> Column:
    return F.coalesce(x >= threshold, F.lit(False)).cast("int")


def apply_formulas(df: DataFrame, formulas: list[dict], layers: dict[str, DataFrame] | None = None) -> DataFrame:
    """Named formulas in order: ``sum, max, sum_of_z_scores, greater_than_or_equal_to`` and ``intersection``.

    An intersection takes ``field`` of the area of ``layer`` (one of ``layers``,
    with ``area_id``) that holds each point (``point_id, x, y``); outside all
    areas it is null.
    """
    for f in formulas:
        kind, columns, out = f["formula"], f.get("columns", []), f["name"]
        if kind == "sum":
            df = df.withColumn(out, row_sum(*map(F.col, columns)))
        elif kind == "max":
            df = df.withColumn(out, row_max(*columns))
        elif kind == "sum_of_z_scores":
            df = sum_of_z(df, columns, out)
        elif kind == "greater_than_or_equal_to":
            df = df.withColumn(out, gte_flag(F.col(columns[0]), f["threshold"]))
        elif kind == "intersection":
            areas = layers[f["layer"]].withColumn(out, F.col(f["field"]))
            df = attach_area(df, areas, f.get("point_id", "point_id"), f["area_id"], f.get("tile", 1000.0), field=out)
        else:
            raise ValueError(f"unknown formula {kind}")
    return df


def relative_indicator(df: DataFrame, columns: list[str], out: str, reference: dict[str, tuple[float, float]] | None = None, pool: DataFrame | None = None) -> DataFrame:
    """Sum of z-scores against stated means and deviations, or those of a pooled table; null propagates."""
    if reference is not None:
        z = [F.try_divide(F.col(c) - reference[c][0], F.lit(float(reference[c][1]))) for c in columns]
        return df.withColumn(out, sum(z[1:], z[0]))
    stats = (df if pool is None else pool).agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    z = [F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_s_{c}")) for c in columns]
    return df.crossJoin(F.broadcast(stats)).withColumn(out, sum(z[1:], z[0])).drop(*stats.columns)


# -- roll-ups -----------------------------------------------------------------


def with_density(df: DataFrame, area: Column) -> DataFrame:
    """``area_sqkm`` of square metres, and people and intersections per square kilometre."""
    df = df.withColumn("area_sqkm", area / 1e6)
    per = lambda c: F.try_divide(F.col(c).cast("double"), F.col("area_sqkm"))
    out = {"pop_per_sqkm": per("pop_est")} if "pop_est" in df.columns else {}
    return df.withColumns(out | ({"intersections_per_sqkm": per("intersection_count")} if "intersection_count" in df.columns else {}))


def region_totals(cells: DataFrame, area: Column, columns: list[str]) -> DataFrame:
    """One row of a region's sums with its densities; ``area`` in square metres."""
    return with_density(cells.agg(*[F.sum(c).alias(c) for c in columns]), area)


def scale_pct(df: DataFrame) -> DataFrame:
    """Shares in ``pct_*`` columns as percentages."""
    return df.withColumns({c: F.col(c) * 100 for c in df.columns if c.startswith("pct_")})


def grid_indicators(points: DataFrame, grid: DataFrame, region: DataFrame, columns: dict[str, str], cell: float = 1000.0, least: float = 0.1) -> DataFrame:
    """Unweighted means of sample points per grid cell, with their count.

    ``columns`` maps point columns to indicator names. Cells without points or
    with less than ``least`` of their area in the region are left out.
    """
    means = points.groupBy("grid_id").agg(F.count(F.lit(1)).alias("urban_sample_point_count"), *[F.avg(c).alias(n) for c, n in columns.items()])
    kept = overlap_filter(grid, region, "grid_id", least, cell)
    return scale_pct(kept.join(means, "grid_id"))


def population_denominator(config: dict) -> str:
    """The column that people are counted in: ``pop_est`` where the configured denominator is the
    configured data field (or none is configured), else that column. Case does not matter."""
    field = config.get("vector_population_data_field")
    denominator = str(config.get("population_denominator") or "pop_est").lower()
    return "pop_est" if field is not None and denominator == field.lower() else denominator


def population_mean(column: str, population: str = "pop_est") -> Column:
    """Weighted mean over all population, cells without the indicator included; null if none has it."""
    return F.when(F.count(column) > 0, F.try_divide(F.sum(F.col(population) * F.col(column)).cast("double"), F.sum(population).cast("double")))


def city_indicators(grid: DataFrame, columns: dict[str, str], plain: dict[str, str] | None = None, population: str = "pop_est") -> DataFrame:
    """One row: population-weighted means, plain means and the sample count."""
    outs = [population_mean(c, population).alias(n) for c, n in columns.items()] + [F.avg(c).alias(n) for c, n in (plain or {}).items()]
    return grid.agg(F.sum(population).alias(population), F.sum("urban_sample_point_count").alias("urban_sample_point_count"), *outs)


def threshold_pct(condition: Column, population: str = "pop_est") -> Column:
    """Share of people, in percent to one decimal, for whom a condition holds."""
    return half_even(F.try_divide(100.0 * F.coalesce(F.sum(F.when(condition, F.col(population))), F.lit(0)), F.sum(population).cast("double")), 1)


def count_in_cells(grid: DataFrame, points: DataFrame, cell: float, out: str = "intersection_count") -> DataFrame:
    """Points per cell, none as 0; counted before the join so no rows fan out."""
    counts = points_in_areas(points, grid, cell).groupBy(F.col("b_grid_id").alias("grid_id")).agg(F.count(F.lit(1)).alias(out))
    return grid.join(counts, "grid_id", "left").withColumn(out, F.coalesce(out, F.lit(0)))


# -- custom aggregation -------------------------------------------------------


@dataclass
class Weight:
    """How a custom aggregation weighs its sources."""

    source: str | None = None  # column of the source: weighted means
    boundary: str | None = None  # column of the areas: reported, means unweighted
    note: str | None = None


def resolve_weight(weight: str | None, source_columns: list[str], area_columns: list[str], areal: bool) -> Weight:
    """Areal sources with the column are weighted by it; otherwise an area's own
    column is reported; for point sources a weight is ignored; a missing one is noted."""
    if weight is None:
        return Weight()
    if areal and weight in source_columns:
        return Weight(source=weight)
    if weight in area_columns:
        return Weight(boundary=weight)
    if weight in source_columns:
        return Weight(note=f"{weight} is ignored: the sources are points")
    return Weight(note=f"{weight} is in neither table")


def resolve_keep_columns(spec: str | None, key: str, columns: list[str]) -> list[str]:
    """Real names of a comma list of columns, any case; blanks, unknown names and the key drop out."""
    known = {c.lower(): c for c in columns}
    wanted = [w.strip().lower() for w in (spec or "").split(",")]
    return [known[w] for w in dict.fromkeys(wanted) if w and w != key.lower() and w in known]


def clip_areas(areas: DataFrame, region: dict[str, float]) -> DataFrame:
    """Rectangles cut to a region; those without area go."""
    box = {"xmin": F.greatest("xmin", F.lit(region["xmin"])), "ymin": F.greatest("ymin", F.lit(region["ymin"])), "xmax": F.least("xmax", F.lit(region["xmax"])), "ymax": F.least("ymax", F.lit(region["ymax"]))}
    cut = areas.withColumns(box)
    return cut.where("xmax > xmin AND ymax > ymin").withColumn("area_sqkm", (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")) / 1e6)


def custom_aggregate(
    source: DataFrame,
    areas: DataFrame,
    columns: dict[str, str],
    area_id: str,
    areal: bool,
    cell: float = 1000.0,
    weight: str | None = None,
    apportion: bool = True,
    within: float | None = None,
    keep: str | None = None,
) -> DataFrame:
    """Indicators of sources per custom area.

    ``columns`` maps source columns to reported names ('' for none). Means are
    plain (``avg_`` names where none is given, ``pct`` names in percent), or
    weighted by a source column times the share of the source that lies in the
    area (``<weight>_<column>``), null where the weights add up to nothing.
    ``within`` takes sources up to a distance instead, whole. Areas without a
    source drop out.
    """
    how = resolve_weight(weight, source.columns, areas.columns, areal)
    boxed = source if areal else with_point_box(source)
    a, b = ({c: F.col(f"{side}_{c}") for c in BOX} for side in "ab")
    if within is not None:
        pairs = within_distance(boxed, areas, within, cell)
    elif areal:
        pairs = box_join(boxed, areas, cell).where(box_overlap_area(a, b) > 0)
    else:
        pairs = points_in_areas(source, areas, cell)
    own = (a["xmax"] - a["xmin"]) * (a["ymax"] - a["ymin"])
    share = F.lit(1.0)
    if areal and apportion and within is None:
        share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide(box_overlap_area(a, b).cast("double"), own.cast("double")), F.lit(0.0))))
    outs = [F.count(F.lit(1)).alias("unit_count")]
    for c, name in columns.items():
        scale = 100.0 if name.startswith("pct") else 1.0
        if how.source:
            w = F.col(f"a_{how.source}") * share
            outs.append(F.try_divide(F.sum(w * F.col(f"a_{c}")), F.sum(w)).alias(f"{how.source}_{c}"))
        else:
            outs.append((F.avg(f"a_{c}") * scale).alias(name or f"avg_{c}"))
    if how.source and how.source != "unit_count":  # that name is taken by the count
        outs.append(F.sum(F.col(f"a_{how.source}") * share).alias(how.source))
    if how.boundary:
        outs.append(F.max(f"b_{how.boundary}").alias(how.boundary))
    kept = [F.first(f"b_{c}").alias(c) for c in resolve_keep_columns(keep, area_id, areas.columns)]
    return pairs.groupBy(F.col(f"b_{area_id}").alias(area_id)).agg(*kept, *outs)


def custom_aggregates(sources: dict[str, tuple[DataFrame, bool]], plans: list[dict]) -> dict[str, DataFrame]:
    """Aggregations in order; a later one may take an earlier one's result as its
    source (joined to its areas for their boxes). An unknown source is skipped."""
    done = dict(sources)
    out = {}
    for plan in plans:
        if plan["source"] not in done:
            continue
        table, areal = done[plan["source"]]
        found = custom_aggregate(table, plan["areas"], areal=areal, **plan["options"])
        out[plan["name"]] = found
        key = plan["options"]["area_id"]
        done[plan["name"]] = (found.join(plan["areas"].select(key, *BOX), key), True)
    return out


# -- comparison and reports ---------------------------------------------------


def shared_columns(frames: list[DataFrame]) -> list[str]:
    """Columns that all frames have, in the first one's order."""
    return [c for c in frames[0].columns if all(c in f.columns for f in frames[1:])]


def compare(regions: dict[str, DataFrame]) -> DataFrame:
    """One row per shared metric and a column per region; with two regions the
    difference and the percentage change too (null where the first is 0)."""
    names = list(regions)
    metrics = shared_columns(list(regions.values()))
    long = None
    for name, frame in regions.items():
        rows = frame.select(F.lit(name).alias("region"), *[F.col(m).try_cast("double").alias(m) for m in metrics]).unpivot("region", metrics, "metric", "value")
        long = rows if long is None else long.unionByName(rows)
    wide = long.groupBy("metric").pivot("region", names).agg(F.first("value", ignorenulls=True))
    if len(names) == 2:
        a, b = map(F.col, names)
        wide = wide.withColumn("difference", b - a).withColumn("pct_change", F.try_divide(100.0 * (F.col(names[1]) - F.col(names[0])), F.col(names[0])))
    return wide


def access_profile(city: DataFrame, references: DataFrame, metrics: list[str]) -> DataFrame:
    """City values beside reference percentiles; a missing value is 0 and labelled."""
    rows = city.select(*[F.col(m).cast("double").alias(m) for m in metrics]).unpivot([], metrics, "metric", "value")
    label = F.when(F.col("value").isNull(), F.concat("metric", F.lit(" (not evaluated)"))).otherwise(F.col("metric"))
    return rows.withColumn("label", label).withColumn("value", F.coalesce("value", F.lit(0.0))).join(F.broadcast(references), "metric", "left")


def region_report(grid: DataFrame, reference: dict[str, tuple[float, float]], columns: list[str], density: dict[str, float]) -> DataFrame:
    """One row: people in cells above and below the reference composite, and above density thresholds."""
    scored = relative_indicator(grid, columns, "_relative", reference)
    outs = [threshold_pct(F.col("_relative") > 0).alias("pct_above_reference"), threshold_pct(F.col("_relative") < 0).alias("pct_below_reference")]
    return scored.agg(*outs, *[threshold_pct(F.col(c) > t).alias(f"pct_above_{c}") for c, t in density.items()])


def ffill(df: DataFrame, columns: list[str], order: str, by: list[str] | None = None) -> DataFrame:
    """Last known value at or before each row."""
    w = W.partitionBy(*(by or [])).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumns({c: F.last(c, True).over(w) for c in columns})
