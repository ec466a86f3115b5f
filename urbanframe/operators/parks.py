"""Open space as true shapes: cutting, linear and public spaces, clusters, outlines, access.

A space is one or more rows of one ``key``, each with a simple polygon (holes
allowed): the parts of a multipolygon. Tag rules and flags are those of
``places``; here every spatial test uses the shapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.functions.geometry import area, exterior, holds, min_circle
from urbanframe.operators.graph import components
from urbanframe.operators.linear import measures_along, points_at
from urbanframe.operators.overlay import difference, dissolve, shared_area, with_box
from urbanframe.operators.shapes import meeting, near, points_near, shared_border
from urbanframe.operators.spatial import BOX, box_join, with_point_box
from urbanframe.session import shuffled, written

#: Share of an area from which it counts as covered.
WHOLE = 1 - 1e-9
#: Tile of edges that access nodes look at: wide beside the distance, as an edge is dealt to all tiles that it may serve.
REACH = 200.0


def cut_out(spaces: DataFrame, excluded: DataFrame, key: str, cell: float) -> DataFrame:
    """``key, part, polygon``: what exclusions leave of each space; one that is wholly covered drops out."""
    own, other = written(with_box(spaces.select(key, "polygon"))), written(with_box(excluded.select("polygon")))
    touched = written(box_join(own.select(key, *BOX), other.select(*BOX), cell).select(F.col(f"a_{key}").alias(key)).distinct())
    cut = difference(own.join(shuffled(touched), key, "left_semi"), other, key, cell).shapes()
    rest = own.join(shuffled(touched), key, "left_anti").select(key, F.lit(1).alias("part"), "polygon")
    return written(rest.unionByName(cut))


def measured(parts: DataFrame, key: str) -> DataFrame:
    """``key, area_ha, diameter, roundness`` of each space: its area, and that over the smallest circle around it."""
    whole = parts.groupBy(key).agg(F.sum(area(F.col("polygon"))).alias("_area"), F.flatten(F.collect_list(exterior(F.col("polygon")))).alias("_points"))
    whole = whole.withColumn("_circle", min_circle(F.array("_points")))
    r = F.col("_circle.r")
    return whole.select(key, (F.col("_area") / 10000.0).alias("area_ha"), (2 * r).alias("diameter"), F.try_divide(F.col("_area"), F.lit(3.141592653589793) * r * r).alias("roundness"))


def overlaps(parts: DataFrame, key: str, cell: float, first: DataFrame | None = None) -> DataFrame:
    """``a, b, shared``: area that different spaces share, both ways; ``first`` narrows side ``a``."""
    slim = with_box(parts.select(key, "polygon"))
    one = slim if first is None else slim.join(first.select(key), key, "left_semi")
    # Without ``first`` a pair is swept once and told both ways.
    pairs = box_join(one, slim, cell).where(F.col(f"a_{key}") < F.col(f"b_{key}") if first is None else F.col(f"a_{key}") != F.col(f"b_{key}"))
    shared = pairs.select(F.col(f"a_{key}").alias("a"), F.col(f"b_{key}").alias("b"), shared_area(F.col("a_polygon"), F.col("b_polygon")).alias("shared"))
    found = shared.groupBy("a", "b").agg(F.sum("shared").alias("shared")).where("shared > 1e-6")
    if first is not None:
        return found
    ways = F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return found.select(ways.alias("_w"), "shared").select("_w.a", "_w.b", "shared")


def covering(found: DataFrame, spaces: DataFrame, key: str) -> DataFrame:
    """``inner, outer`` of ``overlaps`` in which the one covers the other."""
    own = spaces.select(F.col(key).alias("a"), (F.col("area_ha") * 10000.0 * WHOLE).alias("_least"))
    return found.join(own, "a").where("shared >= _least").select(F.col("a").alias("inner"), F.col("b").alias("outer"))


def acceptable_linear(spaces: DataFrame, parts: DataFrame, found: DataFrame, key: str, cell: float) -> DataFrame:
    """``acceptable_linear_feature`` of linear spaces (null for others), by the rule of ``places`` on true shapes.

    ``found`` are the spaces' ``overlaps``.
    """
    flags = lambda side: spaces.select(F.col(key).alias(side), *[F.col(c).alias(f"_{side}_{c}") for c in ("linear_feature", "diameter", "area_ha")])
    linear = spaces.where("linear_feature").select(key)
    border = shared_border(parts.join(linear, key, "left_semi"), parts, key, key, cell, "polygon", "polygon").select(F.col("a_key").alias("a"), F.col("b_key").alias("b"), "length").where("a <> b")
    pairs = found.join(border, ["a", "b"], "full").join(flags("a").where("_a_linear_feature"), "a").join(flags("b"), "b")
    shared, own = F.coalesce("shared", F.lit(0.0)), F.col("_a_area_ha") * 10000.0
    short = F.col("_a_diameter") < 800
    touching = (shared == 0) & (F.coalesce("length", F.lit(0.0)) > 50) & (F.col("a") < F.col("b"))
    related = ~F.col("_b_linear_feature") & ((shared >= own * WHOLE) | (short & ((shared / own > 0.2) | touching)))
    good = pairs.groupBy(F.col("a").alias(key)).agg(F.bool_or(related | (short & (shared / 10000.0 > 0.4))).alias("_good"))
    return spaces.join(good, key, "left").withColumn("acceptable_linear_feature", F.when(F.col("linear_feature"), F.coalesce("_good", F.lit(False)))).drop("_good")


def class_of() -> Column:
    """Class 1 (public, or in public; not linear) and 2 (not public) are clustered, 3 (public, linear) and 4 (waterways) stay single."""
    linear_ok = ~F.col("linear_feature") | F.coalesce("acceptable_linear_feature", F.lit(False))
    return (
        F.when(F.coalesce("linear_tag", F.lit(False)), 4)
        .when((F.col("public_access") | F.col("within_public")) & linear_ok, 1)
        .when(~F.col("public_access") & ~F.col("within_public"), 2)
        .when(F.col("public_access") & F.col("linear_feature"), 3)
    )


class OpenSpaceAreas:
    """Adjacent open spaces as areas with their dissolved shapes.

    ``spaces`` has one row per ``key`` with the flags of ``places`` and may have
    ``tags`` (JSON text); ``parts`` the polygons. ``members`` has ``key, aos_id,
    aos_class``; ``areas()`` a row per area, ``shapes()`` its polygons.
    """

    def __init__(self, spaces: DataFrame, parts: DataFrame, key: str, cell: float, gap: float = 0.001):
        self.key, self.cell = key, cell
        self.spaces, self.parts = spaces, parts
        classed = written(spaces.withColumn("aos_class", class_of()).where("aos_class IS NOT NULL").select(key, "aos_class"))
        pairs = []
        for kind in (1, 2):
            own = parts.join(classed.where(F.col("aos_class") == kind), key, "left_semi")
            pairs.append(near(own, own, key, key, gap, cell, "polygon", "polygon").where("a_key < b_key"))
        label = written(components(pairs[0].unionByName(pairs[1]).select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))))
        named = classed.join(label.select(F.col("node").alias(key), "component"), key, "left")
        self.members = written(named.select(key, F.coalesce("component", key).alias("aos_id"), "aos_class"))
        flags = spaces.select(key, F.array(F.lit("all"), F.when(F.col("public_access"), "public").otherwise("not_public"), F.when(F.col("water_feature"), "water")).alias("_layers"))
        layers = self.members.join(flags, key).select(key, "aos_id", F.explode(F.filter("_layers", lambda c: c.isNotNull())).alias("layer"))
        # A layer of all members is like ``all``, so it is not dealt and swept again.
        sizes = written(layers.groupBy("aos_id", "layer").agg(F.count(F.lit(1)).alias("_n")))
        whole = sizes.where("layer = 'all'").select("aos_id", F.col("_n").alias("_all"))
        self.like = written(sizes.join(shuffled(whole), "aos_id").select("aos_id", "layer", F.when(F.col("_n") == F.col("_all"), "all").otherwise(F.col("layer")).alias("_like")))
        own = layers.join(shuffled(self.like.where("layer = _like").select("aos_id", "layer")), ["aos_id", "layer"])
        keyed = parts.join(shuffled(own), key).select(F.concat_ws(":", "aos_id", "layer").alias("_area"), "polygon")
        self.overlay = dissolve(keyed, "_area", cell)

    def _split(self, df: DataFrame) -> DataFrame:
        kind = dict(self.members.dtypes)["aos_id"]
        own = df.withColumns({"aos_id": F.substring_index("_area", ":", 1).cast(kind), "_like": F.substring_index("_area", ":", -1)}).drop("_area")
        return own.join(shuffled(self.like), ["aos_id", "_like"]).drop("_like")

    def shapes(self, layer: str = "all") -> DataFrame:
        """``aos_id, part, polygon`` of the dissolved ``all``, ``public``, ``not_public`` or ``water`` spaces."""
        return self._split(self.overlay.shapes()).where(F.col("layer") == layer).select("aos_id", "part", "polygon")

    def areas(self) -> DataFrame:
        """``aos_id, aos_class, members, aos_ha, aos_ha_public, aos_ha_not_public, aos_ha_water, water_percent, has_water_feature, attributes``.

        ``has_water_feature`` tells whether the area meets any space with water,
        its own or another's; ``attributes`` are the members' tags, sorted.
        """
        found = self._split(self.overlay.areas())
        each = {"aos_ha": "all", "aos_ha_public": "public", "aos_ha_not_public": "not_public", "aos_ha_water": "water"}
        hectares = found.groupBy("aos_id").agg(*[F.coalesce(F.sum(F.when(F.col("layer") == layer, F.col("area") / 10000.0)), F.lit(0.0)).alias(name) for name, layer in each.items()])
        tags = self.spaces.select(self.key, "tags") if "tags" in self.spaces.columns else self.spaces.select(self.key, F.lit(None).cast("string").alias("tags"))
        sums = self.members.join(tags, self.key).groupBy("aos_id").agg(F.min("aos_class").alias("aos_class"), F.count(F.lit(1)).alias("members"), F.array_sort(F.collect_list("tags")).alias("attributes"))
        # An area meets what any of its members meets, so no shape of a cluster is stitched here, or dealt to all tiles of its box.
        water = self.parts.join(self.spaces.where("water_feature").select(self.key), self.key, "left_semi")
        own = self.parts.join(self.members.select(self.key), self.key, "left_semi")
        met = meeting(own, water, self.key, self.key, self.cell, "polygon", "polygon").select(F.col("a_key").alias(self.key))
        wet = self.members.join(met, self.key, "left_semi").select("aos_id").distinct().withColumn("_wet", F.lit(True))
        out = sums.join(hectares, "aos_id").join(wet, "aos_id", "left")
        percent = F.coalesce(F.try_divide(100 * F.col("aos_ha_water"), F.col("aos_ha")), F.lit(0.0))
        return out.select("aos_id", "aos_class", "members", *each, percent.alias("water_percent"), F.coalesce("_wet", F.lit(False)).alias("has_water_feature"), "attributes")


def aos_public(areas: DataFrame, least_ha: float = 0.001) -> DataFrame:
    """Areas with more than ``least_ha`` of public space; 1.5 for large ones."""
    return areas.where(F.col("aos_ha_public") > least_ha)


def outline_nodes(shapes: DataFrame, key: str, step: float = 20.0) -> DataFrame:
    """``key, node, fraction, x, y``: points every ``step`` metres along the outer rings, numbered from 1 through an area's parts."""
    rings = shapes.where(F.col(key).isNotNull() & F.col("part").isNotNull()).select(key, "part", exterior(F.col("polygon")).alias("line"))
    rows = measures_along(rings, [key, "part"], step, closed=True).withColumn("_n", F.col("_high") - F.col("_low") + 1)
    # Points are counted by segment, before they are made: one pass over the rings.
    ahead = F.sum("_n").over(W.partitionBy(key).orderBy("part")) - F.sum("_n").over(W.partitionBy(key, "part"))
    found = points_at(rows.withColumn("_ahead", ahead), [key, "_ahead"], step)
    fraction = F.try_divide(F.least("metres", "whole"), F.col("whole"))
    return found.select(key, (F.col("_ahead") + F.col("i") + 1).cast("int").alias("node"), fraction.alias("fraction"), "x", "y")


def access_nodes(shapes: DataFrame, areas: DataFrame, edges: DataFrame, key: str, least_ha: float = 0.001, d: float = 30.0) -> DataFrame:
    """``outline_nodes`` of public areas at most ``d`` from an edge's ``line``; ``shapes`` (``key, part, polygon``) are the areas' polygons."""
    public = shapes.join(shuffled(aos_public(areas, least_ha).select(key)), key, "left_semi")
    return points_near(outline_nodes(public, key), edges, d, REACH, "line")


def green_areas(areas: DataFrame, shapes: DataFrame, pixels: DataFrame, key: str, least_ha: float = 1.0, least_mean: float = 0.2, valid: tuple[float, float] = (-1.0, 1.0), cell: float = 200.0) -> DataFrame:
    """``key, aos_ha_public, ndvi_mean`` of large public areas whose pixels (``x, y, value``) in the valid range have a high mean.

    ``shapes`` are the areas' public polygons; a pixel counts once for an area.
    """
    large = written(areas.where(F.col("aos_ha_public") >= least_ha).select(key, "aos_ha_public"))
    # Boxes are written too: the join's filters on their nested expressions would go down to the few tasks that read all shapes.
    boxed = written(with_box(shapes.join(shuffled(large), key, "left_semi").select(key, "polygon")))
    good = pixels.where(F.col("value").between(*valid))
    pairs = box_join(with_point_box(good.select("x", "y", "value")), boxed, cell)
    inside = pairs.where(holds(F.col("b_polygon"), F.col("a_x"), F.col("a_y")))
    means = inside.groupBy(F.col(f"b_{key}").alias(key)).agg(F.avg("a_value").alias("ndvi_mean")).where(F.col("ndvi_mean") >= least_mean)
    return large.join(means, key)


def green_access(shapes: DataFrame, green: DataFrame, edges: DataFrame, key: str, d: float = 30.0) -> DataFrame:
    """Access nodes of green areas, once each; no other area's outline is made."""
    return access_nodes(shapes, green, edges, key, d=d)


def custom_open_space(layer: DataFrame, boundary: DataFrame, key: str, cell: float) -> DataFrame:
    """A given layer in place of tagged open space: ``key`` and all columns, ``aos_ha_public``, of the shapes that meet the boundary.

    Raises ``ValueError`` where none does, as an empty layer would read as an absence of open space.
    """
    met = meeting(layer, boundary.withColumn("_b", F.lit(1)), key, "_b", cell, "polygon", "polygon").select(F.col("a_key").alias(key))
    found = written(layer.join(met, key, "left_semi").withColumn("aos_ha_public", area(F.col("polygon")) / 10000.0))
    if not found.head(1):
        raise ValueError("the custom open space layer has no shape in the study region: check its source and query")
    return found


def open_space_areas(config: dict | None, layers: dict[str, DataFrame], boundary: DataFrame, tagged, key: str, cell: float) -> DataFrame:
    """Public areas from the layer that ``config["data"]`` names, or from tags (``tagged()``) where none is configured.

    ``config["where"]`` is an SQL condition on the layer. An unknown layer raises ``KeyError``.
    """
    if not config or config.get("data") is None:
        return tagged()
    layer = layers[config["data"]]
    if config.get("where"):
        layer = layer.where(config["where"])
    return custom_open_space(layer, boundary, key, cell)
