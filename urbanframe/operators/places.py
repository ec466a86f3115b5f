"""Destinations from tags, sample points, and open space."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanframe.functions.geometry import box_overlap_area, box_shared_border, centroid, make_point, nearest_place
from urbanframe.operators.graph import components_by_place
from urbanframe.operators.spatial import BOX, block_of, box_join, covered_by_other, points_in_areas, with_line_box, with_point_box, within_distance
from urbanframe.operators.unions import clipped_boxes, union_areas
from urbanframe.session import checkpointed

# -- destinations -------------------------------------------------------------


def rule_condition(rules: list[dict]) -> Column:
    """One destination's rules as a condition.

    AND rules all hold, one of the OR rules holds, and the NOT rules all hold. The
    value ``NULL`` asks for any value of the key. A NOT rule is met by another
    value, or where access is untagged.
    """
    def clause(r: dict) -> Column:
        tag = F.col(r["key"])
        if r["value"] == "NULL":
            return tag.isNotNull()
        if r["condition"] == "NOT":
            return (tag != r["value"]) | F.col("access").isNull()
        return tag == r["value"]

    groups = {c: [clause(r) for r in rules if r["condition"] == c] for c in ("AND", "OR", "NOT")}
    parts = [reduce(lambda a, b: a & b, groups[c]) for c in ("AND", "NOT") if groups[c]]
    parts += [reduce(lambda a, b: a | b, groups["OR"])] if groups["OR"] else []
    return F.coalesce(reduce(lambda a, b: a & b, parts), F.lit(False))


def classify_tags(features: DataFrame, rules: dict[str, list[dict]]) -> DataFrame:
    """Features with each destination name whose rules they meet, in one scan."""
    names = F.array(*[F.when(rule_condition(r), F.lit(name)) for name, r in rules.items()])
    return features.withColumn("dest_name", F.explode(F.filter(names, lambda n: n.isNotNull())))


def destinations(points: DataFrame, areas: DataFrame) -> DataFrame:
    """Points as they are and areas by their centroid (of ``polygon`` where there is one, else of the box): ``osm_id, dest_name, x, y``."""
    place = centroid(F.col("polygon")) if "polygon" in areas.columns else make_point((F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2)
    middle = areas.select("osm_id", "dest_name", place.alias("_p")).select("osm_id", "dest_name", F.col("_p.x").alias("x"), F.col("_p.y").alias("y"))
    return points.select("osm_id", "dest_name", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).unionByName(middle)


def add_pois(found: DataFrame, pois: DataFrame, replace: list[str]) -> DataFrame:
    """Adds own points of interest; names in ``replace`` lose their tag-derived ones."""
    return found.where(~F.col("dest_name").isin(replace)).unionByName(pois) if replace else found.unionByName(pois)


def configured_pois(tagged: DataFrame, config: dict[str, dict], layers: dict[str, DataFrame], known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Destinations with own points of interest as ``config`` says, and the table of destination types.

    ``config`` has, by destination name, ``data`` (a key of ``layers``; without
    it the entry is skipped), ``replace`` (the tag-derived ones go, also where the
    entry has no data) and perhaps ``dest_name_full`` and ``domain``. Layers have
    ``x, y`` or a ``polygon``, whose centroid counts. Names come from ``known``
    (``dest_name, dest_full_name, domain``), else from the entry, else they are
    the destination name and ``Custom``. A layer that isn't there raises ``KeyError``.

    Returns ``osm_id, dest_name, dest_name_full, x, y`` and ``dest_name,
    dest_name_full, domain, count``.
    """
    replaced = [name for name, entry in config.items() if entry.get("replace")]
    found = (tagged.where(~F.col("dest_name").isin(replaced)) if replaced else tagged).select(F.col("osm_id").cast("string").alias("osm_id"), "dest_name", "x", "y")
    for name, entry in config.items():
        if entry.get("data") is None:
            continue
        layer = layers[entry["data"]]
        place = centroid(F.col("polygon")) if "polygon" in layer.columns else make_point(F.col("x"), F.col("y"))
        own = layer.select(place.alias("_p")).select(F.lit(None).cast("string").alias("osm_id"), F.lit(name).alias("dest_name"), F.col("_p.x").alias("x"), F.col("_p.y").alias("y"))
        found = found.unionByName(own)
    entries = [(name, entry.get("dest_name_full"), entry.get("domain")) for name, entry in config.items()]
    given = found.sparkSession.createDataFrame(entries, "dest_name string, _full string, _domain string")  # a row per configured name
    looked_up = known.groupBy("dest_name").agg(F.first("dest_full_name").alias("_known"), F.first("domain").alias("_known_domain"))
    types = dest_type_counts(found).join(looked_up, "dest_name", "left").join(F.broadcast(given), "dest_name", "left")
    types = types.select("dest_name", F.coalesce("_known", "_full", "dest_name").alias("dest_name_full"), F.coalesce("_known_domain", "_domain", F.lit("Custom")).alias("domain"), "count")
    named = found.join(types.select("dest_name", "dest_name_full"), "dest_name")
    return named.select("osm_id", "dest_name", "dest_name_full", "x", "y"), types


def dest_type_counts(dest: DataFrame) -> DataFrame:
    """True count per destination type, however many loads it came in."""
    return dest.groupBy("dest_name").agg(F.count(F.lit(1)).alias("count"))


def counts_in(dest: DataFrame, areas: DataFrame, area_id: str, cell: float) -> DataFrame:
    """``area_id, dest_name, count`` of destinations inside areas (half-open, so each in one of adjoining areas)."""
    inside = points_in_areas(dest.select("dest_name", "x", "y"), areas, cell)
    return inside.groupBy(F.col(f"b_{area_id}").alias(area_id), F.col("a_dest_name").alias("dest_name")).agg(F.count(F.lit(1)).alias("count"))


def counts_near(dest: DataFrame, region: DataFrame, d: float, cell: float) -> DataFrame:
    """``dest_name, from_osm, count`` of destinations at most ``d`` from a region's boxes, each once; own points have no ``osm_id``."""
    rows = with_point_box(dest.select("dest_name", F.col("osm_id").isNotNull().alias("from_osm"), "x", "y").withColumn("_row", F.monotonically_increasing_id()))
    near = within_distance(rows, region.select(*BOX), d, cell).dropDuplicates(["a__row"])
    return near.groupBy(F.col("a_dest_name").alias("dest_name"), F.col("a_from_osm").alias("from_osm")).agg(F.count(F.lit(1)).alias("count"))


def dest_pivot(dest: DataFrame, by: str, names: list[str]) -> DataFrame:
    """A column of counts per destination name (null where there is none)."""
    return dest.groupBy(by).pivot("dest_name", names).agg(F.count(F.lit(1)))


def per_area_and_people(counts: DataFrame, area_sqkm: Column, people: Column) -> DataFrame:
    """Counts per square kilometre, and that per 10,000 people."""
    density = F.try_divide(F.col("count").cast("double"), area_sqkm)
    return counts.withColumns({"count_per_sqkm": density, "count_per_sqkm_per_10k_pop": F.try_divide(density, people / 10000.0)})


# -- sample points ------------------------------------------------------------


def with_ids(df: DataFrame, order: list[str], out: str, partitions: int | None = None, start: int = 1) -> DataFrame:
    """Consecutive ids in an order, without sorting in one task.

    Rows are range-partitioned and numbered in each partition; only partition
    counts are added up. The numbered rows are written, so the ids stay.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    dealt = checkpointed(dealt.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id()))
    counts = {r._p: r.n for r in dealt.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per partition
    offsets, total = [], start
    for p in sorted(counts):
        offsets += [F.lit(p), F.lit(total)]
        total += counts[p]
    first = F.create_map(*offsets)[F.col("_p")] if offsets else F.lit(start)
    return dealt.withColumn(out, (first + F.col("_i") - F.shiftleft(F.col("_p").cast("bigint"), 33)).cast("bigint")).drop("_p", "_i")


def append_ids(first: DataFrame, second: DataFrame, order: list[str], out: str) -> DataFrame:
    """Rows of ``second`` numbered on from the largest id of ``first``."""
    top = first.agg(F.coalesce(F.max(out), F.lit(0))).first()[0]
    return first.unionByName(with_ids(second, order, out, start=top + 1))


def sample_along(edges: DataFrame, step: int = 30) -> DataFrame:
    """Points every ``step`` metres along straight edges, from 0 to the rounded length."""
    line = F.sqrt((F.col("ux") - F.col("vx")) ** 2 + (F.col("uy") - F.col("vy")) ** 2)
    rows = edges.withColumn("_len", line).withColumn("metres", F.explode(F.sequence(F.lit(0), F.rint("_len").cast("int"), F.lit(step))))
    part = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col("metres").cast("double"), F.col("_len")), F.lit(0.0)))
    place = {"x": F.col("ux") + (F.col("vx") - F.col("ux")) * part, "y": F.col("uy") + (F.col("vy") - F.col("uy")) * part}
    offsets = {"n1_distance": F.rint(part * F.col("_len")).cast("int"), "n2_distance": F.rint(F.greatest(F.lit(0.0), (1 - part) * F.col("_len"))).cast("int")}
    return rows.withColumns(place | offsets).select(F.col("ogc_fid").alias("edge_ogc_fid"), "metres", F.col("u").alias("n1"), F.col("v").alias("n2"), "n1_distance", "n2_distance", "x", "y")


def dedupe_places(points: DataFrame, order: list[str], places: int = 6) -> DataFrame:
    """One point per place, the first in order."""
    return points.groupBy(F.round("x", places).alias("_x"), F.round("y", places).alias("_y")).agg(F.min_by(F.struct(*points.columns), F.struct(*order)).alias("p")).select("p.*")


# -- open space ---------------------------------------------------------------

# Tag values of the open-space rules; all are parameters.
OPEN_LANDUSE = ("common", "conservation", "forest", "garden", "leisure", "park", "recreation_ground", "sport", "trees", "village_green", "winter_sports", "wood", "dog_park", "nature_reserve", "off_leash", "sports_centre", "riverbank", "beach")
EXCLUDED_KEYS = ("military", "agricultural", "forestry")
EXCLUDED_VALUES = {"access": ("employee", "no", "private", "privates", "staff"), "landuse": ("military", "industrial")}
WATER = ("atoll", "awash_rock", "bay", "coastal", "coastline", "coastline_old", "glacier", "high-water", "hot_spring", "island", "islet", "lake", "marsh", "oasis", "old_coastline_import", "peninsula", "pond", "river", "river_terrace", "riverbank", "riverbed", "shoal", "spring", "strait", "stream", "swamp", "swimming_pool", "underwater_rock", "unprotected_spring", "unprotected_well", "water", "water_park", "waterfall", "waterhole", "waterway", "wetland")
LINEAR = ("river", "riverbank", "riverbed", "strait", "waterway", "stream", "ditch", "river", "drain", "canal", "rapids", "drystream", "brook", "derelict_canal", "fairway")
WATER_SPORTS = ("swimming", "surfing", "canoe", "scuba_diving", "rowing", "sailing", "fishing", "water_ski", "water_sports", "diving", "windsurfing", "canoeing", "kayak")
OPEN_BOUNDARY = ("national_park", "nature_reserve", "forest", "state_forest", "state_park", "regional_park", "park", "county_park")
OPEN_VALUES = {"place": ("square",), "highway": ("pedestrian",)}
NOT_PUBLIC = {
    "amenity": ("aged_care", "animal_boarding", "allotments", "bank", "bar", "biergarten", "boatyard", "carpark", "childcare", "casino", "church", "club", "club_house", "college", "conference_centre", "embassy", "fast_food", "garden_centre", "grave_yard", "hospital", "gym", "kindergarten", "monastery", "motel", "nursing_home", "parking", "parking_space", "prison", "retirement", "retirement_home", "retirement_village", "school", "scout_hut", "university"),
    "leisure": ("garden", "golf_course", "horse_riding", "pitch", "racetrack", "summer_camp", "sports_club", "stadium", "sports_centre"),
    "building": ("yes",),
    "area": ("school",),
    "natural_tag": ("fell", "bay", "bog", "cliff", "geyser", "reef", "scrub", "sinkhole", "strait", "volcano", "wetland", "wood", "water"),
    "recreation_ground": ("showground", "school_playing_field", "horse_racing", "show_grounds", "school_playing_fields"),
    "sport": ("archery", "badminton", "bocce", "boules", "bowls", "croquet", "dog_racing", "equestrian", "futsal", "gokarts", "golf", "greyhound_racing", "horse_racing", "karting", "lacross", "lacrosse", "lawn_bowls", "motocross", "motor", "motorcycle", "polo", "shooting", "snooker", "trugo"),
    "access": ("customers", "private", "no"),
    "tourism": ("alpine_hut", "apartment", "aquarium", "bed_and_breakfast", "caravan_site", "chalet", "gallery", "guest_house", "hostel", "hotel", "information", "motel", "museum", "theme_park", "zoo"),
    "garden:type": ("residential", "residental", "private", "commercial", "pub", "school", "roof_garden"),
}


def ensure_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Adds absent tag columns as nulls."""
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})


def _among(df: DataFrame, values: dict[str, tuple[str, ...]]) -> Column:
    hits = [F.coalesce(F.col(f"`{k}`").isin(*v), F.lit(False)) for k, v in values.items() if k in df.columns]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


#: Keys and values by key of candidates.
OPEN_KEYS = ("leisure", "beach")
OPEN_TAGS = {"landuse": OPEN_LANDUSE, "boundary": OPEN_BOUNDARY, **OPEN_VALUES}


def _tagged(features: DataFrame, keys: tuple[str, ...], values: dict[str, tuple[str, ...]]) -> Column:
    """Whether a feature has any of the keys, or one of the values of a key."""
    keyed = [F.col(k).isNotNull() for k in keys if k in features.columns]
    return reduce(lambda a, b: a | b, keyed, F.lit(False)) | _among(features, values)


def exclusions(features: DataFrame, keys: tuple[str, ...] = EXCLUDED_KEYS, values: dict[str, tuple[str, ...]] = EXCLUDED_VALUES) -> DataFrame:
    """Features that rule open space out."""
    return features.where(_tagged(features, keys, values))


def candidates(features: DataFrame, keys: tuple[str, ...] = OPEN_KEYS, values: dict[str, tuple[str, ...]] = OPEN_TAGS) -> DataFrame:
    """Features that may be open space."""
    return features.where(_tagged(features, keys, values))


def cut_exclusions(spaces: DataFrame, excluded: DataFrame, key: str, cell: float) -> DataFrame:
    """Open spaces with ``area_ha`` left after exclusions, none left dropping out.

    Places under several exclusions count once. A space drops out only where
    the exclusions together cover it wholly.
    """
    covered = union_areas(clipped_boxes(spaces, excluded, key, cell), [key], cell).withColumnRenamed("area", "_covered")
    own = ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).cast("double")
    left = own - F.coalesce("_covered", F.lit(0.0))
    # Sums over tiles leave rounding errors where cover is whole.
    return spaces.join(covered, key, "left").where(left > own * 1e-12).withColumn("area_ha", left / 10000.0).drop("_covered")


def water_linear(df: DataFrame, water_values: tuple[str, ...] = WATER, sports: tuple[str, ...] = WATER_SPORTS, linear: tuple[str, ...] = LINEAR) -> DataFrame:
    """``water_feature`` (true or false), ``linear_tag`` (null unless true) and ``linear_feature``."""
    water = _among(df, {"natural_tag": water_values, "landuse": water_values, "leisure": water_values, "sport": sports})
    keyed = [F.col(k).isNotNull() for k in ("beach", "river", "water", "waterway", "wetland") if k in df.columns]
    tag = _among(df, {"waterway": linear, "natural_tag": linear, "landuse": linear, "leisure": linear})
    flowing = [F.col(k).isNotNull() for k in ("waterway", "river") if k in df.columns]
    shape = (F.col("area_ha") > 0.5) & (F.col("roundness") < 0.25)
    return df.withColumns({
        "water_feature": reduce(lambda a, b: a | b, keyed, water),
        "linear_tag": F.when(tag, True),
        "linear_feature": F.coalesce(reduce(lambda a, b: a | b, flowing, shape), F.lit(False)),
    })


def acceptable_linear(df: DataFrame, key: str, cell: float) -> DataFrame:
    """``acceptable_linear_feature`` of linear spaces (null for others): inside a
    non-linear one; or under 800 m across and a fifth inside one, or sharing over
    50 m of border with one of higher id; or under 800 m and over 0.4 ha shared with another."""
    a, b = ({c: F.col(f"{s}_{c}") for c in BOX} for s in "ab")
    slim = df.select(key, *BOX, "linear_feature", "diameter")
    pairs = box_join(slim.where("linear_feature"), slim, cell).where(F.col(f"a_{key}") != F.col(f"b_{key}"))
    shared, own = box_overlap_area(a, b), (a["xmax"] - a["xmin"]) * (a["ymax"] - a["ymin"])
    within = (a["xmin"] >= b["xmin"]) & (a["xmax"] <= b["xmax"]) & (a["ymin"] >= b["ymin"]) & (a["ymax"] <= b["ymax"])
    short = F.col("a_diameter") < 800
    touching = (box_shared_border(a, b) > 50) & (F.col(f"a_{key}") < F.col(f"b_{key}"))
    related = ~F.col("b_linear_feature") & (within | (short & ((F.try_divide(shared.cast("double"), own.cast("double")) > 0.2) | touching)))
    good = pairs.groupBy(F.col(f"a_{key}").alias(key)).agg(F.bool_or(related | (short & (shared / 10000.0 > 0.4))).alias("_good"))
    return df.join(good, key, "left").withColumn("acceptable_linear_feature", F.when(F.col("linear_feature"), F.coalesce("_good", F.lit(False)))).drop("_good")


def public_access(df: DataFrame, key: str, cell: float, cover: DataFrame | None = None, not_public: dict[str, tuple[str, ...]] = NOT_PUBLIC) -> DataFrame:
    """``public_access`` and ``within_public`` of open spaces with ``water_feature``.

    ``cover`` has the pairs ``inner, outer`` of covered spaces; without it boxes tell.

    Tags decide first. A space covered by a public one is within public. Public
    spaces covered by a non-public one lose access; so do those covered by, or
    the same as, one that is itself neither public nor within public.
    """
    golf = F.col("golf").isNull() if "golf" in df.columns else F.lit(True)
    tagged = checkpointed(df.withColumn("public_access", ~_among(df, not_public) & golf & ~F.col("water_feature")))
    cover = checkpointed(covered_by_other(tagged.select(key, *BOX), key, cell) if cover is None else cover)
    state = tagged.select(key, "public_access")
    outer = lambda table, *flags: table.select(F.col(key).alias("outer"), *[F.col(f).alias(f"_{f}") for f in flags])
    inside = cover.join(outer(state.where("public_access"), "public_access"), "outer").select(F.col("inner").alias(key)).distinct().withColumn("within_public", F.lit(True))
    flagged = tagged.join(inside, key, "left").withColumn("within_public", F.coalesce("within_public", F.lit(False)))

    def demoted(table: DataFrame, blockers: DataFrame) -> DataFrame:
        hit = cover.join(outer(blockers, "public_access"), "outer").select(F.col("inner").alias(key)).distinct().withColumn("_hit", F.lit(True))
        return table.join(hit, key, "left").withColumn("public_access", F.col("public_access") & F.col("_hit").isNull()).drop("_hit")

    once = checkpointed(demoted(flagged, flagged.where("NOT public_access")))
    return demoted(once, once.where("NOT public_access AND NOT within_public"))


def open_space_clusters(df: DataFrame, key: str, cell: float, gap: float = 0.001) -> DataFrame:
    """Adjacent open spaces as areas: ``aos_id, aos_class, members, aos_ha, aos_ha_public, aos_ha_water, water_percent``.

    Class 1 (public, or inside public; not linear) and class 2 (not public) are
    clustered; class 3 (public linear) and 4 (waterways) stay single. An area is
    that of the union of its members' boxes, summed over tiles.
    """
    linear_ok = ~F.col("linear_feature") | F.coalesce("acceptable_linear_feature", F.lit(False))
    kind = (
        F.when(F.coalesce("linear_tag", F.lit(False)), 4)
        .when((F.col("public_access") | F.col("within_public")) & linear_ok, 1)
        .when(~F.col("public_access") & ~F.col("within_public"), 2)
        .when(F.col("public_access"), 3)
    )
    classed = checkpointed(df.withColumn("aos_class", kind).where("aos_class IS NOT NULL"))
    slim = classed.where("aos_class <= 2").select(key, *BOX, "aos_class")
    near = within_distance(slim, slim, gap, cell).where((F.col(f"a_{key}") < F.col(f"b_{key}")) & (F.col("a_aos_class") == F.col("b_aos_class")))
    label = components_by_place(near.select(F.col(f"a_{key}").alias("a"), F.col(f"b_{key}").alias("b"), *block_of(cell)), ["_bx", "_by"])
    member = checkpointed(classed.join(label.select(F.col("node").alias(key), "component"), key, "left").withColumn("aos_id", F.coalesce("component", key)).drop("component"))
    sums = member.groupBy("aos_id").agg(F.min("aos_class").alias("aos_class"), F.count(F.lit(1)).alias("members"))
    parts = F.array(F.lit("aos_ha"), F.when(F.col("public_access"), "aos_ha_public"), F.when(F.col("water_feature"), "aos_ha_water"))
    boxes = member.select("aos_id", F.explode(F.filter(parts, lambda p: p.isNotNull())).alias("part"), *BOX)
    areas = union_areas(boxes, ["aos_id", "part"], cell).groupBy("aos_id").agg(*[F.coalesce(F.sum(F.when(F.col("part") == c, F.col("area") / 10000.0)), F.lit(0.0)).alias(c) for c in ("aos_ha", "aos_ha_public", "aos_ha_water")])
    out = sums.join(areas, "aos_id").select("aos_id", "aos_class", "members", "aos_ha", "aos_ha_public", "aos_ha_water")
    return out.withColumn("water_percent", F.coalesce(F.try_divide(100 * F.col("aos_ha_water"), F.col("aos_ha")), F.lit(0.0)))


def perimeter_nodes(areas: DataFrame, key: str, step: float = 20.0) -> DataFrame:
    """Numbered points every ``step`` metres around rectangles, from the lower left corner: ``key, node, x, y``."""
    w, h = (F.col("xmax") - F.col("xmin")).cast("double"), (F.col("ymax") - F.col("ymin")).cast("double")
    rows = areas.select(key, *BOX, F.posexplode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(2 * (w + h) / step).cast("int") - 1))))
    m = F.col("col") * step
    x = F.when(m <= w, F.col("xmin") + m).when(m <= w + h, F.col("xmax")).when(m <= 2 * w + h, F.col("xmax") - (m - w - h)).otherwise(F.col("xmin"))
    y = F.when(m <= w, F.col("ymin")).when(m <= w + h, F.col("ymin") + (m - w)).when(m <= 2 * w + h, F.col("ymax")).otherwise(F.col("ymax") - (m - 2 * w - h))
    return rows.select(key, (F.col("pos") + 1).alias("node"), x.cast("double").alias("x"), y.cast("double").alias("y"))


def near_network(nodes: DataFrame, edges: DataFrame, key: str, d: float = 30.0) -> DataFrame:
    """Access points at most ``d`` from the network (edges with a ``line``)."""
    pairs = box_join(with_point_box(nodes), with_line_box(edges.select("line")), 100.0, margin=d)
    near = F.round(nearest_place(F.col("b_line"), F.col("a_x"), F.col("a_y"))["distance"], 9) <= d
    hits = pairs.where(near).select(F.col(f"a_{key}").alias(key), F.col("a_node").alias("node"))
    return nodes.join(hits, [key, "node"], "left_semi")
