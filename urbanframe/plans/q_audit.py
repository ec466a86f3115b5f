"""Policy and pixel queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from urbanframe.operators import pixels as px
from urbanframe.operators import policy as po
from urbanframe.operators.indicators import ffill
from urbanframe.plans.fixtures import union_area_sql, view, with_views


def _policy(s, d):
    return view(s, d, "f_policy")


def policy_flags(s, d):
    return po.policy_flags(_policy(s, d), "indicators")


def policy_scores(s, d):
    return po.policy_scores(_policy(s, d).withColumn("measures", F.col("indicators")), unscored="PROMO BRUSHED TIN")


def policy_topics(s, d):
    topics = view(s, d, "part").select(F.substring("p_brand", 1, 7).alias("topic"), F.col("p_brand").alias("measures")).distinct()
    unmet = s.range(1).select(F.lit("Brand#6").alias("topic"), F.lit("Brand#60").alias("measures"))
    return po.topic_checklist(_policy(s, d), topics.unionByName(unmet))


def policy_errors(s, d):
    return po.validate_policies(_policy(s, d), strict=True)


def policy_ffill(s, d):
    return ffill(_policy(s, d), ["policy", "measurable_target"], "row_id", ["measures"]).select("row_id", "policy", "measurable_target")


def policy_summary(s, d):
    marks = po.policy_flags(_policy(s, d), "indicators").withColumn("kind", F.substring_index("indicators", " ", 1))
    return po.summarise_policy(marks, "kind", "identified")


def policy_levels(s, d):
    text = F.concat(F.lit("National: "), F.coalesce("qualifier", F.lit("")), F.lit("\nLocal: "), F.coalesce("measurable_target", F.lit("No")))
    return _policy(s, d).select("row_id", F.array_join(po.parse_levels(text, F.substring_index("measures", "#", -1)), "|").alias("levels"))


def _px(s, d):
    return view(s, d, "f_pixels")


def _ndvi(s, d):
    clear = px.mask_scale(_px(s, d), "qa60", px.CLOUD_BITS, ["b4", "b8", "b11"], 0.0001)
    return clear.withColumns({"ndvi": px.norm_diff(F.col("b8"), F.col("b4")), "ndbi": px.norm_diff(F.col("b11"), F.col("b8"))})


def px_mask(s, d):
    return _ndvi(s, d).groupBy("pixel_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("b8"), 4).alias("b8"), F.round(F.avg("ndbi"), 6).alias("ndbi"))


def px_ndvi_mean(s, d):
    return px.mean_composite(_ndvi(s, d), "ndvi", "2024-01-05", "2024-01-25").withColumn("ndvi", F.round("ndvi", 9))


def px_monthly_max(s, d):
    return px.monthly_max_mean(_monthly(s, d), "b11").withColumn("b11", F.round("b11", 6))


def _monthly(s, d):
    return _px(s, d).withColumn("ts", F.add_months(F.col("ts").cast("date"), F.col("obs_id").cast("int") % 12))


def px_hottest_third(s, d):
    return px.hottest_third(px.monthly_max_mean(_monthly(s, d), "b11"), "b11").select("start", F.round("b11", 6).alias("b11"))


def _two_years(s, d):
    """Observations moved on by up to a year, so that a late start month runs into the next one."""
    return _px(s, d).withColumn("ts", (F.col("ts").cast("timestamp_ntz") + F.make_ym_interval(months=(F.col("obs_id") % 17).cast("int"))))


def px_hottest_window(s, d):
    """Mean of each pixel over the hottest third of the year."""
    return px.in_hottest_third(_two_years(s, d), "b11", 2024).groupBy("pixel_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("b11"), 6).alias("b11"))


def _means(s, d):
    return _ndvi(s, d).groupBy("pixel_id").agg(F.avg("ndvi").alias("ndvi"), F.avg("ndbi").alias("ndbi"), F.avg("b11").alias("b11")).withColumns({"x": F.col("pixel_id") % 40 * 100, "y": F.floor(F.col("pixel_id") / 40) * 100})


def px_normalise(s, d):
    return px.normalise(px.normalise(_means(s, d), "b11", "heat"), "ndvi", "green", land=F.lit(80.0), fill=0.0).select("pixel_id", F.round("heat", 6).alias("heat"), F.round("green", 6).alias("green"))


def px_equal_weight(s, d):
    holes = _means(s, d).withColumn("ndbi", F.when(F.col("pixel_id") % 3 > 0, F.col("ndbi")))
    return px.equal_weight(holes, ["ndvi", "ndbi", "b11"], "index").select("pixel_id", F.round("index", 9).alias("index"))


def px_quintile(s, d):
    return px.quintile_class(_means(s, d), "b11", "class").select("pixel_id", "class")


def px_zonal(s, d):
    means = px.zonal_mean(_means(s, d), view(s, d, "f_areas"), "area_id", ["ndvi", "b11"], 800.0)
    return means.select("area_id", F.round("ndvi", 6).alias("ndvi"), F.round("b11", 6).alias("b11"))


def px_greenery(s, d):
    inside = px.clip_pixels(_means(s, d), view(s, d, "f_areas"), 800.0)
    return px.greenery_pct(inside, "ndvi", 0.05).crossJoin(px.has_valid(inside, "ndvi")).withColumn("greenery_pct", F.round("greenery_pct", 6))


def px_land_share(s, d):
    found = px.land_share(view(s, d, "f_grid"), view(s, d, "f_osm").where("natural_tag = 'water'"), "grid_id", 400.0)
    return found.select("grid_id", F.round("land_pct", 6).alias("land_pct"))


def px_regrid(s, d):
    return px.regrid_sum(view(s, d, "f_grid"), "pop_est", 400.0).withColumn("pop_est", F.round("pop_est", 6))


def px_age_ratio(s, d):
    bands = view(s, d, "f_grid").select("grid_id", *[(F.col("pop_est") * k % 97).alias(f"a{k}") for k in range(1, 7)])
    found = px.age_ratios(bands, ["a1", "a2"], ["a3", "a4"], ["a5", "a6"])
    return found.select("grid_id", F.round("vulnerable_pct", 6).alias("vulnerable_pct"), F.round("child_dependency", 6).alias("child_dependency"))


def px_mosaic(s, d):
    holes = _px(s, d).withColumn("b4", F.when(F.col("obs_id") % 4 > 0, F.col("b4")))
    return px.mosaic(holes, "b4", ["ts", "obs_id"])


def px_uniform_grid(s, d):
    extent = view(s, d, "f_nodes").agg(F.min("x").alias("xmin"), F.min("y").alias("ymin"), F.max("x").alias("xmax"), F.max("y").alias("ymax"))
    return px.uniform_grid(extent, 500.0)


def px_remap(s, d):
    return _px(s, d).select("obs_id", px.remap(F.col("qa60").cast("int"), {0: 3, 1024: 1}).alias("rank"), px.invert(F.col("b4"), 10000.0).alias("inverse"), F.round(px.albedo(*[F.col("b8") * k / 10000.0 for k in range(1, 6)]), 9).alias("albedo"))


GIVEN = "({c} IS NOT NULL AND {c} NOT IN ('No', '', 'nan', 'NaN'{more}))"


def _given(c: str, more: str = "") -> str:
    return GIVEN.format(c=c, more=more)


def _flags(by: str, source: str = "f_policy") -> str:
    named, against, weak = _given("policy"), "COALESCE(qualifier = 'No', FALSE)", "COALESCE(evidence_threshold = 'No', FALSE)"
    return f"""told AS (SELECT {by}, BOOL_OR({named}) AS n, BOOL_OR({named} AND NOT {against}) AS a, BOOL_OR({named} AND ({against} OR {weak})) AS x, BOOL_OR({named} AND {_given('measurable_target', ", 'Unclear'")}) AS m,
    BOOL_OR({named} AND {_given('evidence_threshold')}) AS e, BOOL_OR({named} AND NOT {_given('evidence_threshold')}) AS ne FROM {source} GROUP BY {by}),
flags AS (SELECT {by}, CASE WHEN n THEN '✔' ELSE '✘' END AS identified, CASE WHEN a AND x THEN '✔/✘' WHEN a THEN '✔' WHEN n THEN '✘' ELSE '-' END AS aligns, CASE WHEN m THEN '✔' WHEN n THEN '✘' ELSE '-' END AS measurable,
    CASE WHEN e AND ne THEN '✔+✘' WHEN e THEN '✔' WHEN n THEN '✘' ELSE '-' END AS evidence FROM told)"""


CLEAR = "clear AS (SELECT pixel_id, ts, b4 * 0.0001::DOUBLE AS b4, b8 * 0.0001::DOUBLE AS b8, b11 * 0.0001::DOUBLE AS b11 FROM f_pixels WHERE (CAST(qa60 AS BIGINT) & 3072) = 0), ndvi AS (SELECT *, (b8 - b4) / NULLIF(b8 + b4, 0) AS ndvi, (b11 - b8) / NULLIF(b11 + b8, 0) AS ndbi FROM clear)"
MEANS = f"{CLEAR}, means AS (SELECT pixel_id, AVG(ndvi) AS ndvi, AVG(ndbi) AS ndbi, AVG(b11) AS b11, pixel_id % 40 * 100 AS x, pixel_id // 40 * 100 AS y FROM ndvi GROUP BY pixel_id)"
MONTHS = "months AS (SELECT MONTH(CAST(ts AS DATE) + CAST(obs_id % 12 AS INT) * INTERVAL 1 MONTH) AS month, pixel_id, MAX(b11) AS b11 FROM f_pixels GROUP BY 1, 2), monthly AS (SELECT month, AVG(b11) AS b11 FROM months GROUP BY month)"
SQL = {
    "policy_flags": f"WITH {_flags('indicators')} SELECT * FROM flags",
    "policy_scores": f"""WITH {_flags('indicators')} SELECT COUNT(CASE WHEN identified = '✔' THEN 1 END) AS presence, COUNT(*) AS presence_of,
      COALESCE(SUM(CASE WHEN indicators <> 'PROMO BRUSHED TIN' THEN CASE aligns WHEN '✔' THEN 1.0::DOUBLE WHEN '✔/✘' THEN -0.5::DOUBLE WHEN '✘' THEN -1.0::DOUBLE END * CASE measurable WHEN '✔' THEN 2 WHEN '✘' THEN 1 ELSE 0 END END), 0) AS quality, COUNT(CASE WHEN indicators <> 'PROMO BRUSHED TIN' THEN 1 END) * 2 AS quality_of FROM flags""",
    "policy_topics": f"""WITH used AS (SELECT * FROM f_policy WHERE policy IS NOT NULL), {_flags('measures', 'used')}, topics AS (SELECT DISTINCT SUBSTR(p_brand, 1, 7) AS topic, p_brand AS measures FROM part UNION ALL SELECT 'Brand#6', 'Brand#60'),
      j AS (SELECT topic, t.measures, COALESCE(identified, '✘') AS identified, COALESCE(aligns, '-') AS aligns, COALESCE(measurable, '-') AS measurable FROM topics t LEFT JOIN flags f ON f.measures = t.measures)
      SELECT topic, measures, CASE WHEN BOOL_AND(identified = '✘') OVER (PARTITION BY topic) THEN '-' ELSE identified END AS identified, aligns, measurable FROM j""",
    "policy_errors": f"""SELECT row_id, 'unnamed' AS rule, 'details are entered without a policy name' AS message FROM f_policy WHERE NOT {_given('policy')} AND ({_given('measurable_target')} OR {_given('evidence_threshold')})
      UNION ALL SELECT row_id, 'unmeasurable', 'an evidence-informed threshold needs a measurable target' FROM f_policy WHERE evidence_threshold = 'Yes' AND NOT COALESCE(measurable_target = 'Yes', FALSE)
      UNION ALL SELECT row_id, 'no_threshold', 'a measurable target needs a threshold assessment' FROM f_policy WHERE measurable_target = 'Yes' AND evidence_threshold IS NULL""",
    "policy_ffill": "SELECT row_id, LAST_VALUE(policy IGNORE NULLS) OVER w AS policy, LAST_VALUE(measurable_target IGNORE NULLS) OVER w AS measurable_target FROM f_policy WINDOW w AS (PARTITION BY measures ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    "policy_summary": f"WITH {_flags('indicators')} SELECT SPLIT_PART(indicators, ' ', 1) AS kind, CASE WHEN BOOL_AND(identified = '✔') THEN '✔' WHEN BOOL_AND(identified = '-') THEN '-' ELSE '✘' END AS identified FROM flags GROUP BY 1",
    "policy_levels": """SELECT row_id, ARRAY_TO_STRING(LIST_FILTER([CASE WHEN LOWER(COALESCE(qualifier, '')) NOT IN ('no', '') THEN 'National' END, CASE WHEN LOWER(COALESCE(measurable_target, 'No')) NOT IN ('no', '') THEN 'Local' END, SPLIT_PART(measures, '#', 2)], LAMBDA x: x IS NOT NULL), '|') AS levels FROM f_policy""",
    "px_mask": f"WITH {CLEAR} SELECT pixel_id, COUNT(*) AS n, ROUND(SUM(b8), 4) AS b8, ROUND(AVG(ndbi), 6) AS ndbi FROM ndvi GROUP BY pixel_id",
    "px_ndvi_mean": f"WITH {CLEAR} SELECT pixel_id, ROUND(AVG(ndvi), 9) AS ndvi FROM ndvi WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-25' GROUP BY pixel_id",
    "px_monthly_max": f"WITH {MONTHS} SELECT CAST(month AS INT) AS month, ROUND(b11, 6) AS b11 FROM monthly",
    "px_hottest_third": f"WITH {MONTHS}, w AS (SELECT CAST((month - i + 11) % 12 + 1 AS INT) AS start, AVG(b11) AS b11 FROM monthly CROSS JOIN RANGE(4) r(i) GROUP BY 1) SELECT start, ROUND(b11, 6) AS b11 FROM w ORDER BY b11 DESC, start LIMIT 1",
    "px_hottest_window": """WITH moved AS (SELECT pixel_id, b11, ts::TIMESTAMP + CAST(obs_id % 17 AS INT) * INTERVAL 1 MONTH AS ts FROM f_pixels), months AS (SELECT MONTH(ts) AS month, pixel_id, MAX(b11) AS b11 FROM moved GROUP BY 1, 2), monthly AS (SELECT month, AVG(b11) AS b11 FROM months GROUP BY month),
      w AS (SELECT CAST((month - i + 11) % 12 + 1 AS INT) AS start, AVG(b11) AS b11 FROM monthly CROSS JOIN RANGE(4) r(i) GROUP BY 1), best AS (SELECT MAKE_DATE(2024, start, 1)::TIMESTAMP AS t FROM w ORDER BY b11 DESC, start LIMIT 1)
      SELECT pixel_id, COUNT(*) AS n, ROUND(AVG(b11), 6) AS b11 FROM moved, best WHERE ts >= t AND ts < t + INTERVAL 4 MONTH GROUP BY pixel_id""",
    "px_normalise": f"WITH {MEANS}, m AS (SELECT *, MIN(b11) OVER () AS lo, MAX(b11) OVER () AS hi, MIN(ndvi) OVER () AS glo, MAX(ndvi) OVER () AS ghi FROM means) SELECT pixel_id, ROUND((b11 - lo) / NULLIF(hi - lo, 0) * 100, 6) AS heat, ROUND(COALESCE((ndvi - glo) / NULLIF(ghi - glo, 0) * 80, 0), 6) AS green FROM m",
    "px_equal_weight": f"WITH {MEANS} SELECT pixel_id, ROUND((COALESCE(ndvi, 0) + COALESCE(CASE WHEN pixel_id % 3 > 0 THEN ndbi END, 0) + COALESCE(b11, 0)) / NULLIF((ndvi IS NOT NULL)::INT + (ndbi IS NOT NULL AND pixel_id % 3 > 0)::INT + (b11 IS NOT NULL)::INT, 0), 9) AS index FROM means",
    "px_quintile": f"WITH {MEANS}, q AS (SELECT QUANTILE_CONT(b11, [0.2, 0.4, 0.6, 0.8]) AS q FROM means) SELECT pixel_id, CASE WHEN b11 IS NOT NULL THEN 1 + (b11 > q[1])::INT + (b11 > q[2])::INT + (b11 > q[3])::INT + (b11 > q[4])::INT END AS class FROM means, q",
    "px_zonal": f"WITH {MEANS} SELECT a.area_id, ROUND(AVG(ndvi), 6) AS ndvi, ROUND(AVG(b11), 6) AS b11 FROM means p JOIN f_areas a ON p.x >= a.xmin AND p.x < a.xmax AND p.y >= a.ymin AND p.y < a.ymax GROUP BY 1 HAVING COUNT(ndvi) > 0 AND COUNT(b11) > 0",
    "px_greenery": f"WITH {MEANS}, i AS (SELECT * FROM means p WHERE EXISTS (SELECT 1 FROM f_areas a WHERE p.x >= a.xmin AND p.x < a.xmax AND p.y >= a.ymin AND p.y < a.ymax)) SELECT ROUND(100.0::DOUBLE * COUNT(CASE WHEN ndvi >= 0.05 THEN 1 END) / NULLIF(COUNT(ndvi), 0), 6) AS greenery_pct, COALESCE(BOOL_OR(ndvi BETWEEN -1 AND 1), FALSE) AS valid FROM i",
    "px_land_share": f"WITH clipped AS (SELECT a.grid_id, GREATEST(a.xmin, b.xmin) AS xmin, GREATEST(a.ymin, b.ymin) AS ymin, LEAST(a.xmax, b.xmax) AS xmax, LEAST(a.ymax, b.ymax) AS ymax FROM f_grid a JOIN f_osm b ON b.natural_tag = 'water' AND a.xmin <= b.xmax AND b.xmin <= a.xmax AND a.ymin <= b.ymax AND b.ymin <= a.ymax), {union_area_sql('clipped', 'grid_id', 'TRUE')} SELECT grid_id, ROUND(100 - 100.0::DOUBLE * COALESCE(area, 0) / 62500, 6) AS land_pct FROM f_grid LEFT JOIN union_area USING (grid_id)",
    "px_regrid": "WITH t AS (SELECT i AS gx, j AS gy FROM RANGE(0, 400) a(i), RANGE(0, 400) b(j)) SELECT CAST(gx AS BIGINT) AS gx, CAST(gy AS BIGINT) AS gy, ROUND(SUM(pop_est * ((LEAST(g.xmax, gx * 400 + 400) - GREATEST(g.xmin, gx * 400)) * (LEAST(g.ymax, gy * 400 + 400) - GREATEST(g.ymin, gy * 400))) / 62500.0::DOUBLE), 6) AS pop_est FROM f_grid g JOIN t ON g.xmin < gx * 400 + 400 AND g.xmax > gx * 400 AND g.ymin < gy * 400 + 400 AND g.ymax > gy * 400 GROUP BY 1, 2",
    "px_age_ratio": "WITH b AS (SELECT grid_id, " + ", ".join(f"pop_est * {k} % 97 AS a{k}" for k in range(1, 7)) + " FROM f_grid) SELECT grid_id, ROUND(100.0::DOUBLE * (a1 + a2 + a5 + a6) / NULLIF(a1 + a2 + a3 + a4 + a5 + a6, 0), 6) AS vulnerable_pct, ROUND(100.0::DOUBLE * (a1 + a2) / NULLIF(a3 + a4, 0), 6) AS child_dependency FROM b",
    "px_mosaic": "SELECT pixel_id, ARG_MAX(b4, ROW(ts, obs_id)) AS b4 FROM f_pixels WHERE obs_id % 4 > 0 AND b4 IS NOT NULL GROUP BY pixel_id",
    "px_uniform_grid": "WITH e AS (SELECT FLOOR(MIN(x) / 500)::BIGINT AS a, CEIL(MAX(x) / 500)::BIGINT AS b, FLOOR(MIN(y) / 500)::BIGINT AS c, CEIL(MAX(y) / 500)::BIGINT AS d FROM f_nodes), g AS (SELECT UNNEST(RANGE(a, b)) AS gx, c, d FROM e), h AS (SELECT gx, UNNEST(RANGE(c, d)) AS gy FROM g) SELECT gx, gy, gx * 500.0::DOUBLE AS xmin, gy * 500.0::DOUBLE AS ymin, gx * 500.0::DOUBLE + 500 AS xmax, gy * 500.0::DOUBLE + 500 AS ymax FROM h",
    "px_remap": "SELECT obs_id, CASE qa60 WHEN 0 THEN 3 WHEN 1024 THEN 1 END AS rank, 10000.0::DOUBLE - b4 AS inverse, ROUND((0.356::DOUBLE + 0.130::DOUBLE * 2 + 0.373::DOUBLE * 3 + 0.085::DOUBLE * 4 + 0.072::DOUBLE * 5) * b8 / 10000 - 0.0018::DOUBLE, 9) AS albedo FROM f_pixels",
}

QUERIES = {name: globals()[name] for name in SQL}
SQL = {name: with_views(sql) for name, sql in SQL.items()}
