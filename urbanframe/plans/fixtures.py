"""Derived input views, as plain SQL that Spark and DuckDB read alike.

The library's inputs (network, grid, places, timetable, policy, pixels) are
derived from the given tables, so every query's work grows with them. The plane
grows with the tables: more places lie farther north, none denser.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanframe.session import shuffled

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS = {
    "f_nodes": r"""
SELECT c_custkey AS osmid, (c_custkey % 40) * 100 + (c_custkey * 37) % 41 AS x,
 CAST(FLOOR(c_custkey / 40) AS BIGINT) * 100 + (c_custkey * 53) % 43 AS y FROM customer
""",
    "f_edges": r"""
SELECT a.osmid * 2 + CASE WHEN b.osmid = a.osmid + 1 THEN 0 ELSE 1 END AS ogc_fid, a.osmid AS u, b.osmid AS v,
 CAST(0 AS INT) AS edge_key, ABS(a.x - b.x) + ABS(a.y - b.y) AS length, a.x AS ux, a.y AS uy, b.x AS vx, b.y AS vy
 FROM f_nodes a JOIN f_nodes b ON (b.osmid = a.osmid + 1 AND a.osmid % 40 < 39) OR b.osmid = a.osmid + 40
""",
    "f_grid": r"""
SELECT gy * 1000 + gx AS grid_id, gx * 250 AS xmin, gy * 250 AS ymin, gx * 250 + 250 AS xmax, gy * 250 + 250 AS ymax,
 CAST(SUM(1 + osmid % 97) AS BIGINT) AS pop_est FROM (SELECT osmid, CAST(FLOOR(x / 250) AS BIGINT) AS gx, CAST(FLOOR(y / 250) AS BIGINT) AS gy FROM f_nodes) n GROUP BY gx, gy
""",
    "f_destinations": r"""
SELECT s_suppkey AS dest_oid, CASE s_nationkey % 3 WHEN 0 THEN 'fresh_food_market' WHEN 1 THEN 'convenience' ELSE 'pt_any' END AS dest_name,
 (s_suppkey * 7919) % 4000 AS x, (s_suppkey * 10473) % 3700 + CAST(FLOOR(s_suppkey / 101) AS BIGINT) * 3750 AS y FROM supplier
""",
    "f_osm": r"""
SELECT p_partkey AS osm_id, CASE p_size % 6 WHEN 0 THEN 'supermarket' WHEN 1 THEN 'bakery' WHEN 2 THEN 'convenience' WHEN 3 THEN 'kiosk' END AS shop,
 CASE p_size % 5 WHEN 0 THEN 'fuel' WHEN 1 THEN 'marketplace' WHEN 2 THEN 'school' END AS amenity,
 CASE p_partkey % 4 WHEN 0 THEN 'park' WHEN 1 THEN 'pitch' WHEN 2 THEN 'garden' END AS leisure,
 CASE p_partkey % 9 WHEN 0 THEN 'wood' WHEN 1 THEN 'water' END AS natural_tag,
 CASE p_partkey % 13 WHEN 0 THEN 'private' WHEN 1 THEN 'no' END AS access,
 CASE p_partkey % 31 WHEN 0 THEN 'military' WHEN 1 THEN 'forest' END AS landuse,
 (p_partkey * 6151) % 3900 AS xmin, (p_partkey * 3571) % 3600 + CAST(FLOOR(p_partkey / 2001) AS BIGINT) * 3750 AS ymin,
 (p_partkey * 6151) % 3900 + 20 + p_size * 4 AS xmax, (p_partkey * 3571) % 3600 + CAST(FLOOR(p_partkey / 2001) AS BIGINT) * 3750 + 20 + (p_partkey % 50) * 4 AS ymax FROM part
""",
    "f_parks": r"""
SELECT osm_id, amenity, leisure, natural_tag, access, landuse, CASE WHEN osm_id % 37 = 0 THEN 'square' END AS place, CASE WHEN osm_id % 41 = 0 THEN 'pedestrian' END AS highway,
 CASE WHEN osm_id % 43 = 0 THEN 'national_park' END AS boundary, CASE osm_id % 23 WHEN 0 THEN 'canal' WHEN 1 THEN 'drain' WHEN 2 THEN 'dock' END AS waterway,
 CASE WHEN osm_id % 29 = 0 THEN 'hole' END AS golf, CASE osm_id % 19 WHEN 0 THEN 'canoe' WHEN 1 THEN 'archery' END AS sport,
 xmin AS x1, ymin AS y1, xmax AS x2, ymin + CAST(FLOOR((ymax - ymin) * 2 / 3) AS BIGINT) AS y2, xmin AS x3, ymax AS y3,
 xmin + CAST(FLOOR((xmax - xmin) / 3) AS BIGINT) AS x4, ymin + CAST(FLOOR((ymax - ymin) / 2) AS BIGINT) AS y4 FROM f_osm
""",
    "f_ways": r"""
SELECT osmid AS way_id, CASE osmid % 4 WHEN 0 THEN 'park' WHEN 1 THEN 'track' END AS leisure, CASE WHEN osmid % 5 = 0 THEN 'bench' END AS amenity, CASE WHEN osmid % 7 = 0 THEN 'tree_row' END AS natural_tag,
 CASE WHEN osmid % 11 = 0 THEN 'viewpoint' END AS tourism, CASE WHEN osmid % 6 = 0 THEN 'stream' END AS waterway, CASE WHEN osmid % 13 = 0 THEN 'ruins' END AS historic,
 x AS x1, y AS y1, x + 60 + osmid % 17 AS x2, y + 25 + osmid % 30 AS y2, x + 90 + osmid % 50 AS x3, y - 20 AS y3 FROM f_nodes
""",
    "f_bends": r"""
SELECT ogc_fid, u, v, ux AS x1, uy AS y1, (ux + vx) / 2 + (ogc_fid % 7) * 3 AS x2, (uy + vy) / 2 - (ogc_fid % 5) * 4 AS y2, vx AS x3, vy AS y3 FROM f_edges
""",
    "f_areas": r"""
SELECT n_nationkey AS area_id, n_name AS area_name, (n_nationkey % 5) * 800 + 37 AS xmin, CAST(FLOOR(n_nationkey / 5) AS BIGINT) * 740 + 53 AS ymin,
 (n_nationkey % 5) * 800 + 37 + 760 AS xmax, CAST(FLOOR(n_nationkey / 5) AS BIGINT) * 740 + 53 + 700 AS ymax, 100 + n_nationkey * 13 AS dwellings FROM nation
""",
    "f_stops": r"""
SELECT s_suppkey AS stop_id, s_name AS stop_name, -15.6E0 + ((s_suppkey * 7919) % 400) / 1E3 AS stop_lon, 27.9E0 + ((s_suppkey * 10473) % 400) / 1E3 AS stop_lat FROM supplier
""",
    "f_routes": r"""
SELECT n_nationkey AS route_id, n_regionkey AS agency_id, CASE n_nationkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 3 END AS route_type FROM nation
""",
    "f_trips": r"""
SELECT o_orderkey AS trip_id, o_custkey % 25 AS route_id, o_custkey % 5 AS service_id,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 2 END AS direction_id FROM orders
""",
    "f_stop_times": r"""
SELECT trip_id, stop_sequence, stop_id, CASE WHEN stop_sequence % 3 = 2 THEN NULL ELSE
 LPAD(CAST(CAST(FLOOR(sec / 3600) AS BIGINT) AS STRING), 2, '0') || ':' || LPAD(CAST(CAST(FLOOR(sec / 60) AS BIGINT) % 60 AS STRING), 2, '0') || ':' || LPAD(CAST(sec % 60 AS STRING), 2, '0') END AS departure_time
 FROM (SELECT l_orderkey AS trip_id, l_linenumber AS stop_sequence, MIN(l_suppkey) AS stop_id, 18000 + (l_orderkey * 613) % 72000 + l_linenumber * 120 AS sec FROM lineitem GROUP BY l_orderkey, l_linenumber) t
""",
    "f_calendar": r"""
SELECT CAST(r_regionkey AS BIGINT) AS service_id, CASE WHEN r_regionkey <> 4 THEN 1 ELSE 0 END AS weekdays, CASE WHEN r_regionkey IN (3, 4) THEN 1 ELSE 0 END AS weekend,
 DATE '2024-01-01' AS start_date, CASE WHEN r_regionkey = 2 THEN DATE '2024-01-20' ELSE DATE '2024-02-29' END AS end_date FROM region
""",
    "f_calendar_dates": r"""
SELECT user_id % 5 AS service_id, CAST(ts AS DATE) AS date, CASE WHEN COUNT(*) % 2 = 0 THEN 1 ELSE 2 END AS exception_type FROM events WHERE event_type = 'error' GROUP BY user_id % 5, CAST(ts AS DATE)
""",
    "f_frequencies": r"""
SELECT DISTINCT o_orderkey AS trip_id, '06:00:00' AS start_time, CASE o_orderkey % 2 WHEN 0 THEN '09:59:00' ELSE '23:00:00' END AS end_time, 600 + (o_orderkey % 4) * 300 AS headway_secs FROM orders WHERE o_orderpriority = '1-URGENT'
""",
    "f_policy": r"""
SELECT p_partkey AS row_id, p_type AS indicators, p_brand AS measures, CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 3 = 1 THEN 'No' END AS policy,
 CASE WHEN p_size % 3 = 0 THEN 'No' WHEN p_size % 3 = 1 THEN 'Yes' ELSE '' END AS qualifier, CASE p_size % 4 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'Unclear' END AS measurable_target,
 CASE p_size % 5 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' END AS evidence_threshold FROM part
""",
    "f_pixels": r"""
SELECT event_id AS obs_id, user_id AS pixel_id, ts, CAST(FLOOR(value * 100) AS BIGINT) % 10000 AS b4, CAST(FLOOR(value * 173) AS BIGINT) % 10000 AS b8,
 CAST(FLOOR(value * 97) AS BIGINT) % 10000 AS b11, CASE event_type WHEN 'error' THEN 1024 WHEN 'signup' THEN 2048 ELSE 0 END AS qa60 FROM events
""",
    "f_points": r"""
SELECT osmid AS point_id, CAST(FLOOR(y / 250) AS BIGINT) * 1000 + CAST(FLOOR(x / 250) AS BIGINT) AS grid_id, x, y,
 CASE WHEN osmid % 7 <> 0 THEN (osmid * 37) % 1000 END AS d_food, CASE WHEN osmid % 5 <> 0 THEN (osmid * 91) % 1200 END AS d_conv,
 (osmid * 53) % 900 AS d_pt_osm, CASE WHEN osmid % 3 <> 0 THEN (osmid * 29) % 1500 END AS d_pt_gtfs, CAST(NULL AS BIGINT) AS d_none,
 500 + (osmid * 17) % 9000 AS pop_density, CASE WHEN osmid % 11 <> 0 THEN 20 + (osmid * 13) % 150 END AS int_density FROM f_nodes
""",
}


def names_in(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b{n}\b", sql)]


def needed(sql: str) -> list[str]:
    """Views that a statement reads, directly or through others, in definition order."""
    found, todo = set(), names_in(sql, VIEWS)
    while todo:
        name = todo.pop()
        if name not in found:
            found.add(name)
            todo += names_in(VIEWS[name], VIEWS)
    return [n for n in VIEWS if n in found]


def with_views(sql: str) -> str:
    """A statement with the views it reads as leading CTEs."""
    head = [f"{n} AS ({VIEWS[n].strip()})" for n in needed(sql)]
    body = sql.strip()
    recursive = "RECURSIVE " if re.match(r"(?i)WITH\s+RECURSIVE\b", body) else ""
    if (m := re.match(r"(?i)WITH\s+(RECURSIVE\s+)?", body)) is not None:
        return f"WITH {recursive}{', '.join([*head, body[m.end():]])}"
    return f"WITH {', '.join(head)} {body}" if head else body


def _edges(nodes: DataFrame) -> DataFrame:
    """``f_edges`` as two equi joins instead of one join on alternatives."""
    far = nodes.select(F.col("osmid").alias("v"), F.col("x").alias("vx"), F.col("y").alias("vy"))
    near = nodes.select(F.col("osmid").alias("u"), F.col("x").alias("ux"), F.col("y").alias("uy"))
    # Both sides are shuffled: file sizes tell little of them, and nodes grow with the tables.
    parts = [
        near.where("u % 40 < 39").withColumn("v", F.col("u") + 1).join(shuffled(far), "v").withColumn("ogc_fid", F.col("u") * 2),
        near.withColumn("v", F.col("u") + 40).join(shuffled(far), "v").withColumn("ogc_fid", F.col("u") * 2 + 1),
    ]
    both = parts[0].unionByName(parts[1])
    length = F.abs(F.col("ux") - F.col("vx")) + F.abs(F.col("uy") - F.col("vy"))
    return both.select("ogc_fid", "u", "v", F.lit(0).alias("edge_key"), length.alias("length"), "ux", "uy", "vx", "vy")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived view over the tables in ``sf_dir``."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name == "f_edges":
        return _edges(view(spark, sf_dir, "f_nodes"))
    sql = VIEWS[name]
    frames = {n: view(spark, sf_dir, n) for n in names_in(sql, [*TABLES, *VIEWS]) if n != name}
    if name == "f_stop_times":
        # A trip's rows meet once, for all that goes by trip: grouping, windows and joins.
        frames["lineitem"] = frames["lineitem"].select("l_orderkey", "l_linenumber", "l_suppkey").repartition("l_orderkey")
    for n in frames:
        sql = re.sub(rf"\b(FROM|JOIN) {n}\b(?! AS)", rf"\1 {{{n}}}", sql)
    return spark.sql(sql.replace("'{", "'{{"), **frames)


def union_area_sql(boxes: str, keys: str, where: str) -> str:
    """``union_area``: area of the union of each key's boxes, strip by strip between neighbouring x edges."""
    return f"""edges_x AS (SELECT DISTINCT {keys}, UNNEST([xmin, xmax]) AS x FROM {boxes} WHERE {where}),
strips AS (SELECT *, LEAD(x) OVER (PARTITION BY {keys} ORDER BY x) AS x_next FROM edges_x),
parts_in AS (SELECT {keys}, x, x_next, ymin, ymax, MAX(ymax) OVER (PARTITION BY {keys}, x ORDER BY ymin, ymax ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
  FROM strips JOIN {boxes} USING ({keys}) WHERE xmin <= x AND xmax >= x_next AND xmin < xmax),
union_area AS (SELECT {keys}, SUM((x_next - x) * GREATEST(0, ymax - GREATEST(ymin, COALESCE(reach, ymin))))::DOUBLE AS area FROM parts_in GROUP BY {keys})"""


def shape_union_sql(edges: str, out: str) -> str:
    """``out``: area of the union of each ``k``'s shapes ``id``, given by their ``edges`` (``ax, ay, bx, by_``).

    Between neighbouring heights of corners and crossings the edges don't cross, so the
    width at mid height, each place counted once, times the height is exact.
    """
    cross = "(a.bx - a.ax) * (b.by_ - b.ay) - (a.by_ - a.ay) * (b.bx - b.ax)"
    along = "((b.ax - a.ax) * (b.by_ - b.ay) - (b.ay - a.ay) * (b.bx - b.ax))"
    over = "((b.ax - a.ax) * (a.by_ - a.ay) - (b.ay - a.ay) * (a.bx - a.ax))"
    return f"""{out}_ys AS (SELECT DISTINCT k, y FROM (SELECT k, ay::DOUBLE AS y FROM {edges} UNION ALL
  SELECT a.k, a.ay + (a.by_ - a.ay) * {along}::DOUBLE / ({cross}) FROM {edges} a JOIN {edges} b ON a.k = b.k AND a.id < b.id AND GREATEST(a.ay, a.by_) > LEAST(b.ay, b.by_) AND GREATEST(b.ay, b.by_) > LEAST(a.ay, a.by_)
    AND GREATEST(a.ax, a.bx) > LEAST(b.ax, b.bx) AND GREATEST(b.ax, b.bx) > LEAST(a.ax, a.bx) WHERE {cross} <> 0 AND {along}::DOUBLE / NULLIF({cross}, 0) BETWEEN 0 AND 1 AND {over}::DOUBLE / NULLIF({cross}, 0) BETWEEN 0 AND 1)),
{out}_strips AS (SELECT k, y, LEAD(y) OVER (PARTITION BY k ORDER BY y) AS y_next FROM {out}_ys),
{out}_xs AS (SELECT e.k, s.y, s.y_next - s.y AS h, e.id, e.ax + (e.bx - e.ax) * ((s.y + s.y_next) / 2 - e.ay)::DOUBLE / (e.by_ - e.ay) AS x FROM {edges} e JOIN {out}_strips s ON s.k = e.k AND LEAST(e.ay, e.by_) <= s.y AND GREATEST(e.ay, e.by_) >= s.y_next AND s.y_next > s.y WHERE e.ay <> e.by_),
{out}_ends AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY k, y, id ORDER BY x) AS n, LEAD(x) OVER (PARTITION BY k, y, id ORDER BY x) AS x_next FROM {out}_xs),
{out}_spans AS (SELECT k, y, h, x, x_next, MAX(x_next) OVER (PARTITION BY k, y ORDER BY x, x_next ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {out}_ends WHERE n % 2 = 1),
{out} AS (SELECT k, SUM(h * GREATEST(0, x_next - GREATEST(x, COALESCE(reach, x)))) AS area FROM {out}_spans GROUP BY k)"""
