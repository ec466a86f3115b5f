"""Timetable queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanframe.functions.geometry import make_point
from urbanframe.operators import timetable as t
from urbanframe.plans.fixtures import view, with_views

WINDOW = ("07:00:00", "19:00:00", "2024-01-08", "2024-02-05")


def _calendar(spark: SparkSession, d: str) -> DataFrame:
    days = {day: F.col("weekdays" if i < 5 else "weekend") for i, day in enumerate(t.DAYS)}
    return view(spark, d, "f_calendar").withColumns(days)


def _dates(spark: SparkSession, d: str) -> DataFrame:
    return t.service_dates(_calendar(spark, d), view(spark, d, "f_calendar_dates"))


def _trips(spark: SparkSession, d: str, *kinds) -> DataFrame:
    return t.mode_trips(view(spark, d, "f_trips"), view(spark, d, "f_routes"), *kinds)


def gtfs_service_dates(spark, d):
    return _dates(spark, d).withColumn("date", F.col("date").cast("string"))


def gtfs_trip_counts(spark, d):
    return t.trip_counts(_dates(spark, d), view(spark, d, "f_trips")).withColumn("date", F.col("date").cast("string"))


def gtfs_usual_week(spark, d):
    return t.usual_week(t.trip_counts(_dates(spark, d), view(spark, d, "f_trips")), share=0.45).select(F.col("start_date").cast("string"))


def gtfs_calendar_range(spark, d):
    return t.calendar_range(_calendar(spark, d)).select(F.col("start_date").cast("string"), F.col("end_date").cast("string"))


def gtfs_interpolate(spark, d):
    return t.interpolate_times(view(spark, d, "f_stop_times"))


def gtfs_stop_headway(spark, d):
    found = t.stop_headway(view(spark, d, "f_stop_times"), _trips(spark, d, [3]), _dates(spark, d), *WINDOW)
    return found.select("stop_id", F.round("headway", 6).alias("headway"))


def gtfs_frequency_headway(spark, d):
    args = (view(spark, d, "f_stop_times"), _trips(spark, d, [3]), _dates(spark, d), *WINDOW)
    found = t.prefer(t.frequency_headway(view(spark, d, "f_frequencies"), *args), t.stop_headway(*args), "stop_id")
    return found.select("stop_id", F.round("headway", 6).alias("headway"))


def gtfs_mode_stops(spark, d):
    return t.mode_stops(view(spark, d, "f_stop_times"), view(spark, d, "f_trips"), view(spark, d, "f_routes"), [3], [0, 2])


def _modes(spark, d):
    modes = {"Tram": {"route_types": [0]}, "Metro": {"route_types": [1]}, "Bus": {"route_types": [3]}}
    trips = t.trip_modes(view(spark, d, "f_trips"), view(spark, d, "f_routes"), modes)
    return t.stop_headway(view(spark, d, "f_stop_times"), trips, _dates(spark, d), *WINDOW, by=("mode",))


def gtfs_headway_summary(spark, d):
    return t.headway_summary(_modes(spark, d), "mode")


def gtfs_average_headway(spark, d):
    return t.average_headway(_modes(spark, d).withColumnRenamed("mode", "feed")).withColumn("headway", F.round("headway", 6))


def gtfs_analyse_feed(spark, d):
    feed = {k: view(spark, d, f"f_{k}") for k in ("stops", "stop_times", "trips", "routes", "calendar_dates", "frequencies")} | {"calendar": _calendar(spark, d)}
    found = t.analyse_feed(feed, {"Bus": {"route_types": [3]}, "Tram": {"route_types": [0], "agency_ids": [0, 1, 4]}}, "feed1", "agency", *WINDOW, interpolate=True)
    point = make_point(F.col("stop_lon"), F.col("stop_lat"))
    return found.withColumn("geom", point).select("stop_id", "stop_name", "mode", F.round("headway", 6).alias("headway"), "authority", "feed", F.round("geom.x", 6).alias("lon"), F.round("geom.y", 6).alias("lat"))


SERVICES = """days AS (SELECT service_id, CAST(UNNEST(GENERATE_SERIES(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS date, weekdays, weekend FROM f_calendar),
regular AS (SELECT service_id, date FROM days WHERE CASE WHEN ISODOW(date) <= 5 THEN weekdays ELSE weekend END = 1),
services AS (SELECT s.service_id, s.date, ['monday','tuesday','wednesday','thursday','friday','saturday','sunday'][ISODOW(s.date)] AS weekday
  FROM (SELECT * FROM regular UNION ALL SELECT service_id, date FROM f_calendar_dates WHERE exception_type = 1) s
  WHERE NOT EXISTS (SELECT 1 FROM f_calendar_dates x WHERE x.exception_type = 2 AND x.service_id = s.service_id AND x.date = s.date))"""
DAILY = """daily AS (SELECT s.date, CAST(COUNT(*) AS BIGINT) AS trip_counts FROM services s JOIN f_trips t USING (service_id) GROUP BY s.date)"""
CHOSEN = """chosen AS (SELECT DISTINCT service_id, date FROM services WHERE ISODOW(date) <= 5 AND date >= DATE '2024-01-08' AND date < DATE '2024-02-05')"""
TIMED = """numbered AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY trip_id ORDER BY stop_sequence) AS i,
    CAST(SPLIT_PART(departure_time, ':', 1) AS BIGINT) * 3600 + CAST(SPLIT_PART(departure_time, ':', 2) AS BIGINT) * 60 + CAST(SPLIT_PART(departure_time, ':', 3) AS BIGINT) AS s FROM f_stop_times),
marked AS (SELECT *, LAST_VALUE(s IGNORE NULLS) OVER b AS sa, LAST_VALUE(CASE WHEN s IS NOT NULL THEN i END IGNORE NULLS) OVER b AS ia,
    FIRST_VALUE(s IGNORE NULLS) OVER f AS sb, FIRST_VALUE(CASE WHEN s IS NOT NULL THEN i END IGNORE NULLS) OVER f AS ib FROM numbered
  WINDOW b AS (PARTITION BY trip_id ORDER BY stop_sequence ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), f AS (PARTITION BY trip_id ORDER BY stop_sequence ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT *, CASE WHEN s IS NOT NULL THEN s WHEN sa IS NULL THEN NULL WHEN sb IS NULL THEN sa ELSE sa + CAST(FLOOR((sb - sa) * (i - ia) / (ib - ia)) AS BIGINT) END AS t FROM marked),
timed AS (SELECT trip_id, stop_sequence, stop_id, LPAD(CAST(t // 3600 AS VARCHAR), 2, '0') || ':' || LPAD(CAST(t // 60 % 60 AS VARCHAR), 2, '0') || ':' || LPAD(CAST(t % 60 AS VARCHAR), 2, '0') AS departure_time FROM filled)"""


def _headway(name: str, types: str, times: str = "f_stop_times", extra: str = "") -> str:
    return f"""{name}_n AS (SELECT COALESCE(t.direction_id, -1) AS dir, st.stop_id, c.date, COUNT(*) AS n FROM {times} st JOIN f_trips t USING (trip_id)
    JOIN f_routes r USING (route_id) JOIN chosen c USING (service_id) WHERE r.route_type IN ({types}) {extra} AND st.departure_time >= '07:00:00' AND st.departure_time < '19:00:00' GROUP BY 1, 2, 3),
{name}_d AS (SELECT stop_id, dir, AVG(ROUND_EVEN(720.0::DOUBLE / n, 0)) AS headway FROM {name}_n GROUP BY 1, 2),
{name} AS (SELECT stop_id, MIN(headway) AS headway FROM {name}_d GROUP BY 1)"""


def _frequency(name: str, types: str, times: str = "f_stop_times", extra: str = "") -> str:
    return f"""{name}_w AS (SELECT f.trip_id, f.headway_secs, ROUND_EVEN(GREATEST(0, GREATEST(0, e - s) - GREATEST(0, 7 - s) - GREATEST(0, e - 19)), 1) AS w
    FROM (SELECT *, CAST(SUBSTR(start_time, 1, 2) AS DOUBLE) + CAST(SUBSTR(start_time, 4, 2) AS DOUBLE) / 60 + CAST(SUBSTR(start_time, 7, 2) AS DOUBLE) / 3600 AS s,
      CAST(SUBSTR(end_time, 1, 2) AS DOUBLE) + CAST(SUBSTR(end_time, 4, 2) AS DOUBLE) / 60 + CAST(SUBSTR(end_time, 7, 2) AS DOUBLE) / 3600 AS e FROM f_frequencies) f),
{name}_d AS (SELECT st.stop_id, COALESCE(t.direction_id, -1) AS dir, SUM(w.headway_secs * w.w) / SUM(w.w) AS h FROM {name}_w w JOIN f_trips t USING (trip_id) JOIN f_routes r USING (route_id)
    JOIN chosen c USING (service_id) JOIN {times} st USING (trip_id) WHERE w.w > 0 AND r.route_type IN ({types}) {extra} GROUP BY 1, 2),
{name} AS (SELECT stop_id, MIN(h) / 60 AS headway FROM {name}_d GROUP BY 1)"""


_ALL_MODES = f"WITH {SERVICES}, {CHOSEN}, {_headway('tram', '0')}, {_headway('metro', '1')}, {_headway('bus', '3')}, modes AS (SELECT stop_id, headway, 'Tram' AS mode FROM tram UNION ALL SELECT *, 'Metro' FROM metro UNION ALL SELECT *, 'Bus' FROM bus)"
_COUNTS = "COUNT(stop_id) AS tot_stops, COUNT(CASE WHEN headway <= 30 THEN 1 END) AS headway_30, COUNT(CASE WHEN headway <= 20 THEN 1 END) AS headway_20"
_TRAM_AGENCIES = "AND r.agency_id IN (0, 1, 4)"

SQL = {
    "gtfs_service_dates": f"WITH {SERVICES} SELECT service_id, CAST(date AS VARCHAR) AS date, weekday FROM services",
    "gtfs_trip_counts": f"WITH {SERVICES}, {DAILY} SELECT CAST(date AS VARCHAR) AS date, trip_counts FROM daily",
    "gtfs_usual_week": f"""WITH {SERVICES}, {DAILY}, k AS (SELECT *, ROW_NUMBER() OVER (ORDER BY date) - 1 AS i, COUNT(*) OVER () AS n,
        (SELECT 0.45::DOUBLE * QUANTILE_CONT(trip_counts, 0.95) FROM daily) AS thr, (SELECT MIN(date) + CAST(8 - ISODOW(MIN(date)) AS INT) FROM daily) AS mon FROM daily),
      b AS (SELECT *, MIN(CASE WHEN trip_counts > thr THEN 1 ELSE 0 END) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS busy, (SELECT MAX(i) FROM k WHERE date = mon) AS i0 FROM k),
      h AS (SELECT * FROM b WHERE busy = 1 AND (i - i0 + 700000) % 7 = 0 AND (i < i0 OR n >= i + 7))
      SELECT CAST(start_date AS VARCHAR) AS start_date FROM (SELECT COALESCE(MIN(CASE WHEN i < i0 THEN date END), MAX(CASE WHEN i >= i0 THEN date END)) AS start_date FROM h) WHERE start_date IS NOT NULL""",
    "gtfs_calendar_range": "SELECT CAST(MIN(start_date) AS VARCHAR) AS start_date, CAST(MAX(end_date) AS VARCHAR) AS end_date FROM f_calendar",
    "gtfs_interpolate": f"WITH {TIMED} SELECT * FROM timed",
    "gtfs_stop_headway": f"WITH {SERVICES}, {CHOSEN}, {_headway('bus', '3')} SELECT stop_id, ROUND(headway, 6) AS headway FROM bus",
    "gtfs_frequency_headway": f"WITH {SERVICES}, {CHOSEN}, {_headway('bus', '3')}, {_frequency('freq', '3')} SELECT stop_id, ROUND(headway, 6) AS headway FROM (SELECT * FROM freq UNION ALL SELECT * FROM bus WHERE stop_id NOT IN (SELECT stop_id FROM freq))",
    "gtfs_mode_stops": "SELECT DISTINCT st.stop_id FROM f_stop_times st JOIN f_trips t USING (trip_id) JOIN f_routes r USING (route_id) WHERE r.route_type = 3 AND r.agency_id IN (0, 2) AND st.stop_id IS NOT NULL",
    "gtfs_headway_summary": f"{_ALL_MODES} SELECT *, ROUND_EVEN(headway_30 * 100.0::DOUBLE / NULLIF(tot_stops, 0), 2) AS pct_headway_30, ROUND_EVEN(headway_20 * 100.0::DOUBLE / NULLIF(tot_stops, 0), 2) AS pct_headway_20 FROM (SELECT mode, {_COUNTS} FROM modes GROUP BY mode UNION ALL SELECT 'total', {_COUNTS} FROM modes)",
    "gtfs_average_headway": f"{_ALL_MODES} SELECT stop_id, ROUND(AVG(headway), 6) AS headway, STRING_AGG(DISTINCT mode, ',' ORDER BY mode) AS feeds FROM modes GROUP BY stop_id",
    "gtfs_analyse_feed": f"""WITH {SERVICES}, {CHOSEN}, {TIMED}, {_headway('bus', '3', 'timed')}, {_frequency('bf', '3', 'timed')}, {_headway('tram', '0', 'timed', _TRAM_AGENCIES)}, {_frequency('tf', '0', 'timed', _TRAM_AGENCIES)},
      found AS (SELECT *, 'Bus' AS mode FROM bf UNION ALL SELECT *, 'Bus' FROM bus WHERE stop_id NOT IN (SELECT stop_id FROM bf) UNION ALL SELECT *, 'Tram' FROM tf UNION ALL SELECT *, 'Tram' FROM tram WHERE stop_id NOT IN (SELECT stop_id FROM tf))
      SELECT s.stop_id, s.stop_name, mode, ROUND(headway, 6) AS headway, 'agency' AS authority, 'feed1' AS feed, ROUND(stop_lon, 6) AS lon, ROUND(stop_lat, 6) AS lat FROM f_stops s LEFT JOIN found USING (stop_id)""",
}

QUERIES = {name: globals()[name] for name in SQL}
SQL = {name: with_views(sql) for name, sql in SQL.items()}
