"""Timetable operators: service dates, interpolation, headways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanframe.functions.scalars import clock_of, half_even, minutes_between, overlap_hours, seconds_of

DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
WORKDAYS = DAYS[:5]


def day_name(date: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, DAYS)), F.weekday(date) + 1)


def service_dates(calendar: DataFrame, exceptions: DataFrame) -> DataFrame:
    """``service_id, date, weekday`` on which services run.

    Calendar rows give a date for every flagged weekday in their range; type 1
    exceptions add dates (in or out of range), type 2 remove them.
    """
    runs = F.element_at(F.array(*DAYS), F.weekday("date") + 1) == 1
    regular = calendar.withColumn("date", F.explode(F.sequence("start_date", "end_date"))).where(runs).select("service_id", "date")
    added = exceptions.where("exception_type = 1").select("service_id", "date")
    removed = exceptions.where("exception_type = 2").select("service_id", "date")
    dates = regular.unionByName(added).join(removed, ["service_id", "date"], "left_anti")
    return dates.withColumn("weekday", day_name(F.col("date")))


def calendar_range(calendar: DataFrame) -> DataFrame:
    """First and last date of the calendar, one row."""
    return calendar.agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))


def trip_counts(dates: DataFrame, trips: DataFrame) -> DataFrame:
    """Trips per date. Trips are counted per service before dates fan out."""
    per_service = trips.groupBy("service_id").agg(F.count(F.lit(1)).alias("n"))
    return dates.join(per_service, "service_id").groupBy("date").agg(F.sum("n").alias("trip_counts"))


def usual_week(daily: DataFrame, share: float = 0.9) -> DataFrame:
    """Monday of a representative week, one row (none if no week qualifies).

    A week qualifies if its five workdays all pass ``share`` of the 95th
    percentile. Weeks are looked at forwards from the first Monday after the
    first date, then backwards, and the last one found stands. The table has a
    row per date, so its windows are small.
    """
    order = W.partitionBy().orderBy("date")
    every = W.partitionBy()
    rows = (
        daily.withColumn("i", F.row_number().over(order) - 1)
        .withColumn("n", F.count(F.lit(1)).over(every))
        .withColumn("threshold", share * F.percentile("trip_counts", F.lit(0.95)).over(every))
        .withColumn("monday", F.date_add(F.min("date").over(every), 7 - F.weekday(F.min("date").over(every))))
        .withColumn("busy", F.min((F.col("trip_counts") > F.col("threshold")).cast("int")).over(order.rowsBetween(0, 4)))
        .withColumn("i0", F.max(F.when(F.col("date") == F.col("monday"), F.col("i"))).over(every))
    )
    hits = rows.where("busy = 1 AND pmod(i - i0, 7) = 0 AND (i < i0 OR n >= i + 7)")
    back, ahead = F.min(F.when(F.col("i") < F.col("i0"), F.struct("i", "date"))), F.max(F.when(F.col("i") >= F.col("i0"), F.struct("i", "date")))
    return hits.agg(F.coalesce(back, ahead)["date"].alias("start_date")).where("start_date IS NOT NULL")


def interpolate_times(stop_times: DataFrame) -> DataFrame:
    """Fills null departure times between known ones of a trip, in equal steps per row.

    Leading nulls stay null, trailing ones repeat the last time; seconds are cut.
    """
    trip = W.partitionBy("trip_id").orderBy("stop_sequence")
    back, ahead = trip.rowsBetween(W.unboundedPreceding, 0), trip.rowsBetween(0, W.unboundedFollowing)
    timed = stop_times.withColumn("_s", seconds_of(F.col("departure_time"))).withColumn("_i", F.row_number().over(trip))
    # Plain numbers: places are in order, so the last known one is the largest so far.
    known = F.when(F.col("_s").isNotNull(), F.col("_i"))
    timed = timed.withColumns({"_as": F.last("_s", True).over(back), "_ai": F.max(known).over(back), "_bs": F.first("_s", True).over(ahead), "_bi": F.min(known).over(ahead)})
    steps = F.floor((F.col("_bs") - F.col("_as")) * (F.col("_i") - F.col("_ai")) / F.greatest(F.lit(1), F.col("_bi") - F.col("_ai")))
    # A known time is its own neighbour; a missing one ahead adds no step, a missing one behind leaves null.
    filled = F.col("_as") + F.coalesce(steps, F.lit(0))
    return timed.withColumn("departure_time", clock_of(filled)).select(*stop_times.columns)


def check_stop_ids(stops: DataFrame) -> DataFrame:
    """Stops with text ids. One null id becomes ``'nan'``; more reject the feed."""
    nulls = stops.agg(F.count_if(F.col("stop_id").isNull())).first()[0]
    if nulls > 1:
        raise ValueError(f"{nulls} stops have no id")
    return stops.withColumn("stop_id", F.coalesce(F.col("stop_id").cast("string"), F.lit("nan"))) if nulls else stops


def prepare_stop_times(stop_times: DataFrame, stops: DataFrame, interpolate: bool) -> DataFrame:
    """Stop times of the loaded stops; null departures are interpolated or refused."""
    if interpolate:
        stop_times = interpolate_times(stop_times)
    elif stop_times.where("departure_time IS NULL").limit(1).count():
        raise ValueError("departure times are missing; ask for interpolation")
    return stop_times.join(stops.select("stop_id").distinct(), "stop_id", "left_semi")


def mode_trips(trips: DataFrame, routes: DataFrame, route_types: list[int] | None = None, agency_ids: list[int] | None = None) -> DataFrame:
    """Trips of some route types and/or agencies; a null list does not filter."""
    wanted = routes
    if route_types is not None:
        wanted = wanted.where(F.col("route_type").isin(route_types))
    if agency_ids is not None:
        wanted = wanted.where(F.col("agency_id").isin(agency_ids))
    return trips.join(wanted.select("route_id"), "route_id", "left_semi")


def trip_modes(trips: DataFrame, routes: DataFrame, modes: dict[str, dict]) -> DataFrame:
    """Trips with each ``mode`` whose route types and agencies they meet, from one table of routes."""

    def meets(config: dict) -> Column:
        hit = F.lit(True)
        for column, key in (("route_type", "route_types"), ("agency_id", "agency_ids")):
            if config.get(key) is not None:
                hit = hit & F.coalesce(F.col(column).isin(config[key]), F.lit(False))
        return hit

    named = F.filter(F.array(*[F.when(meets(c), F.lit(m)) for m, c in modes.items()]), lambda m: m.isNotNull())
    known = routes.select("route_id", F.explode(named).alias("mode")).distinct()
    return trips.join(known, "route_id")


def mode_stops(stop_times: DataFrame, trips: DataFrame, routes: DataFrame, route_types: list[int] | None = None, agency_ids: list[int] | None = None) -> DataFrame:
    """Distinct stops that a mode serves."""
    chosen = mode_trips(trips, routes, route_types, agency_ids).select("trip_id").distinct()
    return stop_times.join(chosen, "trip_id", "left_semi").where("stop_id IS NOT NULL").select("stop_id").distinct()


def _with_direction(trips: DataFrame) -> DataFrame:
    direction = F.coalesce(F.col("direction_id").cast("int"), F.lit(-1)) if "direction_id" in trips.columns else F.lit(0)
    return trips.withColumn("direction_id", direction)


def stop_headway(
    stop_times: DataFrame,
    trips: DataFrame,
    dates: DataFrame,
    start_hour: str,
    end_hour: str,
    start_date: str,
    end_date: str,
    days: tuple[str, ...] = WORKDAYS,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """``stop_id, headway``: minutes between departures in a clock window, for each
    value of the trips' columns ``by``.

    Departures are counted by direction, stop and date; the window's minutes
    over that count, rounded half to even, are averaged over dates, and the
    best direction stands. The end date is excluded; times compare as text.
    Departures are added up per service first, so dates multiply counts, not
    timetable rows. A null direction counts as -1, a missing column as 0.
    """
    chosen = dates.where(F.col("weekday").isin(list(days)) & (F.col("date") >= F.to_date(F.lit(start_date))) & (F.col("date") < F.to_date(F.lit(end_date))))
    chosen = chosen.select("service_id", "date").distinct()
    in_window = stop_times.where((F.col("departure_time") >= start_hour) & (F.col("departure_time") < end_hour)).select("trip_id", "stop_id")
    per_service = in_window.join(_with_direction(trips).select("trip_id", "service_id", "direction_id", *by), "trip_id").groupBy("service_id", "direction_id", "stop_id", *by).agg(F.count(F.lit(1)).alias("n"))
    per_date = per_service.join(chosen, "service_id").groupBy("direction_id", "stop_id", "date", *by).agg(F.sum("n").alias("n"))
    headway = half_even(F.lit(minutes_between(start_hour, end_hour)) / F.col("n"))
    return per_date.groupBy("stop_id", "direction_id", *by).agg(F.avg(headway).alias("headway")).groupBy("stop_id", *by).agg(F.min("headway").alias("headway"))


def frequency_headway(
    frequencies: DataFrame,
    stop_times: DataFrame,
    trips: DataFrame,
    dates: DataFrame,
    start_hour: str,
    end_hour: str,
    start_date: str,
    end_date: str,
    days: tuple[str, ...] = WORKDAYS,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """``stop_id, headway`` from stated frequencies, for each value of the trips' columns ``by``.

    Headways are weighted by the hours that a frequency overlaps the window and
    by the dates its trip runs; per stop the best direction stands.
    """
    chosen = dates.where(F.col("weekday").isin(list(days)) & (F.col("date") >= F.to_date(F.lit(start_date))) & (F.col("date") < F.to_date(F.lit(end_date))))
    n_dates = chosen.select("service_id", "date").distinct().groupBy("service_id").agg(F.count(F.lit(1)).alias("n_dates"))
    weighted = frequencies.withColumn("weight", overlap_hours(F.col("start_time"), F.col("end_time"), start_hour, end_hour)).where("weight > 0")
    by_trip = weighted.join(_with_direction(trips).select("trip_id", "service_id", "direction_id", *by), "trip_id").join(n_dates, "service_id")
    at_stops = by_trip.join(stop_times.select("trip_id", "stop_id"), "trip_id")
    w = F.col("weight") * F.col("n_dates")
    per_direction = at_stops.groupBy("stop_id", "direction_id", *by).agg((F.sum(F.col("headway_secs") * w) / F.sum(w)).alias("h"))
    return per_direction.groupBy("stop_id", *by).agg((F.min("h") / 60).alias("headway"))


def prefer(first: DataFrame, second: DataFrame, *key: str) -> DataFrame:
    """Rows of ``first``, and those of ``second`` whose key it lacks."""
    return first.unionByName(second.join(first.select(*key), list(key), "left_anti"))


def headway_summary(stops: DataFrame, by: str) -> DataFrame:
    """Stops per group with headways to 30 and 20 minutes, a total row, and shares."""
    counts = [F.count("stop_id").alias("tot_stops"), F.count_if(F.col("headway") <= 30).alias("headway_30"), F.count_if(F.col("headway") <= 20).alias("headway_20")]
    rolled = stops.rollup(by).agg(*counts, F.grouping(by).alias("_total"))
    share = lambda c: half_even(F.try_divide(F.col(c) * 100.0, F.col("tot_stops").cast("double")), 2)
    label = F.when(F.col("_total") == 1, F.lit("total")).otherwise(F.col(by).cast("string"))
    return rolled.select(label.alias(by), "tot_stops", "headway_30", "headway_20", share("headway_30").alias("pct_headway_30"), share("headway_20").alias("pct_headway_20"))


def average_headway(stops: DataFrame) -> DataFrame:
    """Mean headway per stop over feeds, with the sorted names of the feeds."""
    return stops.groupBy("stop_id").agg(F.avg("headway").alias("headway"), F.array_join(F.array_sort(F.collect_set("feed")), ",").alias("feeds"))


def analyse_feed(feed: dict[str, DataFrame], modes: dict[str, dict], name: str, authority: str, start_hour: str, end_hour: str, start_date: str, end_date: str, interpolate: bool = False) -> DataFrame:
    """Stop headways of every configured mode of one feed; the timetable is read and added up once for all modes."""
    stops = check_stop_ids(feed["stops"])
    times = prepare_stop_times(feed["stop_times"], stops, interpolate)
    dates = service_dates(feed["calendar"], feed["calendar_dates"])
    window = (start_hour, end_hour, start_date, end_date)
    trips = trip_modes(feed["trips"], feed["routes"], modes)
    found = stop_headway(times, trips, dates, *window, by=("mode",))
    if feed.get("frequencies") is not None:
        found = prefer(frequency_headway(feed["frequencies"], times, trips, dates, *window, by=("mode",)), found, "stop_id", "mode")
    return stops.join(found, "stop_id", "left").withColumn("authority", F.lit(authority)).withColumn("feed", F.lit(name))
