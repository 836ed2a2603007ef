"""Published schedules: feed versions, calendars, patterns, trips and stop times.

All tables are keyed by their feed's content hash, ``_feed_hash``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.functions.casts import flex_cast, parse_datetime
from wayfare.functions.keys import extract, surrogate_key
from wayfare.functions.times import clock_seconds, format_ts, iso_dow, service_anchor, shift
from wayfare.operators.joins import expand_ranges, match_ranges, override, restrict
from wayfare.operators.sets import union_distinct
from wayfare.sources.readers import date_spine

ZONE = "America/New_York"
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
#: Route types and their modes; fixed values.
MODES = {1: "Rail", 3: "Bus"}
#: Column types of the schedule tables; columns not named are text.  Fixed values.
TYPES = {
    "route_type": "int", "direction_id": "int", "stop_sequence": "int", "pickup_type": "int", "drop_off_type": "int", "timepoint": "int",
    "wheelchair_boarding": "int", "location_type": "int", "shape_pt_sequence": "int", "exception_type": "int", "stop_lat": "float", "stop_lon": "float",
    "shape_pt_lat": "float", "shape_pt_lon": "float", "shape_dist_traveled": "float", **dict.fromkeys(WEEKDAYS, "boolean"),
}
DATES = ("date", "start_date", "end_date", "feed_start_date", "feed_end_date")


def stage_schedule(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Typed schedule tables from all-text ones; what does not parse is NULL."""

    def typed(name: str) -> Column:
        if name == "feed_hash":
            return F.col(name).alias("_feed_hash")
        made = parse_datetime(name, "%Y%m%d", 8, "date") if name in DATES else flex_cast(name, TYPES.get(name, "string"), True)
        return made.alias(name)

    return {table: df.select(*map(typed, df.columns)) for table, df in raw.items()}


def feed_versions(feed_meta: DataFrame, feed_info: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Feeds with their kind (by source) and the days for which each is current; empty spans go."""
    kind = F.create_map(*(F.lit(x) for pair in kinds.items() for x in pair))
    feeds = feed_meta.withColumn("_feed_type", F.try_element_at(kind, F.col("_source"))).join(feed_info.select("_feed_hash", "feed_version", "feed_start_date", "feed_end_date"), "_feed_hash", "left")
    got = F.to_date("_date_retrieved")
    following = F.lead(got).over(Window.partitionBy("_feed_type").orderBy("_date_retrieved", "_feed_hash"))
    feeds = feeds.withColumns({"_valid_from": F.greatest("feed_start_date", got), "_valid_to": F.least(following, F.col("feed_end_date"), F.add_months(got, 12))})
    return feeds.where("_valid_to > _valid_from")


def dim_dates(spark: SparkSession, start: str = "2018-01-01", end_exclusive: str = "2031-01-01") -> DataFrame:
    d = F.col("date")
    weekday = F.when(F.weekday(d) >= 5, "Weekend").otherwise("Weekday")
    return date_spine(spark, start, end_exclusive).select(d.alias("service_date"), F.year(d).alias("year"), F.month(d).alias("month"), F.day(d).alias("day"), F.dayofyear(d).alias("day_of_year"), format_ts(d, "%A").alias("day_name"), weekday.alias("day_type"))


def restrict_to_feeds(stg: DataFrame, feeds: DataFrame, key_cols: list[str]) -> DataFrame:
    """Rows of known feeds with their surrogate key; clock texts also as seconds."""
    out = restrict(stg, feeds, ["_feed_hash"])
    for c in ("arrival_time", "departure_time"):
        if c in stg.columns:
            out = out.withColumn(f"{c}_secs", clock_seconds(c))
    return out.withColumn("_key", surrogate_key("_feed_hash", *key_cols))


def mode_of(route_type: Column | str = "route_type") -> Column:
    c = F.col(route_type) if isinstance(route_type, str) else route_type
    return F.when(c == 1, MODES[1]).when(c == 3, MODES[3])


def patterns(trips: DataFrame, routes: DataFrame) -> DataFrame:
    """Distinct shapes of each route and direction; the pattern is the shape without its mark."""
    shape = F.when(F.col("route_type") == 1, F.replace("shape_id", F.lit("_"), F.lit(""))).when(F.col("route_type") == 3, F.replace("shape_id", F.lit(":"), F.lit("")))
    rows = trips.join(routes.select("_feed_hash", "route_id", "route_type"), ["_feed_hash", "route_id"])
    return rows.select("_feed_hash", "route_id", "shape_id", "direction_id", shape.alias("pattern_id")).distinct()


def pattern_stops(stop_times: DataFrame, trips: DataFrame, found: DataFrame) -> DataFrame:
    rows = stop_times.join(trips.select("_feed_hash", "trip_id", "shape_id"), ["_feed_hash", "trip_id"]).join(found.select("_feed_hash", "shape_id", "pattern_id"), ["_feed_hash", "shape_id"])
    return rows.select("_feed_hash", "pattern_id", "stop_id", "stop_sequence").distinct()


def route_pattern_trips(trips: DataFrame, found: DataFrame) -> DataFrame:
    rows = trips.select("_feed_hash", "route_id", "trip_id", "shape_id", "direction_id")
    return rows.join(found.select("_feed_hash", "route_id", "shape_id", "direction_id", "pattern_id"), ["_feed_hash", "route_id", "shape_id", "direction_id"])


def calendar_long(calendar: DataFrame) -> DataFrame:
    """A row per feed, service and day of its range, with that weekday's flag."""
    days = expand_ranges(calendar, "start_date", "end_date", "service_date")
    flag = F.element_at(F.array(*(F.col(d) for d in WEEKDAYS)), iso_dow("service_date"))
    return days.select("_feed_hash", "service_id", "service_date", flag.alias("has_service"))


def calendar_exceptions(calendar_dates: DataFrame) -> DataFrame:
    kind = F.col("exception_type")
    return calendar_dates.select("_feed_hash", "service_id", F.col("date").alias("service_date"), F.when(kind == 1, True).when(kind == 2, False).alias("has_service"))


def daily_services(days: DataFrame, exceptions: DataFrame) -> DataFrame:
    keys = ["_feed_hash", "service_id", "service_date"]
    return override(days, exceptions, keys, "has_service").where("has_service").select(*keys)


def daily_feed_by_mode(feeds: DataFrame, trips: DataFrame, routes: DataFrame, services: DataFrame, dates: DataFrame) -> DataFrame:
    """For each day and mode, the newest feed that was there by noon and serves the mode by then.

    A feed starts for a mode on the first day it has service, and stays until the next feed can take over.
    """
    served = trips.join(routes.select("_feed_hash", "route_id", "route_type"), ["_feed_hash", "route_id"]).select("_feed_hash", "service_id", mode_of().alias("feed_mode")).where("feed_mode is not null").distinct()
    first = served.join(services, ["_feed_hash", "service_id"]).groupBy("_feed_hash", "feed_mode").agg(F.min("service_date").alias("first_day"))
    kinds = F.when(F.col("_feed_type") == "Combined", F.array(*map(F.lit, MODES.values()))).otherwise(F.array("_feed_type"))
    by_mode = feeds.withColumn("feed_mode", F.explode(kinds)).join(first, ["_feed_hash", "feed_mode"]).withColumn("mode_from", F.greatest("_valid_from", "first_day"))
    following = F.lead("mode_from").over(Window.partitionBy("feed_mode").orderBy("_date_retrieved", "_feed_hash"))
    by_mode = by_mode.withColumn("mode_to", F.coalesce(following, "_valid_to"))
    found = match_ranges(dates.select("service_date"), by_mode, "service_date", "mode_from", "mode_to").where(F.col("_date_retrieved") <= shift(F.col("service_date").cast("timestamp"), 12, "hour"))
    best = F.max_by(F.struct("_feed_hash", F.col("_feed_type").alias("feed_type")), F.struct("_date_retrieved", "_valid_from", "_valid_to", "_feed_hash"))
    return found.groupBy("service_date", "feed_mode").agg(best.alias("b")).select(surrogate_key("service_date", "feed_mode").alias("_key"), "service_date", "feed_mode", "b.*")


def trip_summary(stop_times: DataFrame) -> DataFrame:
    """Stops, ends, times and whether riders may board, for each trip of a feed."""
    times = {f"{side}_scheduled_{what}_time_secs": fn(f"{what}_time_secs") for side, fn in (("first", F.min), ("last", F.max)) for what in ("arrival", "departure")}
    return stop_times.groupBy("_feed_hash", "trip_id").agg(
        F.count("*").alias("num_scheduled_stops"),
        F.count_distinct("stop_id").alias("num_distinct_stops_serviced"),
        F.min_by("stop_id", F.struct("stop_sequence", "stop_id")).alias("first_scheduled_stop_id"),
        F.max_by("stop_id", F.struct("stop_sequence", "stop_id")).alias("last_scheduled_stop_id"),
        F.bool_or(F.coalesce("pickup_type", F.lit(0)) != 1).alias("has_rider_service"),
        *(v.alias(k) for k, v in times.items()),
    )


def running_trips(services: DataFrame, feeds_by_mode: DataFrame, trips: DataFrame, routes: DataFrame, summary: DataFrame, as_of: str) -> DataFrame:
    """Trips that carry riders, with their days up to ``as_of`` as one array, ``service_dates`` (no more than a feed's days), so that joins by trip move a trip once."""
    days = services.where(F.col("service_date") <= F.lit(as_of).cast("date")).join(feeds_by_mode.select("service_date", "_feed_hash", "feed_mode"), ["service_date", "_feed_hash"])
    days = days.groupBy("_feed_hash", "service_id", F.col("feed_mode").alias("trip_mode")).agg(F.collect_list("service_date").alias("service_dates"))
    routes = routes.select("_feed_hash", "route_id", "route_type", "route_short_name", "route_long_name")
    runs = trips.select("_feed_hash", "trip_id", "service_id", "route_id", "direction_id", "block_id", "shape_id").join(routes, ["_feed_hash", "route_id"], "left").withColumn("trip_mode", F.coalesce(mode_of(), F.lit("Unhandled")))
    return runs.join(days, ["_feed_hash", "service_id", "trip_mode"]).join(summary.where("has_rider_service"), ["_feed_hash", "trip_id"]).drop("has_rider_service")


def daily(rows: DataFrame) -> DataFrame:
    """A row for each of ``service_dates``."""
    return rows.withColumn("service_date", F.explode("service_dates")).drop("service_dates")


def scheduled_trips(services: DataFrame, feeds_by_mode: DataFrame, trips: DataFrame, routes: DataFrame, summary: DataFrame, as_of: str, zone: str = ZONE) -> DataFrame:
    """The trips of each day up to ``as_of``; times count from twelve hours before local noon."""
    rows = daily(running_trips(services, feeds_by_mode, trips, routes, summary, as_of))
    at = {f"{x}_time": shift(service_anchor("service_date", zone), F.col(f"{x}_time_secs"), "second") for x in ("first_scheduled_arrival", "first_scheduled_departure", "last_scheduled_arrival", "last_scheduled_departure")}
    return rows.withColumns(at).withColumn("_key", surrogate_key("_feed_hash", "service_date", "trip_id")).drop(*(f"{x}_secs" for x in at))


def scheduled_stop_times(trips: DataFrame, stop_times: DataFrame, stops: DataFrame, zone: str = ZONE) -> DataFrame:
    """Each day's trips at each stop, with the stop's place; ``trips`` are those of days, or :func:`running_trips`, which become days last."""
    days = "service_dates" if "service_dates" in trips.columns else "service_date"
    at = stop_times.select("_feed_hash", "trip_id", "stop_id", "stop_sequence", "arrival_time_secs", "departure_time_secs").join(stops.select("_feed_hash", "stop_id", "stop_name", "stop_lat", "stop_lon"), ["_feed_hash", "stop_id"], "left")
    rows = trips.select(days, "_feed_hash", "trip_id", "route_id", "route_type", "direction_id", "shape_id").join(at, ["_feed_hash", "trip_id"], "left")
    rows = daily(rows) if days == "service_dates" else rows
    anchor = service_anchor("service_date", zone)
    return rows.withColumns({"scheduled_arrival_time": shift(anchor, F.col("arrival_time_secs"), "second"), "scheduled_departure_time": shift(anchor, F.col("departure_time_secs"), "second")}).withColumn("_key", surrogate_key("_feed_hash", "service_date", "trip_id", "stop_sequence"))


def rail_stations(stops: DataFrame, platform: str = r"^PF_([A-Z][0-9]{2})_", parent: str = r"^STN_([A-Z][0-9]{2})(?:_([A-Z][0-9]{2}))?") -> DataFrame:
    """(feed, station code, stop) from platform ids and from parent-station ids; a parent may name two codes."""
    from_platform = stops.select("_feed_hash", extract("stop_id", platform).alias("station_code"), F.col("parent_station").alias("stop_id"))
    codes = [stops.select("_feed_hash", extract("parent_station", parent, g).alias("station_code"), F.col("parent_station").alias("stop_id")) for g in (1, 2)]
    return union_distinct(from_platform, *codes).where("station_code is not null and stop_id is not null")
