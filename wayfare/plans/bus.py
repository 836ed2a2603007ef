"""Bus vehicle data: locations, imputed trips and stops, stop visits, trips performed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.casts import parse_datetime
from wayfare.functions.keys import differs, surrogate_key
from wayfare.functions.times import diff, format_ts, service_date, utc_to_local
from wayfare.operators.aggregates import any_of, first_by, last_by, mode
from wayfare.operators.joins import nearest
from wayfare.operators.select import classify, validity
from wayfare.operators.sets import union_all, union_groups
from wayfare.operators.windows import fill_down, flag_duplicates, gap_sessions, guarded_delta, over, running_sum

TRIP = ["service_date", "trip_id_performed_imputed"]
VISIT = ["service_date", "trip_id_performed", "trip_stop_sequence"]
TO_STOP = ("Skipped", "Scheduled")
FEET = 0.3048
#: Door states; fixed values.
FRONT, BACK, ALL = "Front door opened and back doors remain closed", "Back doors opened and front door remained closed", "All doors opened"
SUMMED = ("dwell", "distance", "boarding_1", "alighting_1", "boarding_2", "alighting_2", "ramp_deployed_time", "kneel_deployed_time", "lift_deployed_time", "bike_load", "revenue", "number_of_transactions", "custom_ramp_deployed_count", "dwell_imputed")


def stage_bus_events(raw: DataFrame) -> DataFrame:
    """Typed vehicle events with their service day and a key from file and row number."""
    stamps = {c: parse_datetime(c, "%y%m%d%H%M%S", 12) for c in ("event_time", "trip_start_time", "departure_time") if c in raw.columns}
    out = raw.withColumns(stamps).withColumn("_row_id", surrogate_key("file_name", "batch_row_number"))
    return out.withColumns({"service_date": service_date("event_time"), "bus_id": F.col("bus_id").cast("string"), "dwell_time": F.col("dwell_time").try_cast("int")})


def trip_type(pattern: Column, known: Column) -> Column:
    """Pattern codes and the trip types that they stand for."""
    other = "Other not in service"
    return classify([(pattern.like("PI%"), "Pullin"), (pattern.like("PO%"), "Pullout"), (pattern.like("DH%"), "Deadhead"), (pattern.rlike("^[A-Z](98|99)"), other), (pattern == "0", other), (pattern.like("TTT%"), other), (known, "In service")], other)


def vehicle_locations(events: DataFrame, feeds: DataFrame, found_patterns: DataFrame) -> DataFrame:
    """Pings with trip type, status and relation to the schedule."""
    day_feed = feeds.where("feed_mode = 'Bus'").select("service_date", "_feed_hash")
    known = found_patterns.select("_feed_hash", F.col("pattern_id").alias("_pattern"), "shape_id").distinct()
    e = events.join(day_feed, "service_date", "left")
    e = e.join(known, (e["_feed_hash"] == known["_feed_hash"]) & (e["route_id"] == known["_pattern"]), "left").drop(known["_feed_hash"])
    doors = F.greatest(*(F.coalesce(c, F.lit(0)) for c in ("stop_front_door_entry", "stop_front_door_exit", "stop_back_door_entry", "stop_back_door_exit")))
    kind = F.col("event_type")
    return e.select(
        F.col("_row_id").alias("location_ping_id"), "service_date", F.col("event_time").alias("event_timestamp"), F.col("trip_id").alias("trip_id_scheduled"),
        F.col("stop_sequence").alias("trip_stop_sequence"), F.col("bus_id").alias("vehicle_id"), F.col("route_id").alias("pattern_id"), F.col("ta_geo_id").alias("stop_id"),
        "latitude", "longitude", "heading", F.col("odometer_distance").alias("odometer"), "shape_id", trip_type(F.col("route_id"), F.col("_pattern").isNotNull()).alias("trip_type"),
        F.when((kind == 3) | (doors > 0), "Stopped at").alias("current_status"), F.when(kind == 4, "Skipped").when(kind.isin(3, 5, 6, 7, 8, 10, 11), "Scheduled").alias("schedule_relationship"),
    )


def impute_stop_id(locations: DataFrame, feeds: DataFrame, stops: DataFrame, sched_stops: DataFrame, radius_m: float = 300.0) -> DataFrame:
    """``stop_id`` from the stop's code; for pings that relate to the schedule, ``stop_id_imputed`` is the nearest stop of the trip."""
    day_feed = feeds.where("feed_mode = 'Bus'").select("service_date", "_feed_hash")
    codes = stops.select("_feed_hash", F.col("stop_code").alias("_code"), F.col("stop_id").alias("_stop"))
    base = locations.join(day_feed, "service_date", "left")
    base = base.join(codes, (base["_feed_hash"] == codes["_feed_hash"]) & (base["stop_id"] == codes["_code"]), "left").drop("_feed_hash", "_code", "stop_id").withColumnRenamed("_stop", "stop_id")
    near_to = sched_stops.select("service_date", F.col("trip_id").alias("trip_id_scheduled"), F.col("stop_id").alias("stop_id_imputed"), "stop_sequence", "stop_lat", "stop_lon")
    to_stop = base.where(F.col("schedule_relationship").isin(*TO_STOP))
    steps = F.abs(F.coalesce("trip_stop_sequence", F.lit(0)) - F.coalesce("stop_sequence", F.lit(0)))
    best = nearest(to_stop, near_to, ["service_date", "trip_id_scheduled"], ("latitude", "longitude"), ("stop_lat", "stop_lon"), "location_ping_id", "stop_id_imputed", "stop_id_imputed", radius_m, steps).drop("weighted")
    rest = base.where(~F.coalesce(F.col("schedule_relationship").isin(*TO_STOP), F.lit(False))).withColumn("stop_id_imputed", F.col("stop_id"))
    return to_stop.join(best, "location_ping_id", "left").unionByName(rest)


def impute_trip_id(locations: DataFrame, gap_seconds: int = 3600) -> DataFrame:
    """A trip is a vehicle's run on one scheduled trip and pattern without an hour's gap."""
    keys = ["service_date", "vehicle_id", "trip_id_scheduled", "pattern_id"]
    out = gap_sessions(locations, keys, "event_timestamp", gap_seconds, "location_ping_id")
    parts = [F.coalesce(F.col("trip_id_scheduled").cast("string"), F.lit("#")), F.col("vehicle_id").cast("string"), F.coalesce(F.col("pattern_id").cast("string"), F.lit("0")), format_ts("session_start", "%Y%m%d%H%M%S")]
    joined = parts[0]
    for x in parts[1:]:
        joined = F.concat(joined, F.lit("-"), x)
    return out.withColumn("trip_id_performed_imputed", joined).drop("session", "session_start")


def at_stop() -> Column:
    seq = F.col("trip_stop_sequence")
    return F.col("schedule_relationship").isin(*TO_STOP) & F.col("stop_id_imputed").isNotNull() & (seq.isNull() | ~seq.isin(0, -1))


def index_stop_sequence(locations: DataFrame) -> DataFrame:
    """(ping, day, ``trip_stop_sequence_imputed``): counts the stops a trip comes to, in order."""
    order = ["event_timestamp", "location_ping_id"]
    rows = locations.where(at_stop())
    again = F.lag("event_timestamp").over(over([*TRIP, "stop_id_imputed"], order))
    before = F.lag("stop_id_imputed").over(over(TRIP, order))
    new = (again.isNull() | differs(before, F.col("stop_id_imputed"))).cast("int")
    rows = rows.withColumn("_new", new).withColumn("trip_stop_sequence_imputed", running_sum("_new", TRIP, order))
    return rows.select("location_ping_id", "service_date", "trip_stop_sequence_imputed")


def fill_stop_sequence(locations: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """Pings at a stop without a number of their own take the one before or, failing that, after.

    The numbers of :func:`index_stop_sequence` are found in place, among all of a trip's pings: no join, and one
    shuffle by trip.  An ``index`` made elsewhere is joined in instead.
    """
    keys, order = [*TRIP, "stop_id_imputed"], ["event_timestamp", "location_ping_id"]
    number = "trip_stop_sequence_imputed"
    if index is not None:
        return locations.join(index.drop("service_date"), "location_ping_id", "left").withColumn(number, both_ways(number, keys, order))
    earlier = lambda by: over(by, order).rowsBetween(Window.unboundedPreceding, -1)
    rows = locations.withColumn("_at", F.coalesce(at_stop(), F.lit(False)))
    rows = rows.withColumn("_before", F.last(F.when(F.col("_at"), F.col("stop_id_imputed")), ignorenulls=True).over(earlier(TRIP)))
    first = F.coalesce(F.count_if("_at").over(earlier(keys)), F.lit(0)) == 0
    rows = rows.withColumn("_new", (F.col("_at") & (first | differs("_before", F.col("stop_id_imputed")))).cast("int"))
    rows = rows.withColumn(number, F.when(F.col("_at"), running_sum("_new", TRIP, order)))
    return rows.withColumn(number, both_ways(number, keys, order)).drop("_at", "_before", "_new")


def both_ways(col: str, keys: list[str], order: list[str]) -> Column:
    up = F.first(col, ignorenulls=True).over(over(keys, order).rowsBetween(0, Window.unboundedFollowing))
    return F.coalesce(F.col(col), fill_down(col, keys, order), up)


def scheduled_pings(locations: DataFrame) -> DataFrame:
    return locations.where("trip_id_scheduled is not null and trip_type = 'In service' and stop_id is not null")


def map_scheduled_stop(locations: DataFrame, sched_stops: DataFrame) -> DataFrame:
    """A trip's n-th visit to a stop is its n-th scheduled one; visits beyond those keep the last."""
    seen = scheduled_pings(locations).where(F.col("schedule_relationship").isin(*TO_STOP) & ~F.col("trip_stop_sequence").isin(0, -1)).select("service_date", "trip_id_scheduled", "stop_id", "trip_id_performed_imputed", "trip_stop_sequence_imputed").distinct()
    seen = seen.withColumn("nth", F.row_number().over(over([*TRIP, "stop_id"], [F.asc_nulls_last("trip_stop_sequence_imputed")])))
    planned = sched_stops.where("route_type = 3").select("service_date", F.col("trip_id").alias("trip_id_scheduled"), "stop_id", F.col("stop_sequence").alias("scheduled_stop_sequence_imputed"))
    planned = planned.withColumn("nth", F.row_number().over(over(["service_date", "trip_id_scheduled", "stop_id"], ["scheduled_stop_sequence_imputed"])))
    out = seen.join(planned, ["service_date", "trip_id_scheduled", "stop_id", "nth"], "left")
    order = [F.asc_nulls_last("scheduled_stop_sequence_imputed"), F.asc_nulls_last("trip_stop_sequence_imputed")]
    return out.select(*TRIP, "trip_stop_sequence_imputed", "stop_id", fill_down("scheduled_stop_sequence_imputed", ["trip_id_performed_imputed", "stop_id"], order).alias("scheduled_stop_sequence_imputed"))


def rejoin_scheduled_stop(locations: DataFrame, mapped: DataFrame) -> DataFrame:
    """The mapped numbers on every ping of the trip at the stop."""
    rows = scheduled_pings(locations).select("location_ping_id", "service_date", "trip_id_performed_imputed", "trip_stop_sequence", "trip_stop_sequence_imputed", "stop_id", "event_timestamp", "schedule_relationship")
    rows = rows.join(mapped, [*TRIP, "trip_stop_sequence_imputed", "stop_id"], "left")
    keys, order = ["trip_id_performed_imputed", "stop_id"], ["event_timestamp", "location_ping_id"]
    up = F.first("scheduled_stop_sequence_imputed", ignorenulls=True).over(over(keys, order).rowsBetween(0, Window.unboundedFollowing))
    return rows.withColumn("scheduled_stop_sequence_imputed", F.coalesce(fill_down("scheduled_stop_sequence_imputed", keys, order), up))


def locations_quality(locations: DataFrame, rejoined: DataFrame, keys: list[str]) -> DataFrame:
    """Locations with their scheduled stop, duplicates flagged; the first of equal rows is the valid one."""
    rows = locations.join(rejoined.select("location_ping_id", "scheduled_stop_sequence_imputed"), "location_ping_id", "left")
    rows = flag_duplicates(rows, keys, "location_ping_id")
    return validity(rows, [("has_ping_id", F.col("location_ping_id").isNotNull(), "Missing ping id"), ("is_unique", ~F.col("is_duplicate") | F.col("is_keeper"), "Duplicate row")])


def stop_visits(events: DataFrame, locations: DataFrame) -> DataFrame:
    """Visits from stop events, with dwell in seconds and distance from growing odometer readings."""
    loc = locations.select("location_ping_id", "service_date", "trip_id_performed", "trip_stop_sequence", "scheduled_stop_sequence", "pattern_id", "vehicle_id", "event_timestamp", "stop_id", "schedule_relationship", "odometer")
    e = events.where(F.col("event_type").isin(3, 4, 5)).select("_row_id", F.col("dwell_time").alias("dwell"), F.col("departure_time").alias("actual_departure_time"), F.col("stop_front_door_entry").alias("boarding_1"), F.col("stop_front_door_exit").alias("alighting_1"), F.col("stop_back_door_entry").alias("boarding_2"), F.col("stop_back_door_exit").alias("alighting_2"), F.col("passenger_load").alias("departure_load"), F.col("wheel_chair").alias("custom_ramp_deployed_count"))
    rows = e.join(loc, e["_row_id"] == loc["location_ping_id"], "left").drop("location_ping_id").withColumnRenamed("event_timestamp", "actual_arrival_time")
    metres = guarded_delta("odometer", ["vehicle_id", "service_date"], ["actual_arrival_time", "_row_id"], FEET)
    return rows.withColumns({"dwell_imputed": diff("second", "actual_arrival_time", "actual_departure_time").cast("int"), "distance": metres.cast("float")}).drop("odometer")


def merge_repeat_visits(visits: DataFrame) -> DataFrame:
    """One row for each visit recorded in several; single visits are not in the result."""
    have = set(visits.columns)
    rows = visits.where(F.col("trip_id_performed").isNotNull() & F.col("trip_stop_sequence").isNotNull() & F.col("service_date").isNotNull())
    arrival, departure = ["actual_arrival_time", "_row_id"], ["actual_departure_time", "_row_id"]
    aggs: dict[str, Column] = {"scheduled_stop_sequence": first_by("scheduled_stop_sequence", *arrival), "stop_id": first_by("stop_id", *arrival), "pattern_id": any_of("pattern_id"), "vehicle_id": any_of("vehicle_id"), "actual_arrival_time": F.min("actual_arrival_time"), "actual_departure_time": F.max("actual_departure_time"), "departure_load": last_by("departure_load", *departure)}
    aggs |= {c: F.sum(c) for c in SUMMED}
    aggs |= {c: F.bool_or(c) for c in ("timepoint", "ramp_failure", "bike_rack_deployed")}
    aggs |= {"door_open": F.min("door_open"), "door_close": F.max("door_close"), "schedule_arrival_time": F.min("schedule_arrival_time"), "schedule_departure_time": F.max("schedule_departure_time")}
    aggs["schedule_relationship"] = classify([(F.bool_or(F.col("schedule_relationship") == s), s) for s in ("Scheduled", "Skipped", "Added", "Missing")])
    if "door_status" in have:
        saw = lambda s: F.coalesce(F.bool_or(F.col("door_status") == s), F.lit(False))
        aggs["door_status"] = classify([(saw(ALL) | (saw(FRONT) & saw(BACK)), ALL), (saw(FRONT), FRONT), (saw(BACK), BACK)])
    merged = rows.groupBy(*VISIT).agg(F.count("_row_id").alias("_n"), *(v.alias(k) for k, v in aggs.items() if k in have)).where("_n > 1").drop("_n")
    return merged.withColumn("_row_id", surrogate_key(*VISIT)).select(*(c for c in visits.columns if c in merged.columns or c == "_row_id"))


def stop_visits_quality(base: DataFrame, grouped: DataFrame) -> DataFrame:
    """Visits and merged visits together; absorbed rows and rows without trip or sequence are not valid."""
    key = surrogate_key(*VISIT)
    both = union_groups(base.withColumn("_visit", key), grouped.withColumn("_visit", key), "_visit").drop("_visit")
    return validity(both, [("has_trip", F.col("trip_id_performed").isNotNull(), "Missing trip"), ("has_sequence", F.col("trip_stop_sequence").isNotNull(), "Missing stop sequence"), ("not_absorbed", ~F.col("is_absorbed"), "Merged into another row")])


def trips_performed(locations: DataFrame, events: DataFrame, sched_trips: DataFrame, zone: str = "America/New_York", suffix_len: int = 2) -> DataFrame:
    """Each trip's ends, times, most frequent operator and block, and what was scheduled for it."""
    loc = locations.where("schedule_relationship = 'Scheduled'")
    order = ["event_timestamp", "location_ping_id"]
    at = F.when(F.col("stop_id").isNotNull(), F.struct(*order))
    ends = loc.groupBy("trip_id_performed").agg(F.min_by("stop_id", at).alias("trip_start_stop_id"), F.max_by("stop_id", at).alias("trip_end_stop_id"), F.min("event_timestamp").alias("actual_trip_start"), F.max("event_timestamp").alias("actual_trip_end"))
    runs = loc.where("trip_type = 'In service'").join(events.select(F.col("_row_id").alias("location_ping_id"), "operator_id", "block_id"), "location_ping_id", "left")
    roster = runs.groupBy("service_date", "trip_id_performed", "trip_type").agg(*(any_of(c).alias(c) for c in ("vehicle_id", "trip_id_scheduled", "pattern_id")))
    for c in ("operator_id", "block_id"):
        roster = roster.join(mode(runs, ["trip_id_performed"], c).withColumnRenamed(f"mode_{c}", c), "trip_id_performed", "left")
    roster = roster.withColumn("route_id", F.expr(f"substring(pattern_id, 1, length(pattern_id) - {suffix_len})"))
    plan = sched_trips.select("service_date", F.col("trip_id").alias("trip_id_scheduled"), "route_id", F.col("trip_mode").alias("route_type"), F.col("trip_mode").alias("ntd_mode"), "shape_id", "direction_id", utc_to_local("first_scheduled_departure_time", zone).alias("schedule_trip_start"), utc_to_local("last_scheduled_arrival_time", zone).alias("schedule_trip_end"))
    out = roster.join(ends, "trip_id_performed", "left").join(plan, ["service_date", "trip_id_scheduled", "route_id"], "left")
    return out.withColumn("schedule_relationship", F.when(F.col("trip_id_scheduled").isNotNull(), "Scheduled").otherwise("Added"))


def trips_performed_quality(trips: DataFrame) -> DataFrame:
    """Duplicates, start delay and difference in run time, in seconds."""
    rows = flag_duplicates(trips, ["service_date", "trip_id_performed"], "trip_type")
    run = lambda side: diff("second", f"{side}_trip_start", f"{side}_trip_end")
    rows = rows.withColumns({"start_delay_seconds": diff("second", "schedule_trip_start", "actual_trip_start"), "run_time_difference_seconds": run("actual") - run("schedule")})
    return validity(rows, [("has_trip", F.col("trip_id_performed").isNotNull(), "Missing trip"), ("is_unique", ~F.col("is_duplicate") | F.col("is_keeper"), "Duplicate trip")])


def bus_ridership_total(fare: DataFrame, lp: DataFrame) -> DataFrame:
    return union_all(fare.withColumn("source", F.lit("fare")), lp.withColumn("source", F.lit("lp")))

