"""Registered chains: schedules, bus, fares and stations from end to end, on views of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.times import service_date
from wayfare.plans import bus, fares, rail, realtime, schedule
from wayfare.plans.catalog import SQL, c, day, longs, query, table, text
from wayfare.plans.catalog_domain import CARD, PINGS, STATIONS, card, paid, pings, plain, station_events_of

SECOND = "'%Y-%m-%d %H:%M:%S'"

# --- schedules ----------------------------------------------------------------------------


@query("D-G1_stage_schedule", """SELECT 'f' || (o_orderkey % 3) AS _feed_hash, CAST(o_orderkey AS VARCHAR) AS service_id, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 2 = 1 END AS monday,
  CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS start_date, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey AS BIGINT) END AS stop_sequence FROM orders""")
def stage_schedule(s, d):
    k = c("o_orderkey")
    flag = F.when(k % 11 == 0, "x").when(k % 2 == 1, " 1 ").otherwise("0")
    raw = table(s, d, "orders").select(F.concat(F.lit("f"), (k % 3).cast("string")).alias("feed_hash"), F.concat(F.lit(" "), k.cast("string"), F.lit(" ")).alias("service_id"), flag.alias("monday"), F.when(k % 7 == 0, "1995").otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("start_date"), F.when(k % 5 == 0, " ").otherwise(k.cast("string")).alias("stop_sequence"))
    return longs(plain(schedule.stage_schedule({"calendar": raw})["calendar"], "start_date"), "stop_sequence")


@query("D-G4_restrict_to_feeds", """SELECT md5('f' || (l_orderkey % 3) || '-' || l_orderkey || '-' || l_linenumber) AS _key, l_orderkey AS trip_id, CAST((20 + l_linenumber) * 3600 + l_orderkey % 60 * 60 + 30 AS BIGINT) AS arrival_time_secs FROM lineitem WHERE l_orderkey % 3 <> 2""")
def restrict_to_feeds(s, d):
    k, n = c("l_orderkey"), c("l_linenumber")
    feed = F.concat(F.lit("f"), (k % 3).cast("string")).alias("_feed_hash")
    times = table(s, d, "lineitem").select(feed, k.alias("trip_id"), n.alias("stop_sequence"), F.concat_ws(":", (n + 20).cast("string"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit("30")).alias("arrival_time"))
    known = table(s, d, "lineitem").where(k % 3 != 2).select(feed).distinct()
    return longs(schedule.restrict_to_feeds(times, known, ["trip_id", "stop_sequence"]).select("_key", "trip_id", "arrival_time_secs"), "arrival_time_secs")


NETWORK = """WITH o AS (SELECT *, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y-%m') AS feed, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
feeds AS (SELECT DISTINCT feed, month + INTERVAL 8 HOUR AS got, month AS vf, CAST(month + INTERVAL 2 MONTH AS DATE) AS vt FROM o),
trips AS (SELECT feed, o_orderkey AS trip, o_orderkey % 97 AS service, o_custkey % 40 AS route, CASE WHEN o_custkey % 40 % 2 = 0 THEN 'Rail' ELSE 'Bus' END AS mode FROM o),
services AS (SELECT DISTINCT feed, o_orderkey % 97 AS service, day FROM o),
f1 AS (SELECT t.feed, mode, min(s.day) AS first_day FROM (SELECT DISTINCT feed, service, mode FROM trips) t JOIN services s ON t.feed = s.feed AND t.service = s.service GROUP BY 1, 2),
f2 AS (SELECT f1.feed, mode, got, vf, vt, greatest(vf, first_day) AS mf FROM f1 JOIN feeds USING (feed)),
f3 AS (SELECT *, coalesce(lead(mf) OVER (PARTITION BY mode ORDER BY got, feed), vt) AS mt FROM f2),
f4 AS (SELECT day, mode, f3.feed, row_number() OVER (PARTITION BY day, mode ORDER BY got DESC, vf DESC, vt DESC, f3.feed DESC) AS n FROM (SELECT DISTINCT day FROM o) x JOIN f3 ON day BETWEEN mf AND mt WHERE got <= day + INTERVAL 12 HOUR),
best AS (SELECT day, mode, feed FROM f4 WHERE n = 1),
stop_times AS (SELECT feed, l_orderkey AS trip, l_suppkey AS stop, l_linenumber AS seq, l_partkey % 2 AS pickup, l_linenumber * 600 + 25200 AS at_secs FROM lineitem JOIN o ON l_orderkey = o_orderkey),
summary AS (SELECT feed, trip, min(at_secs) AS first_secs FROM stop_times GROUP BY 1, 2 HAVING bool_or(pickup <> 1)),
runs AS (SELECT b.day, t.feed, t.trip, t.route, t.mode, s2.first_secs FROM trips t JOIN services s ON t.feed = s.feed AND t.service = s.service JOIN best b ON b.day = s.day AND b.feed = t.feed AND b.mode = t.mode JOIN summary s2 ON s2.feed = t.feed AND s2.trip = t.trip)"""
ANCHOR = "(((day + INTERVAL 12 HOUR) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' - INTERVAL 12 HOUR + to_seconds({}))"


def network(s, d) -> dict[str, DataFrame]:
    """A schedule bundle for each month of orders: an order is a trip, its lines are its stop times."""
    k, route = c("o_orderkey"), c("o_custkey") % 40
    o = table(s, d, "orders").withColumns({"day": day("o_orderdate"), "_feed_hash": F.date_format("o_orderdate", "yyyy-MM"), "month": F.trunc(day("o_orderdate"), "month")})
    found = o.select("_feed_hash", F.lit("Combined").alias("_feed_type"), (c("month").cast("timestamp") + F.expr("interval 8 hours")).alias("_date_retrieved"), c("month").alias("_valid_from"), F.add_months("month", 2).alias("_valid_to")).distinct()
    trips = o.select("_feed_hash", k.alias("trip_id"), (k % 97).alias("service_id"), route.alias("route_id"), (k % 2).alias("direction_id"), F.lit("b").alias("block_id"), F.lit("s").alias("shape_id"))
    routes = trips.select("_feed_hash", "route_id", F.when(c("route_id") % 2 == 0, 1).otherwise(3).alias("route_type"), F.lit("short").alias("route_short_name"), F.lit("long").alias("route_long_name")).distinct()
    services = o.select("_feed_hash", (k % 97).alias("service_id"), c("day").alias("service_date")).distinct()
    dates = o.select(c("day").alias("service_date")).distinct()
    line = c("l_linenumber")
    times = table(s, d, "lineitem").join(o.select("_feed_hash", "o_orderkey"), c("l_orderkey") == k)
    times = times.select("_feed_hash", c("l_orderkey").alias("trip_id"), c("l_suppkey").alias("stop_id"), line.alias("stop_sequence"), (c("l_partkey") % 2).alias("pickup_type"), (line * 600 + 25200).alias("arrival_time_secs"), (line * 600 + 25230).alias("departure_time_secs"))
    supplier = table(s, d, "supplier").select(c("s_suppkey").alias("stop_id"), c("s_name").alias("stop_name"), (c("s_nationkey") / 100 + 38.9).alias("stop_lat"), F.lit(-77.0).alias("stop_lon"))
    stops = times.select("_feed_hash", "stop_id").distinct().join(supplier, "stop_id")
    by_mode = schedule.daily_feed_by_mode(found, trips, routes, services, dates)
    given = (services, by_mode, trips, routes, schedule.trip_summary(times), "2030-01-01")
    return {"by_mode": by_mode, "trips": schedule.scheduled_trips(*given), "running": schedule.running_trips(*given), "times": times, "stops": stops}


@query("D-G11_daily_feed_by_mode", NETWORK + " SELECT strftime(day, '%Y-%m-%d') AS service_date, mode AS feed_mode, feed AS _feed_hash FROM best")
def daily_feed_by_mode(s, d):
    return plain(network(s, d)["by_mode"].select("service_date", "feed_mode", "_feed_hash"), "service_date")


@query("D-G13_scheduled_trips", NETWORK + f" SELECT strftime(day, '%Y-%m-%d') AS service_date, trip AS trip_id, mode AS trip_mode, route AS route_id, strftime({ANCHOR.format('first_secs')}, {SECOND}) AS first_arrival FROM runs")
def scheduled_trips(s, d):
    out = network(s, d)["trips"].withColumn("first_arrival", text("first_scheduled_arrival_time"))
    return plain(out.select("service_date", "trip_id", "trip_mode", "route_id", "first_arrival"), "service_date")


@query("D-G14_scheduled_stop_times", NETWORK + f""" SELECT strftime(day, '%Y-%m-%d') AS service_date, r.trip AS trip_id, CAST(seq AS BIGINT) AS stop_sequence, stop AS stop_id, s_name AS stop_name, strftime({ANCHOR.format('at_secs')}, {SECOND}) AS arrival
  FROM runs r LEFT JOIN stop_times t ON r.feed = t.feed AND r.trip = t.trip LEFT JOIN supplier ON s_suppkey = stop""")
def scheduled_stop_times(s, d):
    n = network(s, d)
    out = schedule.scheduled_stop_times(n["running"], n["times"], n["stops"]).withColumn("arrival", text("scheduled_arrival_time"))
    return longs(plain(out.select("service_date", "trip_id", "stop_sequence", "stop_id", "stop_name", "arrival"), "service_date"), "stop_sequence")


@query("D-G15_rail_stations", """WITH s AS (SELECT 'f' || (s_suppkey % 2) AS f, chr(CAST(65 + s_suppkey % 26 AS INT)) || (10 + s_suppkey % 90) AS code, 'C' || (10 + s_nationkey) AS other, s_suppkey % 3 AS kind FROM supplier),
t AS (SELECT f, code, other, kind, 'STN_' || code || CASE WHEN kind = 0 THEN '_' || other ELSE '' END AS stop FROM s)
SELECT f AS _feed_hash, code AS station_code, stop AS stop_id FROM t UNION SELECT f, other, stop FROM t WHERE kind = 0""")
def rail_stations(s, d):
    k = c("s_suppkey")
    code = F.concat(F.expr("char(65 + s_suppkey % 26)"), (k % 90 + 10).cast("string"))
    parent = F.concat(F.lit("STN_"), code, F.when(k % 3 == 0, F.concat(F.lit("_C"), (c("s_nationkey") + 10).cast("string"))).otherwise(""))
    stops = table(s, d, "supplier").select(F.concat(F.lit("f"), (k % 2).cast("string")).alias("_feed_hash"), F.concat(F.lit("PF_"), code, F.lit("_1")).alias("stop_id"), parent.alias("parent_station"))
    return schedule.rail_stations(stops)


# --- bus ----------------------------------------------------------------------------------


@query("D-B1_stage_bus_events", f"""SELECT md5('f' || (event_id % 7) || '-' || event_id) AS _row_id, strftime(ts, {SECOND}) AS event_time, strftime(date_trunc('day', date_trunc('second', ts) - INTERVAL 4 HOUR), '%Y-%m-%d') AS service_date, CAST(user_id AS VARCHAR) AS bus_id,
  CASE WHEN event_id % 13 <> 0 THEN event_id % 30 END AS dwell_time FROM events""")
def stage_bus_events(s, d):
    e = c("event_id")
    raw = table(s, d, "events").select(F.concat(F.lit("f"), (e % 7).cast("string")).alias("file_name"), e.alias("batch_row_number"), F.date_format("ts", "yyMMddHHmmss").alias("event_time"), c("user_id").alias("bus_id"), F.when(e % 13 == 0, "x").otherwise((e % 30).cast("string")).alias("dwell_time"))
    out = bus.stage_bus_events(raw).withColumn("event_time", text("event_time"))
    return longs(plain(out.select("_row_id", "event_time", "service_date", "bus_id", "dwell_time"), "service_date"), "dwell_time")


RIDES = """WITH b AS (SELECT CAST(event_id AS VARCHAR) AS id, CAST(date_trunc('day', ts - INTERVAL 4 HOUR) AS DATE) AS day, ts, CASE user_id % 6 WHEN 0 THEN 'PI1' WHEN 1 THEN 'DH2' WHEN 2 THEN 'X98' WHEN 3 THEN '0' ELSE 'P' || (user_id % 6) || 'xx' END AS route, 'T' || (user_id % 9) AS trip,
  event_id % 8 AS seq, event_type AS geo, event_id % 12 AS kind, event_id % 3 AS doors, 38.9 + (event_id % 50) / 1000.0 AS lat, value AS odo, user_id AS bus, 'op' || (event_id % 4) AS operator, 'bl' || (event_id % 3) AS block FROM events),
l AS (SELECT *, CASE WHEN route = 'PI1' THEN 'Pullin' WHEN route = 'DH2' THEN 'Deadhead' WHEN route = 'P4xx' THEN 'In service' ELSE 'Other not in service' END AS type, CASE WHEN kind = 3 OR doors > 0 THEN 'Stopped at' END AS status,
  CASE WHEN kind = 4 THEN 'Skipped' WHEN kind IN (3, 5, 6, 7, 8, 10, 11) THEN 'Scheduled' END AS rel FROM b)"""


def rides(s, d) -> DataFrame:
    e, u = c("event_id"), c("user_id")
    route = F.when(u % 6 == 0, "PI1").when(u % 6 == 1, "DH2").when(u % 6 == 2, "X98").when(u % 6 == 3, "0").otherwise(F.concat(F.lit("P"), (u % 6).cast("string"), F.lit("xx")))
    zero = F.lit(0)
    return table(s, d, "events").select(
        e.cast("string").alias("_row_id"), service_date("ts").alias("service_date"), c("ts").cast("timestamp").alias("event_time"), route.alias("route_id"), F.concat(F.lit("T"), (u % 9).cast("string")).alias("trip_id"), (e % 8).alias("stop_sequence"),
        c("event_type").alias("ta_geo_id"), (e % 12).alias("event_type"), ((e % 50) / 1000.0 + 38.9).alias("latitude"), F.lit(-77.0).alias("longitude"), F.lit(0.0).alias("heading"), c("value").alias("odometer_distance"), u.cast("string").alias("bus_id"),
        (e % 3).alias("stop_front_door_entry"), zero.alias("stop_front_door_exit"), zero.alias("stop_back_door_entry"), zero.alias("stop_back_door_exit"), zero.alias("passenger_load"), zero.alias("wheel_chair"), (e % 30).alias("dwell_time"),
        (c("ts").cast("timestamp") + F.expr("interval 20 seconds")).alias("departure_time"), F.concat(F.lit("op"), (e % 4).cast("string")).alias("operator_id"), F.concat(F.lit("bl"), (e % 3).cast("string")).alias("block_id"),
    )


def located(s, d) -> tuple[DataFrame, DataFrame]:
    """Vehicle locations of the rides, and the feed of each day."""
    e = rides(s, d)
    day_feed = e.select("service_date").distinct().withColumns({"feed_mode": F.lit("Bus"), "_feed_hash": F.lit("f")})
    known = e.where("route_id = 'P4xx'").select(F.lit("f").alias("_feed_hash"), c("route_id").alias("pattern_id"), F.lit("s").alias("shape_id")).distinct()
    return bus.vehicle_locations(e, day_feed, known), day_feed


@query("D-B2_vehicle_locations", RIDES + " SELECT id AS location_ping_id, type AS trip_type, status AS current_status, rel AS schedule_relationship, CASE WHEN route = 'P4xx' THEN 's' END AS shape_id FROM l")
def vehicle_locations(s, d):
    return located(s, d)[0].select("location_ping_id", "trip_type", "current_status", "schedule_relationship", "shape_id")


NEAREST = RIDES + """, p AS (SELECT DISTINCT day, trip, 'S' || geo AS stop, length(geo) AS n, 38.9 + length(geo) * 0.0011 AS s_lat FROM b WHERE geo IS NOT NULL),
h AS (SELECT l.id, p.stop, abs(seq - n) + 1 AS f, (abs(seq - n) + 1) * 2 * 6371000.0 * asin(sqrt(least(pow(sin(radians(s_lat - lat) / 2), 2), 1.0))) AS w FROM l JOIN p ON l.day = p.day AND l.trip = p.trip AND lat BETWEEN s_lat - 300.0 / 111320.0 AND s_lat + 300.0 / 111320.0 WHERE rel IS NOT NULL),
k AS (SELECT id, stop FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY w, f, stop) AS n FROM h) WHERE n = 1)"""


@query("D-B3_impute_stop_id", NEAREST + " SELECT l.id AS location_ping_id, 'S' || geo AS stop_id, CASE WHEN rel IS NOT NULL THEN k.stop ELSE 'S' || geo END AS stop_id_imputed FROM l LEFT JOIN k ON l.id = k.id")
def impute_stop_id(s, d):
    found, day_feed = located(s, d)
    geo = rides(s, d).where("ta_geo_id is not null").select("service_date", "trip_id", F.concat(F.lit("S"), "ta_geo_id").alias("stop_id"), F.length("ta_geo_id").alias("stop_sequence"), c("ta_geo_id").alias("stop_code")).distinct()
    stops = geo.select(F.lit("f").alias("_feed_hash"), "stop_code", "stop_id").distinct()
    planned = geo.select("service_date", "trip_id", "stop_id", "stop_sequence", (c("stop_sequence") * 0.0011 + 38.9).alias("stop_lat"), F.lit(-77.0).alias("stop_lon"))
    return bus.impute_stop_id(found, day_feed, stops, planned).select("location_ping_id", "stop_id", "stop_id_imputed")


@query("D-B9_locations_quality", PINGS + """, q AS (SELECT location_ping_id, row_number() OVER (PARTITION BY service_date, vehicle_id, stop_id ORDER BY location_ping_id) = 1 AS keep FROM p)
SELECT location_ping_id, CASE WHEN location_ping_id % 2 = 0 THEN location_ping_id % 5 END AS scheduled_stop_sequence_imputed, keep AS is_valid, CASE WHEN NOT keep THEN 'Duplicate row' END AS invalid_reason FROM q""")
def locations_quality(s, d):
    p, ping = pings(s, d), c("location_ping_id")
    rejoined = p.where(ping % 2 == 0).select("location_ping_id", (ping % 5).alias("scheduled_stop_sequence_imputed"))
    return bus.locations_quality(p, rejoined, ["service_date", "vehicle_id", "stop_id"]).select("location_ping_id", "scheduled_stop_sequence_imputed", "is_valid", "invalid_reason")


def performed(s, d) -> DataFrame:
    """Locations with a performed trip for each bus and day."""
    out, _ = located(s, d)
    trip = F.concat(c("service_date").cast("string"), F.lit("-"), "vehicle_id")
    return out.withColumns({"trip_id_performed": trip, "scheduled_stop_sequence": c("trip_stop_sequence")})


@query("D-B10_stop_visits", RIDES + """, v AS (SELECT *, lag(odo) OVER (PARTITION BY bus, day ORDER BY ts, id) AS before FROM l WHERE kind IN (3, 4, 5))
SELECT id AS _row_id, CAST(20 AS BIGINT) AS dwell_imputed, round(CAST(CAST(CASE WHEN odo > before THEN (odo - before) * 0.3048 END AS REAL) AS DOUBLE), 1) AS distance, doors AS boarding_1 FROM v""")
def stop_visits(s, d):
    out = bus.stop_visits(rides(s, d), performed(s, d))
    return longs(out.select("_row_id", "dwell_imputed", F.round(c("distance").cast("double"), 1).alias("distance"), "boarding_1"), "dwell_imputed")


PERFORMED = RIDES + f""", y AS (SELECT *, strftime(day, '%Y-%m-%d') || '-' || bus AS run FROM l WHERE rel = 'Scheduled'),
z AS (SELECT run, arg_min(geo, (ts, id)) FILTER (geo IS NOT NULL) AS first_stop, arg_max(geo, (ts, id)) FILTER (geo IS NOT NULL) AS last_stop, min(ts) AS starts, max(ts) AS ends FROM y GROUP BY 1),
r AS (SELECT DISTINCT day, run, trip, bus FROM y WHERE type = 'In service'),
o AS (SELECT run, operator FROM (SELECT run, operator, row_number() OVER (PARTITION BY run ORDER BY count(*) DESC, operator) AS n FROM y WHERE type = 'In service' GROUP BY 1, 2) WHERE n = 1),
q AS (SELECT r.run AS trip_id_performed, CAST(bus AS VARCHAR) AS vehicle_id, operator AS operator_id, first_stop AS trip_start_stop_id, last_stop AS trip_end_stop_id, starts, ends,
  CASE WHEN bus % 2 = 0 THEN (day + INTERVAL 5 HOUR) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' END AS planned, CASE WHEN bus % 2 = 0 THEN (day + INTERVAL 21 HOUR) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' END AS planned_end FROM r JOIN z USING (run) JOIN o USING (run))"""


def trips_run(s, d) -> DataFrame:
    e = rides(s, d)
    bus_no = c("bus_id").cast("bigint")
    plan = e.where((c("route_id") == "P4xx") & (bus_no % 2 == 0)).select("service_date", "trip_id", F.lit("P4").alias("route_id")).distinct()
    at = lambda hours: c("service_date").cast("timestamp") + F.expr(f"interval {hours} hours")
    plan = plan.withColumns({"trip_mode": F.lit("Bus"), "shape_id": F.lit("s"), "direction_id": F.lit(0), "first_scheduled_departure_time": at(5), "last_scheduled_arrival_time": at(21)})
    return bus.trips_performed(performed(s, d), e, plan)


@query("D-B13_trips_performed", PERFORMED + f" SELECT trip_id_performed, vehicle_id, operator_id, trip_start_stop_id, trip_end_stop_id, strftime(starts, {SECOND}) AS starts, strftime(ends, {SECOND}) AS ends, 'Scheduled' AS schedule_relationship FROM q")
def trips_performed(s, d):
    out = trips_run(s, d).withColumns({"starts": text("actual_trip_start"), "ends": text("actual_trip_end")})
    return out.select("trip_id_performed", "vehicle_id", "operator_id", "trip_start_stop_id", "trip_end_stop_id", "starts", "ends", "schedule_relationship")


PLANNED_RUNS = PERFORMED + """, e AS (SELECT DISTINCT day, trip FROM b WHERE route = 'P4xx' AND bus % 2 = 0), j AS (SELECT q.*, e.trip IS NOT NULL AS has_plan FROM q JOIN r ON q.trip_id_performed = r.run LEFT JOIN e ON r.day = e.day AND r.trip = e.trip)"""


@query("D-B14_trips_performed_quality", PLANNED_RUNS + """ SELECT trip_id_performed, CAST(date_diff('second', date_trunc('second', starts), date_trunc('second', ends)) - CASE WHEN has_plan THEN 57600 END AS BIGINT) AS run_time_difference_seconds, TRUE AS is_valid FROM j""")
def trips_performed_quality(s, d):
    whole = trips_run(s, d).withColumns({x: F.date_trunc("second", x) for x in ("actual_trip_start", "actual_trip_end")})
    out = bus.trips_performed_quality(whole)
    return longs(out.select("trip_id_performed", "run_time_difference_seconds", "is_valid"), "run_time_difference_seconds")


@query("D-B15_stage_realtime", "SELECT event_id, strftime(date_trunc('day', ts - INTERVAL 4 HOUR), '%Y-%m-%d') AS service_date, CASE WHEN event_id % 9 <> 0 THEN CAST(user_id AS VARCHAR) END AS currenttripid, CAST(user_id AS VARCHAR) AS vehiclenumber FROM events")
def stage_realtime(s, d):
    e = c("event_id")
    raw = table(s, d, "events").select("event_id", c("ts").alias("upddts"), F.when(e % 9 == 0, "none").otherwise(F.concat(c("user_id").cast("string"), F.lit(".0"))).alias("currenttripid"), c("user_id").alias("vehiclenumber"))
    return plain(realtime.stage_realtime(raw).select("event_id", "service_date", "currenttripid", "vehiclenumber"), "service_date")


# --- fares and stations --------------------------------------------------------------------


@query("D-F1_stage_fares", "SELECT o_orderkey AS k, strftime(date_trunc('day', o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) - INTERVAL 4 HOUR), '%Y-%m-%d') AS service_date FROM orders")
def stage_fares(s, d):
    raw = table(s, d, "orders").select(c("o_orderkey").alias("k"), text(c("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=(c("o_orderkey") % 24).cast("int"))).alias("transaction_dtm"))
    return plain(fares.stage_fares(raw, "transaction_dtm").select("k", "service_date"), "service_date")


@query("D-F2_stage_open_payment", f"SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 4 <> 0 THEN 'ON' END AS lp_type, CASE WHEN o_orderkey % 6 <> 0 THEN strftime(o_orderdate, {SECOND}) END AS transaction_timestamp_utc, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey / 4.0 END AS fare_amount FROM orders")
def stage_open_payment(s, d):
    k = c("o_orderkey")
    raw = table(s, d, "orders").select(k.cast("string").alias("id"), F.when(k % 4 == 0, "  ").otherwise(" ON ").alias("type"), F.when(k % 6 == 0, "soon").otherwise(text("o_orderdate")).alias("transaction_timestamp_utc"), F.when(k % 10 == 0, "free").otherwise((k / 4.0).cast("string")).alias("fare_amount"))
    return fares.stage_open_payment({"taps": raw})["taps"].withColumn("transaction_timestamp_utc", text("transaction_timestamp_utc"))


JOURNEYS = """WITH f AS (SELECT o_orderkey AS k, o_orderkey // 10 AS j, o_orderdate AS ts FROM orders), x AS (SELECT k AS a, k + 1 AS b, j, 'x' || k AS id FROM f WHERE k % 5 = 0), y AS (SELECT k AS a, k + 1 AS b, j, 'y' || k AS id FROM f WHERE k % 7 = 0),
t AS (SELECT k, j, ts, 'b' || k AS tap, 'ON' AS kind FROM f UNION ALL SELECT k, j, ts, 'a' || k, 'OFF' FROM f WHERE k % 3 <> 0),
g AS (SELECT t.*, x.id AS transfer_id, CASE WHEN x.a = t.k THEN 'from_trip' WHEN x.b = t.k THEN 'to_trip' END AS transfer_trip_role, y.id AS connection_id FROM t LEFT JOIN x ON x.j = t.j AND t.k IN (x.a, x.b) LEFT JOIN y ON y.j = t.j AND t.k IN (y.a, y.b))
SELECT tap AS vendor_2_transaction_id, CASE WHEN transfer_id IS NOT NULL OR connection_id IS NOT NULL THEN CASE kind WHEN 'ON' THEN 'Transfer entrance' ELSE 'Transfer exit' END WHEN kind = 'ON' THEN 'Enter' ELSE 'Exit' END AS fare_action, transfer_id, transfer_trip_role, connection_id,
  CASE WHEN k % 4 <> 0 THEN 'loc' END AS location_id, k % 2 <> 0 AS has_adjustment, strftime(date_trunc('day', ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' - INTERVAL 4 HOUR), '%Y-%m-%d') AS service_date FROM g"""


@query("D-F4_open_payment_with_transfers", JOURNEYS)
def open_payment_with_transfers(s, d):
    k = c("o_orderkey")
    o = table(s, d, "orders").withColumns({"journey_id": F.floor(k / 10), "when": c("o_orderdate").cast("timestamp")})
    tap = lambda side: F.concat(F.lit(side), k.cast("string"))
    trips = o.select(k.alias("trip_id"), "journey_id", tap("b").alias("boarded_vendor_2_txn_id"), F.when(k % 3 != 0, tap("a")).alias("alighted_vendor_2_txn_id"), (k % 2).alias("adjustment_amount"))
    link = lambda n, name: o.where(k % n == 0).select(tap("x" if n == 5 else "y").alias(name), "journey_id", k.alias("from_trip_id"), (k + 1).alias("to_trip_id"))

    def taps(side: str, kind: str, good: bool) -> DataFrame:
        rows = o.where(k % 4 != 0) if good else o
        place = F.lit("loc" if good else None).cast("string")
        return rows.select(tap(side).alias("vendor_2_transaction_id"), place.alias("location_id"), F.lit("Main" if good else "").alias("location_name"), F.lit("d").alias("device_id"), F.lit(kind).alias("lp_type"), c("when").alias("record_updated_timestamp_utc"), c("when").alias("transaction_timestamp_utc"), F.lit("r").alias("route_id"))

    both = taps("b", "ON", True).union(taps("b", "ON", False)).union(taps("a", "OFF", True)).union(taps("a", "OFF", False))
    out = fares.open_payment_with_transfers(trips, link(5, "transfer_id"), link(7, "connection_id"), both)
    return plain(out.select("vendor_2_transaction_id", "fare_action", "transfer_id", "transfer_trip_role", "connection_id", "location_id", "has_adjustment", "service_date"), "service_date")


@query("D-F8_fare_transactions", f"""SELECT source AS source_system, count(*) AS n FROM ({CARD} SELECT source, tx, action FROM t) WHERE tx IS NOT NULL AND action <> 'Unknown action type' GROUP BY 1
UNION ALL SELECT 'vendor_2', n FROM ({SQL['D-F7_fare_quality_open_payment']}) WHERE invalid_reason IS NULL""")
def fare_transactions(s, d):
    taps = paid(s, d).withColumn("micropayment_id", c("pay"))
    valid = fares.fare_transactions(fares.fare_quality_card(card(s, d)), fares.fare_quality_open_payment(taps))
    return valid.groupBy("source_system").agg(F.count("*").alias("n"))


@query("D-R1_station_events", STATIONS + " SELECT strftime(service_date, '%Y-%m-%d') AS service_date, stop_id, kind AS event_type, source AS source_system, kind IN ('Enter', 'Transfer entrance') AS is_entry_transaction, count(*) AS n FROM z GROUP BY ALL")
def station_events(s, d):
    keep = ["service_date", "stop_id", "event_type", "source_system", "is_entry_transaction"]
    return plain(station_events_of(s, d).groupBy(*keep).agg(F.count("*").alias("n")), "service_date")


@query("D-R2_station_events_quality", STATIONS + """ SELECT source AS source_system, CASE WHEN n > 1 THEN 'Duplicate record' END AS invalid_reason, count(*) AS n FROM (SELECT source, row_number() OVER (PARTITION BY service_date, stop_id, ts, kind, source) AS n FROM z) GROUP BY 1, 2""")
def station_events_quality(s, d):
    return rail.station_events_quality(station_events_of(s, d)).groupBy("source_system", "invalid_reason").agg(F.count("*").alias("n"))
