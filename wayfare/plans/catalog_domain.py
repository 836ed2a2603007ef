"""Registered transit queries and checks, on views that Spark and SQL derive alike from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.times import service_date
from wayfare.plans import bus, checks, fares, metrics, rail, realtime, schedule
from wayfare.plans.catalog import c, day, longs, query, table, text
from wayfare.streaming.incremental import tumbling as windows

# --- views ------------------------------------------------------------------------

VISITS = """WITH v AS (SELECT CAST(event_id AS VARCHAR) AS _row_id, CAST(date_trunc('day', ts - INTERVAL 4 HOUR) AS DATE) AS service_date, CASE WHEN event_id % 23 <> 0 THEN CAST(user_id AS VARCHAR) END AS trip_id_performed,
  event_id % 6 AS trip_stop_sequence, 12 AS scheduled_stop_sequence, event_type AS stop_id, ts AS actual_arrival_time, ts + INTERVAL 30 SECOND AS actual_departure_time, 'P' || (user_id % 5) AS pattern_id, user_id AS vehicle_id,
  event_id % 4 AS boarding_1, CASE WHEN event_id % 17 <> 0 THEN event_id % 2 END AS boarding_2, event_id % 3 AS alighting_1, event_id % 2 AS alighting_2, event_id % 5 - 1 AS departure_load,
  CASE WHEN event_id % 7 = 0 THEN 'Skipped' ELSE 'Scheduled' END AS schedule_relationship FROM events)"""


def visits(s, d) -> DataFrame:
    e = c("event_id")
    return table(s, d, "events").select(
        e.cast("string").alias("_row_id"), service_date("ts").alias("service_date"), F.when(e % 23 != 0, c("user_id").cast("string")).alias("trip_id_performed"), (e % 6).alias("trip_stop_sequence"), F.lit(12).alias("scheduled_stop_sequence"),
        c("event_type").alias("stop_id"), c("ts").alias("actual_arrival_time"), (c("ts") + F.expr("interval 30 seconds")).alias("actual_departure_time"), F.concat(F.lit("P"), (c("user_id") % 5).cast("string")).alias("pattern_id"), c("user_id").alias("vehicle_id"),
        (e % 4).alias("boarding_1"), F.when(e % 17 != 0, e % 2).alias("boarding_2"), (e % 3).alias("alighting_1"), (e % 2).alias("alighting_2"), (e % 5 - 1).alias("departure_load"), F.when(e % 7 == 0, "Skipped").otherwise("Scheduled").alias("schedule_relationship"),
    )


PINGS = """WITH p AS (SELECT event_id AS location_ping_id, CAST(date_trunc('day', ts - INTERVAL 4 HOUR) AS DATE) AS service_date, ts AS event_timestamp, CASE WHEN user_id % 4 <> 0 THEN 'T' || (user_id % 9) END AS trip_id_scheduled,
  event_id % 8 - 1 AS trip_stop_sequence, user_id AS vehicle_id, 'P' || (user_id % 3) AS pattern_id, event_type AS stop_id, CASE WHEN event_id % 6 <> 0 THEN event_type END AS stop_id_imputed, 'In service' AS trip_type,
  CASE event_id % 5 WHEN 0 THEN 'Skipped' WHEN 1 THEN NULL ELSE 'Scheduled' END AS schedule_relationship, value AS odometer FROM events),
g AS (SELECT *, CASE WHEN lag(event_timestamp) OVER w IS NULL OR epoch(event_timestamp) - epoch(lag(event_timestamp) OVER w) >= 3600 THEN 1 ELSE 0 END AS gap FROM p WINDOW w AS (PARTITION BY service_date, vehicle_id, trip_id_scheduled, pattern_id ORDER BY event_timestamp, location_ping_id)),
n AS (SELECT *, sum(gap) OVER (PARTITION BY service_date, vehicle_id, trip_id_scheduled, pattern_id ORDER BY event_timestamp, location_ping_id ROWS UNBOUNDED PRECEDING) AS session FROM g),
t AS (SELECT *, coalesce(trip_id_scheduled, '#') || '-' || vehicle_id || '-' || coalesce(pattern_id, '0') || '-' || strftime(min(event_timestamp) OVER (PARTITION BY service_date, vehicle_id, trip_id_scheduled, pattern_id, session), '%Y%m%d%H%M%S') AS trip FROM n)"""


def pings(s, d) -> DataFrame:
    e = c("event_id")
    return table(s, d, "events").select(
        e.alias("location_ping_id"), service_date("ts").alias("service_date"), c("ts").alias("event_timestamp"), F.when(c("user_id") % 4 != 0, F.concat(F.lit("T"), (c("user_id") % 9).cast("string"))).alias("trip_id_scheduled"), (e % 8 - 1).alias("trip_stop_sequence"),
        c("user_id").alias("vehicle_id"), F.concat(F.lit("P"), (c("user_id") % 3).cast("string")).alias("pattern_id"), c("event_type").alias("stop_id"), F.when(e % 6 != 0, c("event_type")).alias("stop_id_imputed"), F.lit("In service").alias("trip_type"),
        F.when(e % 5 == 0, "Skipped").when(e % 5 != 1, "Scheduled").alias("schedule_relationship"), c("value").alias("odometer"),
    )


# --- metrics -----------------------------------------------------------------------

HOURLY = VISITS + """, h AS (SELECT service_date, CAST(actual_arrival_time AS DATE) AS calendar_date, stop_id, hour(actual_arrival_time) AS hour_of_calendar_date, CAST(sum(boarding_1 + boarding_2) AS BIGINT) AS boardings,
  CAST(sum(alighting_1 + alighting_2) AS BIGINT) AS alightings, CAST(sum(boarding_1 + boarding_2 + alighting_1 + alighting_2) AS BIGINT) AS total_activity FROM v GROUP BY ALL)"""
DATES = "strftime(service_date, '%Y-%m-%d') AS service_date"


def plain(df: DataFrame, *dates: str) -> DataFrame:
    return df.withColumns({x: c(x).cast("date").cast("string") for x in dates})


@query("D-M1_hourly_stop_ridership", HOURLY + f" SELECT {DATES}, strftime(calendar_date, '%Y-%m-%d') AS calendar_date, stop_id, hour_of_calendar_date, boardings, alightings, total_activity FROM h")
def hourly_stop_ridership(s, d):
    return longs(plain(metrics.hourly_stop_ridership(visits(s, d)).drop("_key"), "service_date", "calendar_date"), "hour_of_calendar_date")


@query("D-M2_daily_stop_ridership", HOURLY + f" SELECT {DATES}, stop_id, CAST(sum(boardings) AS BIGINT) AS boardings, CAST(sum(alightings) AS BIGINT) AS alightings, CAST(sum(total_activity) AS BIGINT) AS total_activity FROM h GROUP BY ALL")
def daily_stop_ridership(s, d):
    return plain(metrics.daily_stop_ridership(metrics.hourly_stop_ridership(visits(s, d))).drop("_key"), "service_date")


@query("D-M5_trip_ridership", VISITS + f""", x AS (SELECT *, boarding_1 + boarding_2 AS b, alighting_1 + alighting_2 AS a FROM v), y AS (SELECT *, sum(b) OVER w - sum(a) OVER w AS load, row_number() OVER o AS i, row_number() OVER z AS k FROM x
  WINDOW w AS (PARTITION BY service_date, trip_id_performed ORDER BY trip_stop_sequence, actual_arrival_time, stop_id ROWS UNBOUNDED PRECEDING), o AS (PARTITION BY service_date, trip_id_performed ORDER BY trip_stop_sequence, actual_arrival_time, stop_id),
  z AS (PARTITION BY service_date, trip_id_performed ORDER BY trip_stop_sequence DESC, actual_arrival_time DESC, stop_id DESC)),
t AS (SELECT service_date, trip_id_performed, min(pattern_id) AS pattern_id, sum(b) AS boardings, sum(a) AS alightings, max(trip_stop_sequence) AS m, count(*) FILTER (departure_load < 0) AS count_negative_load_stops, count(*) FILTER (departure_load <> load) AS count_load_mismatch_stops,
  coalesce(bool_or(i = 1 AND departure_load <> 0), FALSE) AS has_first_stop_load_not_zero, coalesce(bool_or(k = 1 AND departure_load <> 0), FALSE) AS has_last_stop_load_not_zero FROM y GROUP BY 1, 2)
SELECT {DATES}, trip_id_performed, pattern_id, CAST(boardings AS BIGINT) AS boardings, CAST(alightings AS BIGINT) AS alightings, count_negative_load_stops, count_load_mismatch_stops, has_first_stop_load_not_zero, has_last_stop_load_not_zero,
  round(CAST(boardings AS DOUBLE) / CASE WHEN alightings <> 0 THEN alightings ELSE 1 END, 2) AS on_off_ratio, round(m / 12.0, 2)::DOUBLE AS proportion_stops_served FROM t""")
def trip_ridership(s, d):
    keep = ["service_date", "trip_id_performed", "pattern_id", "boardings", "alightings", "count_negative_load_stops", "count_load_mismatch_stops", "has_first_stop_load_not_zero", "has_last_stop_load_not_zero", "on_off_ratio", "proportion_stops_served"]
    return plain(metrics.trip_ridership(visits(s, d)).select(*keep), "service_date")


# --- bus ---------------------------------------------------------------------------


@query("D-B4_impute_trip_id", PINGS + " SELECT location_ping_id, trip AS trip_id_performed_imputed FROM t")
def impute_trip_id(s, d):
    return bus.impute_trip_id(pings(s, d)).select("location_ping_id", "trip_id_performed_imputed")


INDEXED = PINGS + """, f AS (SELECT *, CASE WHEN lag(event_timestamp) OVER (PARTITION BY service_date, trip, stop_id_imputed ORDER BY event_timestamp, location_ping_id) IS NULL
  OR lag(stop_id_imputed) OVER (PARTITION BY service_date, trip ORDER BY event_timestamp, location_ping_id) IS DISTINCT FROM stop_id_imputed THEN 1 ELSE 0 END AS fresh
  FROM t WHERE schedule_relationship IN ('Skipped', 'Scheduled') AND stop_id_imputed IS NOT NULL AND trip_stop_sequence NOT IN (0, -1)),
i AS (SELECT location_ping_id, CAST(sum(fresh) OVER (PARTITION BY service_date, trip ORDER BY event_timestamp, location_ping_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS seq FROM f)"""


@query("D-B5_index_stop_sequence", INDEXED + " SELECT location_ping_id, seq AS trip_stop_sequence_imputed FROM i")
def index_stop_sequence(s, d):
    return bus.index_stop_sequence(bus.impute_trip_id(pings(s, d))).select("location_ping_id", "trip_stop_sequence_imputed")


FILLED = INDEXED + """, b AS (SELECT t.*, i.seq AS own FROM t LEFT JOIN i USING (location_ping_id)),
z AS (SELECT *, coalesce(own, last_value(own IGNORE NULLS) OVER (PARTITION BY service_date, trip, stop_id_imputed ORDER BY event_timestamp, location_ping_id ROWS UNBOUNDED PRECEDING),
  first_value(own IGNORE NULLS) OVER (PARTITION BY service_date, trip, stop_id_imputed ORDER BY event_timestamp, location_ping_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS seq FROM b)"""


def filled(s, d) -> DataFrame:
    return bus.fill_stop_sequence(bus.impute_trip_id(pings(s, d)))


@query("D-B6_fill_stop_sequence", FILLED + " SELECT location_ping_id, seq AS trip_stop_sequence_imputed FROM z")
def fill_stop_sequence(s, d):
    return filled(s, d).select("location_ping_id", "trip_stop_sequence_imputed")


PLANNED = """, q AS (SELECT DISTINCT service_date, 'T' || (user_id % 9) AS trip_id, event_type AS stop_id, event_id % 6 AS stop_sequence FROM (SELECT *, CAST(date_trunc('day', ts - INTERVAL 4 HOUR) AS DATE) AS service_date FROM events) WHERE event_id % 2 = 0),
qn AS (SELECT *, row_number() OVER (PARTITION BY service_date, trip_id, stop_id ORDER BY stop_sequence) AS nth FROM q),
s0 AS (SELECT DISTINCT service_date, trip_id_scheduled, stop_id, trip, seq FROM z WHERE trip_id_scheduled IS NOT NULL AND stop_id IS NOT NULL AND schedule_relationship IN ('Skipped', 'Scheduled') AND trip_stop_sequence NOT IN (0, -1)),
s1 AS (SELECT *, row_number() OVER (PARTITION BY service_date, trip, stop_id ORDER BY seq NULLS LAST) AS nth FROM s0),
s2 AS (SELECT s1.*, qn.stop_sequence AS sch FROM s1 LEFT JOIN qn ON s1.service_date = qn.service_date AND trip_id_scheduled = trip_id AND s1.stop_id = qn.stop_id AND s1.nth = qn.nth),
m AS (SELECT service_date, trip, seq, stop_id, last_value(sch IGNORE NULLS) OVER (PARTITION BY trip, stop_id ORDER BY sch NULLS LAST, seq NULLS LAST ROWS UNBOUNDED PRECEDING) AS sch FROM s2)"""


def planned(s, d) -> DataFrame:
    e = table(s, d, "events").where("event_id % 2 = 0")
    return e.select(service_date("ts").alias("service_date"), F.concat(F.lit("T"), (c("user_id") % 9).cast("string")).alias("trip_id"), c("event_type").alias("stop_id"), (c("event_id") % 6).alias("stop_sequence")).distinct().withColumn("route_type", F.lit(3))


@query("D-B7_map_scheduled_stop", FILLED + PLANNED + f" SELECT {DATES}, trip AS trip_id_performed_imputed, seq AS trip_stop_sequence_imputed, stop_id, sch AS scheduled_stop_sequence_imputed FROM m")
def map_scheduled_stop(s, d):
    return plain(bus.map_scheduled_stop(filled(s, d), planned(s, d)), "service_date")


@query("D-B8_rejoin_scheduled_stop", FILLED + PLANNED + """, r AS (SELECT z.location_ping_id, z.trip, z.stop_id, z.event_timestamp, m.sch FROM z LEFT JOIN m ON z.service_date = m.service_date AND z.trip = m.trip AND z.seq = m.seq AND z.stop_id = m.stop_id WHERE z.trip_id_scheduled IS NOT NULL)
SELECT location_ping_id, coalesce(last_value(sch IGNORE NULLS) OVER (PARTITION BY trip, stop_id ORDER BY event_timestamp, location_ping_id ROWS UNBOUNDED PRECEDING), first_value(sch IGNORE NULLS) OVER (PARTITION BY trip, stop_id ORDER BY event_timestamp, location_ping_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS scheduled_stop_sequence_imputed FROM r""")
def rejoin_scheduled_stop(s, d):
    f = filled(s, d)
    return bus.rejoin_scheduled_stop(f, bus.map_scheduled_stop(f, planned(s, d))).select("location_ping_id", "scheduled_stop_sequence_imputed")


MERGED = VISITS + """, g AS (SELECT service_date, trip_id_performed, trip_stop_sequence, min(pattern_id) AS pattern_id, arg_min(stop_id, (actual_arrival_time, _row_id)) AS stop_id, min(actual_arrival_time) AS actual_arrival_time, sum(boarding_1) AS boarding_1, sum(boarding_2) AS boarding_2,
  arg_max(departure_load, (actual_departure_time, _row_id)) AS departure_load, CASE WHEN bool_or(schedule_relationship = 'Scheduled') THEN 'Scheduled' ELSE 'Skipped' END AS schedule_relationship
  FROM v WHERE trip_id_performed IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) > 1)"""


@query("D-B11_merge_repeat_visits", MERGED + f" SELECT {DATES}, trip_id_performed, trip_stop_sequence, pattern_id, stop_id, strftime(actual_arrival_time, '%Y-%m-%d %H:%M:%S') AS at, CAST(boarding_1 AS BIGINT) AS boarding_1, CAST(boarding_2 AS BIGINT) AS boarding_2, departure_load, schedule_relationship FROM g")
def merge_repeat_visits(s, d):
    out = bus.merge_repeat_visits(visits(s, d)).withColumn("at", text("actual_arrival_time"))
    return plain(out.select("service_date", "trip_id_performed", "trip_stop_sequence", "pattern_id", "stop_id", "at", "boarding_1", "boarding_2", "departure_load", "schedule_relationship"), "service_date")


@query("D-B12_stop_visits_quality", MERGED + """, o AS (SELECT v.trip_id_performed, v.trip_stop_sequence, FALSE AS is_group, g.service_date IS NOT NULL AS is_absorbed FROM v LEFT JOIN g ON v.service_date = g.service_date AND v.trip_id_performed = g.trip_id_performed AND v.trip_stop_sequence = g.trip_stop_sequence
  UNION ALL SELECT trip_id_performed, trip_stop_sequence, TRUE, FALSE FROM g)
SELECT is_group, trip_id_performed IS NOT NULL AND NOT is_absorbed AS is_valid, CASE WHEN trip_id_performed IS NULL THEN 'Missing trip' WHEN is_absorbed THEN 'Merged into another row' END AS invalid_reason, count(*) AS n FROM o GROUP BY ALL""")
def stop_visits_quality(s, d):
    v = visits(s, d)
    return bus.stop_visits_quality(v, bus.merge_repeat_visits(v)).groupBy("is_group", "is_valid", "invalid_reason").agg(F.count("*").alias("n"))


# --- schedule ------------------------------------------------------------------------


@query("D-G2_feed_versions", """
WITH f AS (SELECT o_orderkey AS h, CASE o_custkey % 3 WHEN 0 THEN 'Combined' WHEN 1 THEN 'Rail' ELSE 'Bus' END AS kind, o_orderdate AS got, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 - 2 AS INT) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 200 AS INT) AS b FROM orders),
g AS (SELECT h, kind, greatest(a, CAST(got AS DATE)) AS v, least(lead(CAST(got AS DATE)) OVER (PARTITION BY kind ORDER BY got, CAST(h AS VARCHAR)), b, CAST(CAST(got AS DATE) + INTERVAL 12 MONTH AS DATE)) AS w FROM f)
SELECT CAST(h AS VARCHAR) AS _feed_hash, kind AS _feed_type, strftime(v, '%Y-%m-%d') AS _valid_from, strftime(w, '%Y-%m-%d') AS _valid_to FROM g WHERE w > v""")
def feed_versions(s, d):
    o = table(s, d, "orders").withColumn("_feed_hash", c("o_orderkey").cast("string"))
    meta = o.select("_feed_hash", (c("o_custkey") % 3).cast("string").alias("_source"), c("o_orderdate").alias("_date_retrieved"))
    start = day("o_orderdate")
    info = o.select("_feed_hash", F.lit("1").alias("feed_version"), F.date_add(start, (c("o_orderkey") % 5 - 2).cast("int")).alias("feed_start_date"), F.date_add(start, (c("o_orderkey") % 200).cast("int")).alias("feed_end_date"))
    out = schedule.feed_versions(meta, info, {"0": "Combined", "1": "Rail", "2": "Bus"})
    return plain(out.select("_feed_hash", "_feed_type", "_valid_from", "_valid_to"), "_valid_from", "_valid_to")


@query("D-G3_dim_dates", """
SELECT strftime(d, '%Y-%m-%d') AS service_date, year(d) AS year, dayofyear(d) AS day_of_year, strftime(d, '%A') AS day_name, CASE WHEN isodow(d) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type, n FROM
(SELECT unnest(generate_series(DATE '1995-01-01', DATE '1995-12-31', INTERVAL 1 DAY)) AS d) JOIN (SELECT CAST(o_orderdate AS DATE) AS x, count(*) AS n FROM orders GROUP BY 1) ON x = CAST(d AS DATE)""")
def dim_dates(s, d):
    n = table(s, d, "orders").groupBy(day("o_orderdate").alias("service_date")).agg(F.count("*").alias("n"))
    out = schedule.dim_dates(s, "1995-01-01", "1996-01-01").join(n, "service_date")
    return longs(plain(out.select("service_date", "year", "day_of_year", "day_name", "day_type", "n"), "service_date"), "year", "day_of_year")


TRIPS = """WITH t AS (SELECT 'f' || (o_orderkey % 2) AS f, CAST(o_orderkey AS VARCHAR) AS trip, CAST(o_custkey % 40 AS VARCHAR) AS route, (o_custkey % 40) || CASE WHEN o_custkey % 40 % 2 = 0 THEN '_' ELSE ':' END || (o_orderkey % 3) AS shape, o_orderkey % 2 AS dir FROM orders)"""


def trips_and_routes(s, d) -> tuple[DataFrame, DataFrame]:
    k, route = c("o_orderkey"), c("o_custkey") % 40
    shape = F.concat(route.cast("string"), F.when(route % 2 == 0, "_").otherwise(":"), (k % 3).cast("string"))
    trips = table(s, d, "orders").select(F.concat(F.lit("f"), (k % 2).cast("string")).alias("_feed_hash"), k.cast("string").alias("trip_id"), route.cast("string").alias("route_id"), shape.alias("shape_id"), (k % 2).alias("direction_id"))
    routes = trips.select("_feed_hash", "route_id").distinct().withColumn("route_type", F.when(c("route_id").cast("int") % 2 == 0, 1).otherwise(3))
    return trips, routes


@query("D-G5_patterns", TRIPS + " SELECT DISTINCT f AS _feed_hash, route AS route_id, shape AS shape_id, dir AS direction_id, replace(replace(shape, '_', ''), ':', '') AS pattern_id FROM t")
def patterns(s, d):
    return schedule.patterns(*trips_and_routes(s, d))


@query("D-G6_pattern_stops", TRIPS + " SELECT DISTINCT f AS _feed_hash, replace(replace(shape, '_', ''), ':', '') AS pattern_id, l_suppkey AS stop_id, l_linenumber AS stop_sequence FROM t JOIN lineitem ON trip = CAST(l_orderkey AS VARCHAR)")
def pattern_stops(s, d):
    trips, routes = trips_and_routes(s, d)
    times = table(s, d, "lineitem").select(F.concat(F.lit("f"), (c("l_orderkey") % 2).cast("string")).alias("_feed_hash"), c("l_orderkey").cast("string").alias("trip_id"), c("l_suppkey").alias("stop_id"), c("l_linenumber").alias("stop_sequence"))
    return schedule.pattern_stops(times, trips, schedule.patterns(trips, routes).dropDuplicates(["_feed_hash", "shape_id"]))


@query("D-G7_route_pattern_trips", TRIPS + " SELECT trip AS trip_id, replace(replace(shape, '_', ''), ':', '') AS pattern_id FROM t")
def route_pattern_trips(s, d):
    trips, routes = trips_and_routes(s, d)
    return schedule.route_pattern_trips(trips, schedule.patterns(trips, routes)).select("trip_id", "pattern_id")


CALENDAR = """WITH k AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 20 AS INT) AS b FROM orders),
l AS (SELECT id, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM k), m AS (SELECT id, day, (id + isodow(day)) % 3 <> 0 AS has FROM l),
x AS (SELECT id, a + CAST(id % 25 AS INT) AS day, CASE WHEN id % 2 = 0 THEN TRUE ELSE FALSE END AS has FROM k)"""


def calendars(s, d) -> tuple[DataFrame, DataFrame]:
    k, start = c("o_orderkey"), day("o_orderdate")
    o = table(s, d, "orders")
    flags = [((k + i + 1) % 3 != 0).alias(w) for i, w in enumerate(schedule.WEEKDAYS)]
    calendar = o.select(F.lit("f").alias("_feed_hash"), k.alias("service_id"), start.alias("start_date"), F.date_add(start, (k % 20).cast("int")).alias("end_date"), *flags)
    dates = o.select(F.lit("f").alias("_feed_hash"), k.alias("service_id"), F.date_add(start, (k % 25).cast("int")).alias("date"), F.when(k % 2 == 0, 1).otherwise(2).alias("exception_type"))
    return calendar, dates


@query("D-G8_calendar_long", CALENDAR + " SELECT id AS service_id, strftime(day, '%Y-%m-%d') AS service_date, has AS has_service FROM m")
@query("D-G8_calendar_long_whole", CALENDAR + " SELECT id AS service_id, strftime(day, '%Y-%m-%d') AS service_date, has AS has_service FROM m")
def calendar_long(s, d):
    return plain(schedule.calendar_long(calendars(s, d)[0]).drop("_feed_hash"), "service_date")


@query("D-G9_calendar_exceptions", CALENDAR + " SELECT id AS service_id, strftime(day, '%Y-%m-%d') AS service_date, has AS has_service FROM x")
@query("D-G9_calendar_exceptions_whole", CALENDAR + " SELECT id AS service_id, strftime(day, '%Y-%m-%d') AS service_date, has AS has_service FROM x")
def calendar_exceptions(s, d):
    return plain(schedule.calendar_exceptions(calendars(s, d)[1]).drop("_feed_hash"), "service_date")


@query("D-G10_daily_services", CALENDAR + " SELECT coalesce(m.id, x.id) AS service_id, strftime(coalesce(m.day, x.day), '%Y-%m-%d') AS service_date FROM m FULL OUTER JOIN x ON m.id = x.id AND m.day = x.day WHERE coalesce(x.has, m.has)")
@query("D-G10_daily_services_whole", CALENDAR + " SELECT coalesce(m.id, x.id) AS service_id, strftime(coalesce(m.day, x.day), '%Y-%m-%d') AS service_date FROM m FULL OUTER JOIN x ON m.id = x.id AND m.day = x.day WHERE coalesce(x.has, m.has)")
def daily_services(s, d):
    calendar, dates = calendars(s, d)
    return plain(schedule.daily_services(schedule.calendar_long(calendar), schedule.calendar_exceptions(dates)).drop("_feed_hash"), "service_date")


@query("D-G12_trip_summary", """
SELECT CAST(l_orderkey AS VARCHAR) AS trip_id, count(*) AS num_scheduled_stops, count(DISTINCT l_suppkey) AS num_distinct_stops_serviced, arg_min(l_suppkey, (l_linenumber, l_suppkey)) AS first_scheduled_stop_id, arg_max(l_suppkey, (l_linenumber, l_suppkey)) AS last_scheduled_stop_id,
  bool_or(l_partkey % 2 <> 1) AS has_rider_service, CAST(min(l_linenumber * 100) AS BIGINT) AS first_arrival, CAST(max(l_linenumber * 100 + 30) AS BIGINT) AS last_departure FROM lineitem GROUP BY l_orderkey""")
def trip_summary(s, d):
    n = c("l_linenumber")
    t = table(s, d, "lineitem").select(F.lit("f").alias("_feed_hash"), c("l_orderkey").cast("string").alias("trip_id"), c("l_suppkey").alias("stop_id"), n.alias("stop_sequence"), (c("l_partkey") % 2).alias("pickup_type"), (n * 100).alias("arrival_time_secs"), (n * 100 + 30).alias("departure_time_secs"))
    out = schedule.trip_summary(t).withColumns({"first_arrival": c("first_scheduled_arrival_time_secs").cast("bigint"), "last_departure": c("last_scheduled_departure_time_secs").cast("bigint")})
    return out.select("trip_id", "num_scheduled_stops", "num_distinct_stops_serviced", "first_scheduled_stop_id", "last_scheduled_stop_id", "has_rider_service", "first_arrival", "last_departure")


# --- fares and rail ---------------------------------------------------------------------


def gates(s, d) -> DataFrame:
    e = c("event_id")
    return table(s, d, "events").select(e.cast("string").alias("rowid"), c("ts").alias("trxn_dtime"), F.when(e % 3 == 0, "01").when(e % 3 == 1, "02").otherwise("09").alias("trxn_type_cd"), (e % 500).alias("trxn_sno"), c("event_type").alias("stn_id"), F.when(e % 13 != 0, (c("user_id") % 7).cast("string")).alias("eqmt_id"), F.lit(None).cast("string").alias("rider_cls_cd"))


GATES = """WITH e AS (SELECT CAST(event_id AS VARCHAR) AS _row_id, CAST(date_trunc('day', ts - INTERVAL 4 HOUR) AS DATE) AS service_date, ts, event_id % 500 AS sno, CASE event_id % 3 WHEN 0 THEN 'Passenger entry' ELSE 'Passenger exit' END AS kind,
  event_type AS stop_id, CASE WHEN event_id % 13 <> 0 THEN CAST(user_id % 7 AS VARCHAR) END AS device_id FROM events WHERE event_id % 3 <> 2),
f AS (SELECT *, strftime(service_date, '%Y-%m-%d') || '-' || sno AS id FROM e),
q AS (SELECT *, row_number() OVER (PARTITION BY id, service_date, ts, kind, stop_id, device_id ORDER BY _row_id) = 1 AS keep FROM f),
g AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ts, _row_id) AS n FROM q WHERE keep AND device_id IS NOT NULL)"""


@query("D-F9_passenger_events", GATES + " SELECT _row_id, CASE WHEN n = 1 THEN id ELSE id || '-' || n END AS passenger_event_id, kind AS event_type FROM g")
def passenger_events(s, d):
    return rail.passenger_events_fact(rail.passenger_events_quality(rail.passenger_events(gates(s, d)))).select("_row_id", "passenger_event_id", "event_type")


STATIONS = GATES + """, y AS (SELECT CAST(date_trunc('day', o_orderdate - INTERVAL 4 HOUR) AS DATE) AS service_date, o_orderdate AS ts, 'A' || (10 + n_nationkey) AS stop_id, CASE o_orderkey % 4 WHEN 0 THEN 'Enter' WHEN 1 THEN 'Exit' WHEN 2 THEN 'Transfer entrance' ELSE 'Transfer exit' END AS kind
  FROM orders JOIN nation ON n_nationkey = o_custkey % 30 WHERE n_nationkey % 2 = 0),
z AS (SELECT service_date, stop_id, ts, kind, 'faregate_data_ORGN' AS source FROM g WHERE stop_id IS NOT NULL UNION ALL SELECT service_date, stop_id, ts, kind, 'FARE_USE' FROM y)"""


def station_events_of(s, d) -> DataFrame:
    """Gate events, and fare transactions at mezzanines (a nation each) of which every second is a rail stop."""
    k = c("o_orderkey")
    gate_events = rail.passenger_events_fact(rail.passenger_events_quality(rail.passenger_events(gates(s, d))))
    action = F.when(k % 4 == 0, "Enter").when(k % 4 == 1, "Exit").when(k % 4 == 2, "Transfer entrance").otherwise("Transfer exit")
    txns = table(s, d, "orders").select((c("o_custkey") % 30).cast("string").alias("stop_id"), service_date("o_orderdate").alias("service_date"), c("o_orderdate").cast("timestamp").alias("event_timestamp"), action.alias("fare_action"), F.lit("FARE_USE").alias("source_system"))
    seed = table(s, d, "nation").select(c("n_nationkey").alias("mezzanine_id"), F.concat(F.lit("A"), (c("n_nationkey") + 10).cast("string")).alias("station_code"))
    stops = txns.select("service_date", c("stop_id").alias("_id")).distinct().join(seed.where("mezzanine_id % 2 = 0"), c("_id") == c("mezzanine_id").cast("string")).select("service_date", c("station_code").alias("stop_id"))
    return rail.station_events(gate_events, txns, seed, stops)


ACTIVITIES = STATIONS + """, k AS (SELECT *, hour(ts) AS h, row_number() OVER (PARTITION BY service_date, stop_id, ts, kind, source) AS n FROM z),
a AS (SELECT service_date, stop_id, h, count(*) FILTER (kind = 'Passenger entry') AS total_entries, count(*) FILTER (kind = 'Passenger exit') AS total_exits,
  count(*) FILTER (kind IN ('Enter', 'Transfer entrance')) AS entry_transactions, count(*) FILTER (kind IN ('Exit', 'Transfer exit')) AS exit_transactions FROM k WHERE n = 1 GROUP BY 1, 2, 3)"""


def activities(s, d) -> DataFrame:
    return rail.station_activities(rail.station_events_quality(station_events_of(s, d)))


@query("D-R3_station_activities", ACTIVITIES + """ SELECT strftime(service_date, '%Y-%m-%d') AS service_date, stop_id, strftime(service_date + to_hours(h), '%Y-%m-%d %H:%M:%S') AS starts, strftime(service_date + to_hours(h + 1), '%Y-%m-%d %H:%M:%S') AS ends,
  CASE WHEN isodow(service_date) >= 6 THEN 'Weekend' WHEN h BETWEEN 4 AND 6 THEN 'Early Morning' WHEN h BETWEEN 7 AND 8 THEN 'AM Peak' WHEN h BETWEEN 9 AND 15 THEN 'Midday' WHEN h BETWEEN 16 AND 17 THEN 'PM Peak' WHEN h BETWEEN 18 AND 21 THEN 'Evening' ELSE 'Late Night' END AS time_period_category,
  total_entries, total_exits, entry_transactions, exit_transactions, entry_transactions + exit_transactions AS number_of_transactions FROM a""")
def station_activities(s, d):
    out = activities(s, d).withColumns({"starts": text("time_period_start"), "ends": text("time_period_end")})
    return plain(out.select("service_date", "stop_id", "starts", "ends", "time_period_category", "total_entries", "total_exits", "entry_transactions", "exit_transactions", "number_of_transactions"), "service_date")


@query("D-M3_hourly_station_ridership", ACTIVITIES + " SELECT strftime(service_date, '%Y-%m-%d') AS service_date, stop_id, strftime(service_date + to_hours(h), '%Y-%m-%d %H:%M:%S') AS starts, total_entries + total_exits AS total_activity, entry_transactions + exit_transactions AS number_of_transactions FROM a")
def hourly_station_ridership(s, d):
    out = metrics.hourly_station_ridership(activities(s, d)).withColumn("starts", text("time_period_start"))
    return plain(out.select("service_date", "stop_id", "starts", "total_activity", "number_of_transactions"), "service_date")


@query("D-M4_daily_station_ridership", ACTIVITIES + " SELECT strftime(service_date, '%Y-%m-%d') AS service_date, stop_id, CAST(sum(total_entries) AS BIGINT) AS total_entries, CAST(sum(total_exits) AS BIGINT) AS total_exits, CAST(sum(total_entries + total_exits) AS BIGINT) AS total_activity, CAST(sum(entry_transactions) AS BIGINT) AS entry_transactions, CAST(sum(exit_transactions) AS BIGINT) AS exit_transactions FROM a GROUP BY 1, 2")
def daily_station_ridership(s, d):
    out = metrics.daily_station_ridership(metrics.hourly_station_ridership(activities(s, d)))
    return plain(out.select("service_date", "stop_id", "total_entries", "total_exits", "total_activity", "entry_transactions", "exit_transactions"), "service_date")


def card(s, d) -> DataFrame:
    k = c("o_orderkey")
    base = table(s, d, "orders").withColumns({"rowid": k.cast("string"), "transaction_id": F.when(k % 19 != 0, (k % 700).cast("string")), "transaction_dtm": c("o_orderdate"), "sv_transaction": c("o_totalprice"), "bus_id": c("o_custkey"), "run_id": k, "route_id": k, "media_type_id": k % 10, "serial_nbr": k, "sv_remaining": c("o_totalprice"), "device_id": (c("o_custkey") % 3).cast("string"), "fare_instrument_id": k, "quantity": F.lit(1.0), "riders": F.lit(1.0), "stop_point_id": k})
    staged = fares.stage_fares(base, "transaction_dtm")
    return fares.fare_transactions_card(staged.where(k % 2 == 0).withColumn("sale_transaction_type", k % 8), staged.where(k % 2 == 1).withColumns({"use_type": k % 13, "use_transaction_type": k % 7}))


CARD = """WITH t AS (SELECT CAST(o_orderkey AS VARCHAR) AS _row_id, CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderkey % 700 AS VARCHAR) END AS tx, o_orderdate AS ts, o_totalprice AS amount, CAST(o_custkey % 3 AS VARCHAR) AS device, CASE WHEN o_orderkey % 2 = 0 THEN 'FARE_SALE' ELSE 'FARE_USE' END AS source,
  CASE WHEN o_orderkey % 2 = 0 THEN CASE WHEN o_orderkey % 8 IN (1, 3) THEN 'Activate' WHEN o_orderkey % 8 IN (2, 4) THEN 'Add' WHEN o_orderkey % 8 = 0 THEN 'New' WHEN o_orderkey % 8 = 5 THEN 'Purchase' WHEN o_orderkey % 8 = 6 THEN 'Other' ELSE 'Unknown action type' END
  ELSE CASE WHEN o_orderkey % 13 IN (9, 12) THEN 'Enter' WHEN o_orderkey % 13 IN (10, 11) THEN 'Exit' WHEN o_orderkey % 13 = 1 AND o_orderkey % 7 = 1 THEN 'Transfer entrance' WHEN o_orderkey % 7 IN (0, 1, 2) THEN 'Enter' WHEN o_orderkey % 7 = 3 THEN 'Exit' WHEN o_orderkey % 7 = 4 THEN 'Transfer entrance' WHEN o_orderkey % 7 = 5 THEN 'Transfer exit' ELSE 'Other' END END AS action,
  CASE WHEN o_orderkey % 10 IN (4, 5) THEN 'Smart card or ticket' WHEN o_orderkey % 10 IN (2, 3) THEN 'Magnetic-stripe card or ticket' WHEN o_orderkey % 10 = 7 THEN 'Cash or coins' ELSE 'Other type' END AS media FROM orders)"""


@query("D-F3_fare_transactions_card", CARD + " SELECT _row_id, action AS fare_action, media AS fare_media_id, source AS source_system FROM t")
def fare_transactions_card(s, d):
    return card(s, d).select("_row_id", "fare_action", "fare_media_id", "source_system")


@query("D-F6_fare_quality_card", CARD + " SELECT CASE WHEN tx IS NULL THEN 'Missing transaction_id' WHEN action = 'Unknown action type' THEN 'Invalid fare_action' END AS invalid_reason, count(*) AS n FROM t GROUP BY 1")
def fare_quality_card(s, d):
    return fares.fare_quality_card(card(s, d)).groupBy("invalid_reason").agg(F.count("*").alias("n"))


PAID = """WITH x AS (SELECT o_orderkey AS id, o_custkey % 400 AS pay, CASE o_custkey % 3 WHEN 0 THEN 'flat_fare' WHEN 1 THEN 'incomplete_variable_fare' ELSE 'complete_variable_fare' END AS kind,
  CASE o_orderkey % 4 WHEN 0 THEN 'Enter' WHEN 1 THEN 'Exit' WHEN 2 THEN 'Transfer entrance' ELSE 'Transfer exit' END AS action, o_totalprice AS charge, o_orderdate AS ts FROM orders)"""


def paid(s, d) -> DataFrame:
    k, pay = c("o_orderkey"), c("o_custkey") % 400
    o = table(s, d, "orders")
    kinds = F.when(k % 4 == 0, "Enter").when(k % 4 == 1, "Exit").when(k % 4 == 2, "Transfer entrance").otherwise("Transfer exit")
    taps = o.select(k.alias("vendor_2_transaction_id"), c("o_orderdate").alias("transaction_timestamp_utc"), kinds.alias("fare_action"), F.lit("r").alias("route_id"), F.lit("l").alias("location_id"), k.cast("string").alias("device_id"))
    charge = F.when(c("o_custkey") % 3 == 0, "flat_fare").when(c("o_custkey") % 3 == 1, "incomplete_variable_fare").otherwise("complete_variable_fare")
    payments = o.select(k.alias("micropayment_id"), c("o_totalprice").alias("charge_amount"), charge.alias("charge_type"), pay.alias("funding_source_id"))
    return fares.fare_transactions_open_payment(taps, o.select(k.alias("vendor_2_transaction_id"), k.alias("micropayment_id")), payments).withColumn("pay", c("token_id"))


@query("D-F5_fare_transactions_open_payment", PAID + """ SELECT id AS transaction_id, CASE WHEN kind <> 'complete_variable_fare' OR action IN ('Exit', 'Transfer exit') THEN charge ELSE 0.0 END AS amount,
  strftime(date_trunc('day', ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' - INTERVAL 4 HOUR), '%Y-%m-%d') AS service_date FROM x""")
def fare_transactions_open_payment(s, d):
    return plain(paid(s, d).select("transaction_id", "amount", "service_date"), "service_date")


@query("D-F7_fare_quality_open_payment", PAID + """, b AS (SELECT pay, kind, count(*) FILTER (action IN ('Enter', 'Transfer entrance')) AS i, count(*) FILTER (action IN ('Exit', 'Transfer exit')) AS o FROM x WHERE kind = 'complete_variable_fare' GROUP BY 1, 2),
r AS (SELECT x.id, CASE WHEN b.pay IS NULL THEN NULL WHEN i > 1 THEN 'Multiple entry records for complete variable fare' WHEN o > 1 THEN 'Multiple exit records for complete variable fare' WHEN i = 0 THEN 'No entry record for complete variable fare' WHEN o = 0 THEN 'No exit record for complete variable fare' END AS invalid_reason FROM x LEFT JOIN b USING (pay))
SELECT invalid_reason, count(*) AS n FROM r GROUP BY 1""")
def fare_quality_open_payment(s, d):
    txns = paid(s, d).withColumn("micropayment_id", c("pay"))
    return fares.fare_quality_open_payment(txns).groupBy("invalid_reason").agg(F.count("*").alias("n"))


AVL = """WITH p AS (SELECT event_id AS id, CAST(date_trunc('day', ts - INTERVAL 4 HOUR) AS DATE) AS day, ts, CAST(user_id AS VARCHAR) AS trip, CASE WHEN event_id % 5 <> 0 THEN event_type END AS stop, user_id % 2 AS revenue,
  CASE user_id % 4 WHEN 0 THEN 'DH1' WHEN 1 THEN 'X2' WHEN 2 THEN 'pi3' ELSE 'Z' END AS route, event_id % 9 AS apcon FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY day, route, trip, stop ORDER BY ts, md5(CAST(id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '-1-1.0-2.0-' || coalesce(stop, '_dbt_utils_surrogate_key_null_'))) AS n FROM p),
v AS (SELECT *, coalesce(stop IS NOT NULL AND n = 1 AND revenue = 1, FALSE) AS visit FROM r)"""


def positions(s, d) -> DataFrame:
    e, u = c("event_id"), c("user_id")
    ev = table(s, d, "events").withColumn("day", service_date("ts"))
    pos = ev.select(e.alias("vehicleid"), e.alias("vehiclenumber"), F.lit(1).alias("vehicleworkid"), F.lit(1).alias("versionid"), u.alias("currenttripid"), F.when(e % 5 != 0, c("event_type")).alias("currentstopid"), text("ts").alias("locationupdatedts"), F.lit("a").alias("tripstartdts"), c("ts").alias("upddts"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), F.lit(0.0).alias("hdgdeg"), F.lit(0.0).alias("speed"), F.lit(0.0).alias("scheddev"), (e % 9).alias("apcon"), (e % 9).alias("apcoff"))
    route = F.when(u % 4 == 0, "DH1").when(u % 4 == 1, "X2").when(u % 4 == 2, "pi3").otherwise("Z")
    trips = ev.select(F.date_format("day", "yyyyMMdd").alias("ldate"), u.alias("vendor_1_tripid"), (u % 2).alias("isrevenue"), route.alias("route"), F.lit("01").alias("tapatternid"), F.lit(None).cast("timestamp").alias("tripstarttime"), F.lit(None).cast("timestamp").alias("tripendtime")).distinct()
    stops = ev.select(F.lit(1).alias("versionid"), c("event_type").alias("stopid"), c("event_type").alias("geostopid"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude")).where("stopid is not null").distinct()
    return realtime.vehicle_locations_realtime(realtime.stage_realtime(pos), realtime.stage_avl_trips(trips), realtime.stage_avl_stops(stops))


@query("D-B16_vehicle_locations_realtime", AVL + " SELECT CAST(id AS VARCHAR) AS vehicle_id, route || '01' AS pattern_id, CASE WHEN revenue = 0 THEN CASE WHEN upper(route) LIKE 'DH%' THEN 'Deadhead' WHEN upper(route) LIKE 'PI%' THEN 'Pullin' ELSE 'Other not in service' END ELSE 'In service' END AS trip_type, visit AS is_stop_visit FROM v")
def vehicle_locations_realtime(s, d):
    return positions(s, d).select("vehicle_id", "pattern_id", "trip_type", "is_stop_visit")


@query("D-B17_stop_visits_realtime", AVL + " SELECT CAST(id AS VARCHAR) AS vehicle_id, stop AS stop_id, CAST(apcon AS DOUBLE) AS boarding_1, CAST(NULL AS DOUBLE) AS boarding_2, TRUE AS is_valid FROM v WHERE visit")
def stop_visits_realtime(s, d):
    return realtime.stop_visits_realtime(positions(s, d)).select("vehicle_id", "stop_id", "boarding_1", "boarding_2", "is_valid")


@query("D-B18_bus_ridership_total", "SELECT l_orderkey AS k, 'fare' AS source FROM lineitem UNION ALL SELECT o_orderkey, 'lp' FROM orders")
def bus_ridership_total(s, d):
    return bus.bus_ridership_total(table(s, d, "lineitem").select(c("l_orderkey").alias("k")), table(s, d, "orders").select(c("o_orderkey").alias("k")))


@query("ST-4_tumbling", "SELECT strftime(time_bucket(INTERVAL 2 HOUR, ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York'), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n FROM events GROUP BY 1")
def tumbling(s, d):
    return windows(table(s, d, "events"), "ts", "2 hours", schedule.ZONE).groupBy(text("window_start").alias("window_start")).agg(F.count("*").alias("n"))


# --- checks ---------------------------------------------------------------------------


@query("Q-1_not_null", VISITS + " SELECT _row_id FROM v WHERE boarding_2 IS NULL")
def not_null(s, d):
    return checks.not_null(visits(s, d), "boarding_2").select("_row_id")


@query("Q-2_unique", "SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1")
def unique(s, d):
    return checks.unique(table(s, d, "orders"), "o_custkey")


@query("Q-3_unique_combination", "SELECT o_custkey, o_orderstatus, count(*) AS n_rows FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def unique_combination(s, d):
    return checks.unique_combination(table(s, d, "orders"), ["o_custkey", "o_orderstatus"])


@query("Q-4_accepted_values", "SELECT o_orderkey FROM orders WHERE o_orderstatus NOT IN ('O', 'F')")
def accepted_values(s, d):
    return checks.accepted_values(table(s, d, "orders"), "o_orderstatus", ["O", "F"]).select("o_orderkey")


@query("Q-5_relationships", "SELECT event_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer)")
def relationships(s, d):
    return checks.relationships(table(s, d, "events"), "user_id", table(s, d, "customer"), "c_custkey").select("event_id")


@query("Q-6_accepted_range", "SELECT c_custkey FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000")
def accepted_range(s, d):
    return checks.accepted_range(table(s, d, "customer"), "c_acctbal", 0, 9000).select("c_custkey")


@query("Q-7_expression_is_true", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT (l_discount <= 0.08) AND l_quantity > 40")
def expression_is_true(s, d):
    return checks.expression_is_true(table(s, d, "lineitem"), "l_discount <= 0.08", "l_quantity > 40").select("l_orderkey", "l_linenumber")


@query("Q-8_equal_rowcount", "SELECT (SELECT count(*) FROM orders) AS n_a, (SELECT count(*) FROM customer) AS n_b WHERE (SELECT count(*) FROM orders) <> (SELECT count(*) FROM customer)")
def equal_rowcount(s, d):
    return checks.equal_rowcount(table(s, d, "orders"), table(s, d, "customer"))


@query("Q-9_not_null_proportion", VISITS + " SELECT round(CAST(count(boarding_2) AS DOUBLE) / count(*), 6) AS proportion FROM v HAVING round(CAST(count(boarding_2) AS DOUBLE) / count(*), 6) < 0.99")
def not_null_proportion(s, d):
    return checks.not_null_proportion(visits(s, d), "boarding_2", 0.99)


@query("Q-10_mutually_exclusive_ranges", "SELECT k FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) + 20 AS b, lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + 20, o_orderkey) AS n FROM orders) WHERE b > n")
def mutually_exclusive_ranges(s, d):
    o = table(s, d, "orders").select(c("o_orderkey").alias("k"), "o_custkey", day("o_orderdate").alias("a"), F.date_add(day("o_orderdate"), 20).alias("b"))
    return checks.mutually_exclusive_ranges(o, "a", "b", ["o_custkey"], tie=("k",)).select("k")


@query("Q-11_null_rate_above", VISITS + f" SELECT {DATES}, count(*) AS n_rows, count(*) - count(boarding_2) AS n_null, round(100.0 * (count(*) - count(boarding_2)) / count(*), 2)::DOUBLE AS pct_null FROM v GROUP BY 1 HAVING pct_null > 5")
def null_rate_above(s, d):
    return plain(checks.null_rate_above(visits(s, d), ["service_date"], "boarding_2"), "service_date")


@query("Q-12_null_reasons", VISITS + f", b AS (SELECT service_date FROM v GROUP BY 1 HAVING round(100.0 * (count(*) - count(boarding_2)) / count(*), 2) > 5) SELECT {DATES}, CASE WHEN trip_id_performed IS NULL THEN 'no trip' ELSE 'other' END AS reason, count(*) AS n_null FROM v WHERE boarding_2 IS NULL AND service_date IN (SELECT service_date FROM b) GROUP BY 1, 2")
def null_reasons(s, d):
    return plain(checks.null_reasons(visits(s, d), ["service_date"], "boarding_2", F.when(c("trip_id_performed").isNull(), "no trip").otherwise("other")), "service_date")


@query("Q-13_stage_loss", VISITS + f", a AS (SELECT service_date, count(*) AS n_before, count(*) FILTER (event <> 0) AS n_after FROM (SELECT service_date, CAST(_row_id AS BIGINT) % 18 AS event FROM v) GROUP BY 1) SELECT {DATES}, n_before, n_after, round(100.0 * (n_before - n_after) / n_before, 2)::DOUBLE AS pct_lost FROM a WHERE round(100.0 * (n_before - n_after) / n_before, 2) > 5")
def stage_loss(s, d):
    v = visits(s, d)
    return plain(checks.stage_loss(v, v.where("cast(_row_id as bigint) % 18 <> 0"), "service_date"), "service_date")


@query("Q-14_missing_categories", "WITH o AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority AS p FROM orders) SELECT d.day, x.p FROM (SELECT DISTINCT day FROM o) d, (VALUES ('1-URGENT'), ('2-HIGH'), ('none')) x(p) WHERE (d.day, x.p) NOT IN (SELECT (day, p) FROM o)")
def missing_categories(s, d):
    o = table(s, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), c("o_orderpriority").alias("p"))
    return checks.missing_categories(o, "day", "p", ["1-URGENT", "2-HIGH", "none"])


@query("Q-15_not_monotonic", "SELECT l_orderkey, l_linenumber FROM (SELECT *, lag(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS b FROM lineitem) WHERE l_shipdate < b")
def not_monotonic(s, d):
    return checks.not_monotonic(table(s, d, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "l_shipdate").select("l_orderkey", "l_linenumber")


@query("Q-16_partial_nulls", VISITS + " SELECT trip_id_performed, count(*) AS n_rows, count(boarding_2) AS n_known FROM v GROUP BY 1 HAVING count(boarding_2) > 0 AND count(boarding_2) < count(*)")
def partial_nulls(s, d):
    return checks.partial_nulls(visits(s, d), ["trip_id_performed"], "boarding_2")


@query("Q-17_several_values", "SELECT p_brand, count(DISTINCT p_type) AS n_values, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS found FROM part GROUP BY 1 HAVING count(DISTINCT p_type) > 1")
def several_values(s, d):
    return checks.several_values(table(s, d, "part"), ["p_brand"], "p_type")


CHECKS = {"order has a customer": "o_custkey IS NULL", "status is known": "o_orderstatus NOT IN ('F', 'O')", "price in range": "o_totalprice < 1000 OR o_totalprice > 400000", "placed after 1993": "NOT (o_orderdate >= TIMESTAMP '1993-01-01')", "urgent orders are open": "o_orderpriority = '1-URGENT' AND NOT (o_orderstatus = 'O')"}


@query("Q-1_checks_in_one_scan", "WITH o AS (SELECT * FROM orders), r AS (" + " UNION ALL ".join(f"SELECT '{name}' AS \"check\", 'warn' AS severity, count(*) FILTER ({bad}) AS failures FROM o" for name, bad in CHECKS.items()) + ") SELECT * FROM r UNION ALL SELECT 'one order a key', 'error', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'customer is known', 'warn', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)")
def checks_in_one_scan(s, d):
    """Five row-wise checks of a table are one scan of it; the others are jobs of their own."""
    o = table(s, d, "orders")
    bad = [checks.is_null("o_custkey"), checks.not_accepted("o_orderstatus", ["F", "O"]), checks.out_of_range("o_totalprice", 1000, 400000), checks.is_false("o_orderdate >= timestamp_ntz'1993-01-01'"), checks.is_false("o_orderstatus = 'O'", "o_orderpriority = '1-URGENT'")]
    rows = [checks.Check(name, table=o, fails=f) for name, f in zip(CHECKS, bad, strict=True)]
    more = [checks.Check("one order a key", checks.unique(o, "o_orderkey"), "error"), checks.Check("customer is known", checks.relationships(o, "o_custkey", table(s, d, "customer"), "c_custkey"))]
    return checks.summarise([*rows, *more])


@query("Q-18_several_signatures", "WITH g AS (SELECT l_orderkey % 50 AS k, l_orderkey AS m, string_agg(CAST(l_suppkey AS VARCHAR), '>' ORDER BY l_linenumber, CAST(l_suppkey AS VARCHAR)) AS sig FROM lineitem GROUP BY 1, 2) SELECT k, count(DISTINCT sig) AS n_signatures FROM g GROUP BY 1 HAVING count(DISTINCT sig) > 1")
def several_signatures(s, d):
    return checks.several_signatures(table(s, d, "lineitem").withColumns({"k": c("l_orderkey") % 50, "m": c("l_orderkey")}), "k", "m", "l_suppkey", "l_linenumber")


@query("Q-19_small_groups", "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) < 2")
def small_groups(s, d):
    return checks.small_groups(table(s, d, "lineitem"), ["l_orderkey"])


@query("Q-20_unmatched_ids", "SELECT user_id, count(*) AS n_rows, strftime(min(ts), '%Y-%m-%d') AS first_day, strftime(max(ts), '%Y-%m-%d') AS last_day FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0) GROUP BY 1")
def unmatched_ids(s, d):
    return plain(checks.unmatched_ids(table(s, d, "events"), "user_id", table(s, d, "customer").where("c_custkey % 3 = 0"), "c_custkey", "ts"), "first_day", "last_day")


@query("Q-21_mismatches", "SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'no reference' ELSE 'different' END AS mismatch FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 7 <> 0) ON o_custkey = c_custkey WHERE c_custkey IS NULL OR c_nationkey <> o_orderkey % 25")
def mismatches(s, d):
    ref = table(s, d, "customer").where("c_custkey % 7 <> 0").select(c("c_custkey").alias("k"), c("c_nationkey").alias("v"))
    return checks.mismatches(table(s, d, "orders").select("o_orderkey", c("o_custkey").alias("k"), (c("o_orderkey") % 25).alias("v")), ref, ["k"], "v").select("o_orderkey", "mismatch")


@query("Q-22_dropped_with_activity", VISITS + " SELECT _row_id FROM v WHERE boarding_1 > 0 AND departure_load < 0")
def dropped_with_activity(s, d):
    v = visits(s, d)
    return checks.dropped_with_activity(v, v.where("departure_load >= 0"), ["_row_id"], c("boarding_1") > 0).select("_row_id")


@query("Q-23_outside_band", "WITH g AS (SELECT user_id, count(*) * 40 AS a, count(*) FILTER (event_type = 'click') * 160 AS b FROM events GROUP BY 1) SELECT user_id FROM g WHERE (b = 0 OR NOT (a / CAST(b AS DOUBLE) BETWEEN 0.5 AND 1.5)) AND abs(a - b) > 20")
def outside_band(s, d):
    g = table(s, d, "events").groupBy("user_id").agg((F.count("*") * 40).alias("a"), (F.count_if(c("event_type") == "click") * 160).alias("b"))
    return checks.outside_band(g, "a", "b").select("user_id")


@query("Q-25_validity", "SELECT o_orderstatus = 'O' AND o_totalprice < 200000 AS is_valid, CASE WHEN o_orderstatus <> 'O' THEN 'Not open' WHEN o_totalprice >= 200000 THEN 'Too dear' END AS invalid_reason, count(*) AS n FROM orders GROUP BY 1, 2")
def validity(s, d):
    from wayfare.operators.select import validity as build

    return build(table(s, d, "orders"), [("open", c("o_orderstatus") == "O", "Not open"), ("cheap", c("o_totalprice") < 200000, "Too dear")]).groupBy("is_valid", "invalid_reason").agg(F.count("*").alias("n"))
