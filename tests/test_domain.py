"""Hand-made rows through the transit chains."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wayfare.functions import casts, keys, times
from wayfare.plans import bus, checks, fares, rail, schedule


def fixed(df):
    """The rows as they are now, without the plan that made them."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_functions(spark):
    s = lambda x: F.lit(x)
    assert one(spark, times.clock_seconds(s("26:30:00"))) == 95400
    assert [one(spark, times.clock_seconds(s(x))) for x in ("", "x", "1:2", "25:61:00")] == [None] * 4
    assert one(spark, casts.flex_cast(s("  "), "string")) is None and one(spark, casts.flex_cast(s("1.0"), "int", True)) is None
    assert one(spark, casts.parse_datetime(s("20240229"), "%Y%m%d", 8, "date")) == date(2024, 2, 29)
    assert [one(spark, casts.parse_datetime(s(x), "%Y%m%d", 8, "date")) for x in ("20240230", "2024", "-2024022")] == [None] * 3
    with pytest.raises(ValueError):
        casts.java_format("%Q")
    service = lambda t: one(spark, times.service_date(F.lit(t).cast("timestamp")))
    assert (service("2024-05-02 03:59:59"), service("2024-05-02 04:00:00")) == (date(2024, 5, 1), date(2024, 5, 2))
    anchor = lambda d: one(spark, times.service_anchor(F.lit(d).cast("date"), "America/New_York"))
    assert anchor("2024-03-10") == datetime(2024, 3, 10, 4) and anchor("2024-03-11") == datetime(2024, 3, 11, 4) and anchor("2024-03-09") == datetime(2024, 3, 9, 5)
    assert one(spark, keys.surrogate_key(F.lit("a"), F.lit(None))) == one(spark, F.md5(F.lit("a-_dbt_utils_surrogate_key_null_")))
    assert keys.table_name("dev", "mart") == "dev_mart" and keys.table_name("prod", "mart") == "mart"


@pytest.fixture(scope="module")
def plan(spark):
    """Two combined feeds; the second takes over on 2024-01-10."""
    meta = spark.createDataFrame([("f1", "src", datetime(2024, 1, 1, 8)), ("f2", "src", datetime(2024, 1, 10, 8))], "_feed_hash string, _source string, _date_retrieved timestamp")
    info = spark.createDataFrame([("f1", "1", date(2024, 1, 1), date(2024, 3, 1)), ("f2", "2", date(2024, 1, 9), date(2024, 3, 1))], "_feed_hash string, feed_version string, feed_start_date date, feed_end_date date")
    both = [(f, *r) for f in ("f1", "f2") for r in (("B1", 3, "10", "Ten"), ("R", 1, "R", "Red"))]
    routes = spark.createDataFrame(both, "_feed_hash string, route_id string, route_type int, route_short_name string, route_long_name string")
    trips = spark.createDataFrame([(f, *r) for f in ("f1", "f2") for r in (("t1", "wk", "B1", 0, "b", "B1:01"), ("t2", "wk", "R", 1, "b", "R_01"))], "_feed_hash string, trip_id string, service_id string, route_id string, direction_id int, block_id string, shape_id string")
    raw_times = [(f, t, f"s{i}", i, h, h, p) for f in ("f1", "f2") for t, p in (("t1", 0), ("t2", 0)) for i, h in ((1, "08:00:00"), (2, "25:10:00"))]
    stop_times = spark.createDataFrame(raw_times, "_feed_hash string, trip_id string, stop_id string, stop_sequence int, arrival_time string, departure_time string, pickup_type int")
    calendar = spark.createDataFrame([(f, "wk", True, True, True, True, True, False, False, date(2024, 1, 1), date(2024, 1, 31)) for f in ("f1", "f2")], "_feed_hash string, service_id string, " + ", ".join(f"{d} boolean" for d in schedule.WEEKDAYS) + ", start_date date, end_date date")
    extra = spark.createDataFrame([(f, "wk", date(2024, 1, 13), 1) for f in ("f1", "f2")] + [("f1", "wk", date(2024, 1, 2), 2)], "_feed_hash string, service_id string, date date, exception_type int")
    stops = spark.createDataFrame([(f, f"s{i}", f"c{i}", f"Stop {i}", 38.9 + i / 1000, -77.0, None) for f in ("f1", "f2") for i in (1, 2)], "_feed_hash string, stop_id string, stop_code string, stop_name string, stop_lat double, stop_lon double, parent_station string")
    feeds = fixed(schedule.feed_versions(meta, info, {"src": "Combined"}))
    services = fixed(schedule.daily_services(schedule.calendar_long(calendar), schedule.calendar_exceptions(extra)))
    by_mode = fixed(schedule.daily_feed_by_mode(feeds, trips, routes, services, schedule.dim_dates(spark, "2024-01-01", "2024-02-01")))
    times_ = fixed(schedule.restrict_to_feeds(stop_times, feeds, ["trip_id", "stop_sequence"]))
    sched = fixed(schedule.scheduled_trips(services, by_mode, trips, routes, schedule.trip_summary(times_), "2024-01-16"))
    return {"feeds": feeds, "services": services, "by_mode": by_mode, "trips": sched, "stops": stops, "stop_times": fixed(schedule.scheduled_stop_times(sched, times_, stops)), "patterns": fixed(schedule.patterns(trips, routes))}


def test_schedule(plan):
    feeds = {r._feed_hash: (r._valid_from, r._valid_to) for r in plan["feeds"].collect()}
    assert feeds == {"f1": (date(2024, 1, 1), date(2024, 1, 10)), "f2": (date(2024, 1, 10), date(2024, 3, 1))}
    days = {r.service_date for r in plan["services"].where("_feed_hash = 'f1'").collect()}
    assert date(2024, 1, 2) not in days and date(2024, 1, 13) in days and date(2024, 1, 6) not in days
    best = {(r.service_date.day, r.feed_mode): r._feed_hash for r in plan["by_mode"].collect()}
    assert best[9, "Bus"] == "f1" and best[10, "Bus"] == "f2" and best[31, "Rail"] == "f2"
    trips = plan["trips"].where("service_date = '2024-01-15' and trip_id = 't1'").collect()
    assert len(trips) == 1 and trips[0].first_scheduled_arrival_time == datetime(2024, 1, 15, 13) and trips[0].last_scheduled_arrival_time == datetime(2024, 1, 16, 6, 10)
    assert plan["trips"].agg(F.max("service_date")).first()[0] == date(2024, 1, 16)
    assert plan["stop_times"].where("service_date = '2024-01-15'").count() == 4
    assert {(r.shape_id, r.pattern_id) for r in plan["patterns"].collect()} == {("B1:01", "B101"), ("R_01", "R01")}


def test_rail_stations(spark):
    stops = spark.createDataFrame([("f", "PF_A01_1", "STN_A01_C01"), ("f", "PF_B02_1", "STN_B02"), ("f", "x", None)], "_feed_hash string, stop_id string, parent_station string")
    assert {(r.station_code, r.stop_id) for r in schedule.rail_stations(stops).collect()} == {("A01", "STN_A01_C01"), ("C01", "STN_A01_C01"), ("B02", "STN_B02")}


def test_bus_chain(spark, plan):
    at = lambda h, m: datetime(2024, 1, 15, h, m)
    rows = [("e1", at(13, 0), "B101", "t1", 1, "c1", 3, 38.901, -77.0, 100.0), ("e2", at(13, 5), "B101", "t1", 1, "c1", 5, 38.901, -77.0, 100.0), ("e3", at(13, 9), "B101", "t1", 2, "c2", 4, 38.9021, -77.0, 300.0), ("e4", at(15, 0), "PI1", None, None, None, 1, 0.0, 0.0, 400.0)]
    events = spark.createDataFrame([(i, e, p, t, q, g, k, la, lo, od, date(2024, 1, 15)) for i, e, p, t, q, g, k, la, lo, od in rows], "_row_id string, event_time timestamp, route_id string, trip_id string, stop_sequence int, ta_geo_id string, event_type int, latitude double, longitude double, odometer_distance double, service_date date")
    for c in ("stop_front_door_entry", "stop_front_door_exit", "stop_back_door_entry", "stop_back_door_exit", "passenger_load", "wheel_chair"):
        events = events.withColumn(c, F.lit(1.0))
    events = events.withColumns({"bus_id": F.lit("7"), "heading": F.lit(0.0), "dwell_time": F.lit(5), "departure_time": F.col("event_time") + F.expr("interval 20 seconds"), "operator_id": F.lit("op"), "block_id": F.lit("bl")})
    events = fixed(events)
    loc = fixed(bus.vehicle_locations(events, plan["by_mode"], plan["patterns"]))
    kinds = {r.location_ping_id: (r.trip_type, r.schedule_relationship) for r in loc.collect()}
    assert kinds == {"e1": ("In service", "Scheduled"), "e2": ("In service", "Scheduled"), "e3": ("In service", "Skipped"), "e4": ("Pullin", None)}
    loc = fixed(bus.impute_stop_id(loc, plan["by_mode"], plan["stops"], plan["stop_times"]))
    assert {r.location_ping_id: r.stop_id_imputed for r in loc.collect()} == {"e1": "s1", "e2": "s1", "e3": "s2", "e4": None}
    loc = fixed(bus.impute_trip_id(loc))
    loc = fixed(bus.fill_stop_sequence(loc, bus.index_stop_sequence(loc)))
    assert {r.location_ping_id: r.trip_stop_sequence_imputed for r in loc.collect()} == {"e1": 1, "e2": 1, "e3": 2, "e4": None}
    back = fixed(bus.rejoin_scheduled_stop(loc, bus.map_scheduled_stop(loc, plan["stop_times"])))
    assert {r.location_ping_id: r.scheduled_stop_sequence_imputed for r in back.collect()} == {"e1": 1, "e2": 1, "e3": 2}
    final = bus.locations_quality(loc, back, ["service_date", "vehicle_id", "event_timestamp"]).where("is_valid")
    final = final.withColumns({"trip_id_performed": F.col("trip_id_performed_imputed"), "trip_stop_sequence": F.col("trip_stop_sequence_imputed"), "scheduled_stop_sequence": F.col("scheduled_stop_sequence_imputed")})
    final = fixed(final)
    visits = fixed(bus.stop_visits(events, final))
    assert {r._row_id: (r.dwell_imputed, None if r.distance is None else round(r.distance, 2)) for r in visits.collect()} == {"e1": (20, None), "e2": (20, None), "e3": (20, 60.96)}
    merged = bus.merge_repeat_visits(visits).collect()
    assert [(r.trip_stop_sequence, r.dwell, r.boarding_1, r.schedule_relationship) for r in merged] == [(1, 10, 2.0, "Scheduled")]
    quality = bus.stop_visits_quality(visits, bus.merge_repeat_visits(visits))
    assert quality.count() == 4 and quality.where("is_valid").count() == 2
    done = bus.trips_performed_quality(bus.trips_performed(final, events, plan["trips"].withColumn("route_id", F.lit("B1")))).collect()
    assert [(r.operator_id, r.trip_start_stop_id, r.schedule_relationship, r.is_valid) for r in done] == [("op", "s1", "Scheduled", True)]


def test_open_payment(spark):
    taps = spark.createDataFrame([("x1", None, "d", "ON", datetime(2024, 1, 1)), ("x1", "loc", "d", "ON", datetime(2023, 1, 1)), ("x2", "loc2", "d2", "OFF", datetime(2024, 1, 1)), ("x3", "loc", "d3", "SINGLE", datetime(2024, 1, 1))], "vendor_2_transaction_id string, location_id string, device_id string, lp_type string, record_updated_timestamp_utc timestamp")
    taps = taps.withColumns({"location_name": F.col("location_id"), "transaction_timestamp_utc": F.lit("2024-01-01 08:30:00").cast("timestamp"), "route_id": F.lit("r")})
    trips = spark.createDataFrame([("t1", "j1", "x1", "x2", 0.0), ("t2", "j2", "x3", None, 1.0)], "trip_id string, journey_id string, boarded_vendor_2_txn_id string, alighted_vendor_2_txn_id string, adjustment_amount double")
    transfers = spark.createDataFrame([("a", "j1", "t1", "t9"), ("b", "j1", "t0", "t1")], "transfer_id string, journey_id string, from_trip_id string, to_trip_id string")
    links = spark.createDataFrame([], "connection_id string, journey_id string, from_trip_id string, to_trip_id string")
    out = fixed(fares.open_payment_with_transfers(trips, transfers, links, taps))
    got = {r.vendor_2_transaction_id: (r.fare_action, r.transfer_id, r.location_id, r.service_date, r.has_adjustment) for r in out.collect()}
    day = date(2023, 12, 31)
    assert got == {"x1": ("Transfer entrance", "b", "loc", day, False), "x2": ("Transfer exit", "b", "loc2", day, False), "x3": ("Enter", None, "loc", day, True)}
    pay = spark.createDataFrame([("m1", 2.0, "complete_variable_fare", "card"), ("m2", 1.5, "flat_fare", "card")], "micropayment_id string, charge_amount double, charge_type string, funding_source_id string")
    of = spark.createDataFrame([("x1", "m1"), ("x2", "m1"), ("x3", "m2")], "vendor_2_transaction_id string, micropayment_id string")
    txns = fixed(fares.fare_transactions_open_payment(out, of, pay))
    assert {r.transaction_id: r.amount for r in txns.collect()} == {"x1": 0.0, "x2": 2.0, "x3": 1.5}
    quality = fares.fare_quality_open_payment(txns)
    assert all(r.is_valid for r in quality.collect())
    lone = fares.fare_quality_open_payment(txns.where("transaction_id <> 'x2'"))
    assert {r.transaction_id: r.invalid_reason for r in lone.collect()} == {"x1": "No exit record for complete variable fare", "x3": None}


def test_station_events(spark):
    gates = spark.createDataFrame([("1", datetime(2024, 1, 2, 1), "01", 5, "A01", "d", None), ("2", datetime(2024, 1, 2, 1), "02", 5, "A01", "d", None), ("3", datetime(2024, 1, 2, 9), "09", 6, "A01", "d", None)], "rowid string, trxn_dtime timestamp, trxn_type_cd string, trxn_sno int, stn_id string, eqmt_id string, rider_cls_cd string")
    events = rail.passenger_events_fact(rail.passenger_events_quality(rail.passenger_events(gates)))
    assert sorted(r.passenger_event_id for r in events.collect()) == ["2024-01-01-5", "2024-01-01-5-2"]
    txns = spark.createDataFrame([("17", date(2024, 1, 1), datetime(2024, 1, 1, 9), "Enter", "FARE_USE"), ("99", date(2024, 1, 1), datetime(2024, 1, 1, 9), "Enter", "FARE_USE")], "stop_id string, service_date date, event_timestamp timestamp, fare_action string, source_system string")
    seed = spark.createDataFrame([(17, "A01")], "mezzanine_id int, station_code string")
    stops = spark.createDataFrame([(date(2024, 1, 1), "A01")], "service_date date, stop_id string")
    out = rail.station_activities(rail.station_events_quality(rail.station_events(events, txns, seed, stops)))
    got = {r.time_period_start: (r.total_entries, r.total_exits, r.entry_transactions, r.time_period_category) for r in out.collect()}
    assert got == {datetime(2024, 1, 1, 1): (1, 1, 0, "Late Night"), datetime(2024, 1, 1, 9): (0, 0, 1, "Midday")}


def test_summary(spark):
    df = spark.createDataFrame([(1, None), (1, "a")], "k int, v string")
    found = checks.summarise([checks.Check("nulls", checks.not_null(df, "v")), checks.Check("twice", checks.unique(df, "k"), "error")])
    assert {r.check: (r.severity, r.failures) for r in found.collect()} == {"nulls": ("warn", 1), "twice": ("error", 1)}
