"""Near-real-time bus positions and the stop visits seen in them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from wayfare.functions.keys import surrogate_key
from wayfare.functions.times import service_date
from wayfare.operators.select import classify, conform
from wayfare.operators.windows import first_seen

_VISIT = {
    "_row_id": StringType(), "service_date": DateType(), "trip_id_performed": StringType(), "trip_stop_sequence": IntegerType(), "scheduled_stop_sequence": IntegerType(), "pattern_id": StringType(), "vehicle_id": StringType(),
    "dwell": IntegerType(), "stop_id": StringType(), "timepoint": BooleanType(), "schedule_arrival_time": TimestampType(), "schedule_departure_time": TimestampType(), "actual_arrival_time": TimestampType(), "actual_departure_time": TimestampType(),
    "distance": DoubleType(), "boarding_1": DoubleType(), "alighting_1": DoubleType(), "boarding_2": DoubleType(), "alighting_2": DoubleType(), "departure_load": DoubleType(), "door_open": TimestampType(), "door_close": TimestampType(),
    "door_status": StringType(), "schedule_relationship": StringType(), "is_valid": BooleanType(),
}
#: Columns of stop visits; what positions cannot tell is NULL.
VISITS = StructType([StructField(n, t) for n, t in _VISIT.items()])


def stage_realtime(raw: DataFrame) -> DataFrame:
    """Positions with their service day; trip numbers as text without a decimal part."""
    return raw.withColumns({"service_date": service_date("upddts"), "currenttripid": F.col("currenttripid").try_cast("double").cast("bigint").cast("string"), "vehiclenumber": F.col("vehiclenumber").cast("string")})


def stage_avl_trips(raw: DataFrame) -> DataFrame:
    day = F.try_to_timestamp(F.col("ldate").cast("bigint").cast("string"), F.lit("yyyyMMdd")).cast("date")
    return raw.withColumns({"service_date": day, "vendor_1_tripid": F.col("vendor_1_tripid").try_cast("double").cast("bigint").cast("string")})


def stage_avl_stops(raw: DataFrame) -> DataFrame:
    return raw.select("versionid", "stopid", "geostopid", "latitude", "longitude")


def vehicle_locations_realtime(positions: DataFrame, trips: DataFrame, stops: DataFrame) -> DataFrame:
    """Positions with trip and stop; the first of a trip's at each stop is a stop visit if the trip carries riders.

    Positions of equal update texts, which may be cut to seconds, are told apart by ``upddts``.
    """
    s = stops.select("versionid", F.col("stopid").alias("currentstopid"), "geostopid")
    t = trips.select("service_date", F.col("vendor_1_tripid").alias("currenttripid"), "isrevenue", "route", "tapatternid", "tripstarttime", "tripendtime")
    rows = positions.join(s, ["versionid", "currentstopid"], "left").join(t, ["service_date", "currenttripid"], "left")
    rows = rows.withColumn("location_ping_id", surrogate_key("vehicleid", "locationupdatedts", "vehicleworkid", "latitude", "longitude", "currentstopid"))
    rows = first_seen(rows, ["service_date", "route", "currenttripid", "tripstartdts"], "currentstopid", ["locationupdatedts", "upddts"], "location_ping_id")
    visit = F.coalesce((F.col("seen_rank") == 1) & (F.col("isrevenue") == 1) & F.col("geostopid").isNotNull(), F.lit(False))
    route = F.upper("route")
    idle = classify([(route.like("DH%"), "Deadhead"), (route.like("PI%"), "Pullin"), (route.like("PO%"), "Pullout")], "Other not in service")
    return rows.select(
        "location_ping_id", "service_date", F.col("locationupdatedts").alias("event_timestamp"), F.col("currenttripid").alias("trip_id_scheduled"), F.col("vehiclenumber").alias("vehicle_id"), F.concat("route", "tapatternid").alias("pattern_id"),
        F.col("geostopid").alias("stop_id"), "latitude", "longitude", F.col("hdgdeg").alias("heading"), "speed", F.col("scheddev").alias("schedule_deviation"), F.when(F.col("isrevenue") == 0, idle).otherwise("In service").alias("trip_type"),
        F.col("tripstarttime").alias("trip_start_time"), F.col("tripendtime").alias("trip_end_time"), F.col("route").alias("route_id"), visit.alias("is_stop_visit"), F.when(visit, F.col("apcon")).alias("apcon"), F.when(visit, F.col("apcoff")).alias("apcoff"),
    )


def stop_visits_realtime(locations: DataFrame) -> DataFrame:
    """Stop visits in the shape of the others; all of them count as valid."""
    named = locations.where("is_stop_visit").withColumnsRenamed({"location_ping_id": "_row_id", "event_timestamp": "actual_arrival_time", "apcon": "boarding_1", "apcoff": "alighting_1"})
    return conform(named.withColumn("is_valid", F.lit(True)), VISITS)
