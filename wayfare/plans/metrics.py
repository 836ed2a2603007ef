"""Ridership by stop, station and trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.functions.keys import safe_ratio, surrogate_key
from wayfare.operators.aggregates import any_of, roll_up
from wayfare.operators.sets import with_today
from wayfare.operators.windows import over, running_sum

TRIP = ["service_date", "trip_id_performed"]


def on_and_off(null_as_zero: bool = False) -> tuple[Column, Column]:
    """Boardings and alightings over both doors; NULL where either door's figure is, unless told otherwise."""
    door = lambda c: F.coalesce(F.col(c), F.lit(0)) if null_as_zero else F.col(c)
    return door("boarding_1") + door("boarding_2"), door("alighting_1") + door("alighting_2")


def hourly_stop_ridership(stop_visits: DataFrame, realtime: DataFrame | None = None, as_of: str | None = None, null_as_zero: bool = False) -> DataFrame:
    on, off = on_and_off(null_as_zero)
    rows = with_today(stop_visits, realtime, "service_date", as_of or "")
    keys = ["service_date", "calendar_date", "stop_id", "hour_of_calendar_date"]
    rows = rows.select("service_date", F.to_date("actual_arrival_time").alias("calendar_date"), "stop_id", F.hour("actual_arrival_time").alias("hour_of_calendar_date"), on.alias("boardings"), off.alias("alightings"))
    out = rows.groupBy(*keys).agg(F.sum("boardings").alias("boardings"), F.sum("alightings").alias("alightings"), F.sum(F.col("boardings") + F.col("alightings")).alias("total_activity"))
    return out.withColumn("_key", surrogate_key(*keys))


def daily_stop_ridership(hourly: DataFrame) -> DataFrame:
    keys = ["service_date", "stop_id"]
    return roll_up(hourly, keys, ["boardings", "alightings", "total_activity"]).withColumn("_key", surrogate_key(*keys))


def hourly_station_ridership(activities: DataFrame) -> DataFrame:
    return activities.select("service_date", "stop_id", "time_period_start", "time_period_end", "time_period_category", "total_entries", "total_exits", (F.col("total_entries") + F.col("total_exits")).alias("total_activity"), "entry_transactions", "exit_transactions", "number_of_transactions")


def daily_station_ridership(hourly: DataFrame) -> DataFrame:
    sums = ["total_entries", "total_exits", "total_activity", "entry_transactions", "exit_transactions", "number_of_transactions"]
    return roll_up(hourly, ["service_date", "stop_id"], sums)


def trip_ridership(stop_visits: DataFrame, realtime: DataFrame | None = None, as_of: str | None = None, drop_unnamed: bool = False) -> DataFrame:
    """Boardings, alightings and load checks of each trip; ``drop_unnamed`` leaves out rows without a trip."""
    rows = with_today(stop_visits, realtime, "service_date", as_of or "")
    rows = rows.where("trip_id_performed is not null") if drop_unnamed else rows
    on, off = on_and_off()
    order = ["trip_stop_sequence", "actual_arrival_time", "stop_id"]
    rows = rows.withColumns({"_on": on, "_off": off}).withColumns({"_load": running_sum("_on", TRIP, order) - running_sum("_off", TRIP, order), "_first": F.row_number().over(over(TRIP, order)) == 1, "_last": F.row_number().over(over(TRIP, [F.desc(c) for c in order])) == 1})
    load = F.col("departure_load")
    yes = lambda cond: F.coalesce(F.bool_or(cond), F.lit(False))
    out = rows.groupBy(*TRIP).agg(
        any_of("pattern_id").alias("pattern_id"), any_of("vehicle_id").alias("vehicle_id"), F.sum("_on").alias("boardings"), F.sum("_off").alias("alightings"),
        F.max("trip_stop_sequence").alias("max_trip_stop_sequence"), F.max("scheduled_stop_sequence").alias("max_scheduled_stop_sequence"),
        yes(F.col("_first") & (load != 0)).alias("has_first_stop_load_not_zero"), yes(F.col("_last") & (load != 0)).alias("has_last_stop_load_not_zero"),
        yes(load < 0).alias("has_negative_load"), F.count_if(load < 0).alias("count_negative_load_stops"),
        yes(load != F.col("_load")).alias("has_load_mismatch"), F.count_if(load != F.col("_load")).alias("count_load_mismatch_stops"),
    )
    some = F.when(F.col("alightings") != 0, F.col("alightings")).otherwise(1)
    return out.withColumns({"_key": surrogate_key(*TRIP), "on_off_ratio": safe_ratio(F.col("boardings"), some), "proportion_stops_served": safe_ratio(F.col("max_trip_stop_sequence"), F.col("max_scheduled_stop_sequence"))})
