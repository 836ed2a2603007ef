"""Fare gates and stations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.functions.keys import surrogate_key
from wayfare.functions.times import service_date, shift, time_period
from wayfare.operators.select import keep_valid, validity
from wayfare.operators.sets import union_all
from wayfare.operators.windows import flag_duplicates, suffix_duplicates

#: Passenger event types; fixed values.
EVENT_TYPES = (
    "Vehicle arrived at stop", "Vehicle departed stop", "Door opened", "Door closed", "Passenger entry", "Passenger exit", "Kneel was engaged", "Kneel was disengaged",
    "Ramp was deployed", "Ramp was raised", "Ramp deployment failed", "Lift was deployed", "Lift was raised", "Individual bike boarded", "Individual bike alighted", "Bike rack deployed",
)
GATES = "faregate_data_ORGN"


def passenger_events(gates: DataFrame) -> DataFrame:
    """Entries and exits at fare gates."""
    kind = F.when(F.col("trxn_type_cd") == "01", "Passenger entry").when(F.col("trxn_type_cd") == "02", "Passenger exit")
    day = service_date("trxn_dtime")
    rows = gates.where(F.col("trxn_type_cd").isin("01", "02"))
    return rows.select(
        F.col("rowid").alias("_row_id"), F.concat(day.cast("string"), F.lit("-"), F.col("trxn_sno").cast("string")).alias("passenger_event_id"), day.alias("service_date"), F.col("trxn_dtime").cast("timestamp").alias("event_timestamp"),
        kind.alias("event_type"), F.col("eqmt_id").alias("device_id"), F.col("stn_id").alias("stop_id"), F.lit(1).alias("event_count"), F.col("trxn_sno").alias("linked_transaction_id"), F.concat(F.lit("Rider class "), F.col("rider_cls_cd").cast("string")).alias("rider_category"), F.lit(GATES).alias("source_system"),
    )


def passenger_events_quality(events: DataFrame) -> DataFrame:
    rows = flag_duplicates(events, ["passenger_event_id", "service_date", "event_timestamp", "event_type", "source_system", "stop_id", "device_id"], "_row_id")
    have = [(f"has_{c}", F.col(c).isNotNull(), f"Missing {c}") for c in ("passenger_event_id", "service_date", "event_timestamp", "event_type", "device_id")]
    return validity(rows, [*have, ("has_valid_event_type", F.col("event_type").isin(*EVENT_TYPES), "Invalid event_type"), ("dup_row_to_keep", F.col("is_keeper"), "Duplicate record")])


def passenger_events_fact(quality: DataFrame) -> DataFrame:
    """Valid events; repeats of an id get a suffix."""
    return suffix_duplicates(keep_valid(quality), "passenger_event_id", ["event_timestamp"], "_row_id", "unique_event_id").drop("passenger_event_id").withColumnRenamed("unique_event_id", "passenger_event_id")


def station_events(gate_events: DataFrame, fare_txns: DataFrame, mezzanines: DataFrame, rail_stops: DataFrame) -> DataFrame:
    """Gate events and fare transactions at stations; ``rail_stops`` has (service_date, stop_id)."""
    no = F.lit(False)
    is_one = lambda *values: F.coalesce(F.col("event_type").isin(*values), no)
    gates = gate_events.where(F.col("stop_id").isNotNull() & (F.col("source_system") == GATES)).select("service_date", "stop_id", "event_timestamp", "event_type", is_one("Passenger entry").alias("is_entry"), is_one("Passenger exit").alias("is_exit"), no.alias("is_entry_transaction"), no.alias("is_exit_transaction"), "source_system")
    seed = mezzanines.select(F.col("mezzanine_id").cast("string").alias("_id"), "station_code")
    fares = fare_txns.join(seed, fare_txns["stop_id"] == F.col("_id")).select("service_date", F.col("station_code").alias("stop_id"), "event_timestamp", F.col("fare_action").alias("event_type"), "source_system")
    fares = fares.join(rail_stops.select("service_date", "stop_id").distinct(), ["service_date", "stop_id"], "left_semi")
    fares = fares.withColumns({"is_entry": no, "is_exit": no, "is_entry_transaction": is_one("Enter", "Transfer entrance"), "is_exit_transaction": is_one("Exit", "Transfer exit")})
    out = union_all(gates, fares).withColumn("hour_of_day", F.hour("event_timestamp"))
    return out.withColumn("_key", surrogate_key("service_date", "stop_id", "event_timestamp", "event_type", "source_system"))


def station_events_quality(events: DataFrame) -> DataFrame:
    rows = flag_duplicates(events, ["_key"], "_key")
    have = [(f"has_{c}", F.col(c).isNotNull(), f"Missing {c}") for c in ("service_date", "stop_id", "event_timestamp")]
    return validity(rows, [*have, ("dup_row_to_keep", F.col("is_keeper"), "Duplicate record")])


def station_activities(quality: DataFrame, calendar: bool = False) -> DataFrame:
    """Hourly entries, exits and transactions of each station.

    The hour is the clock's but counts from the service day, so that one in the morning
    falls a day early; with ``calendar`` it counts from the event's own date.
    """
    rows = keep_valid(quality)
    base = F.to_date("event_timestamp") if calendar else F.col("service_date")
    n = lambda cond: F.count_if(cond)
    entry, leave = F.col("is_entry_transaction"), F.col("is_exit_transaction")
    out = rows.groupBy("service_date", "stop_id", "hour_of_day", base.cast("timestamp").alias("_day")).agg(n(F.col("is_entry")).alias("total_entries"), n(F.col("is_exit")).alias("total_exits"), n(entry).alias("entry_transactions"), n(leave).alias("exit_transactions"), n(entry | leave).alias("number_of_transactions"))
    hour = F.col("hour_of_day")
    return out.withColumns({"time_period_start": shift("_day", hour, "hour"), "time_period_end": shift("_day", hour + 1, "hour"), "time_period_category": time_period(hour, F.col("service_date"))}).drop("_day", "hour_of_day")
