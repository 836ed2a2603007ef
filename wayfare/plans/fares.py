"""Fare transactions from cards and open payment, and their quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfare.functions.casts import flex_cast
from wayfare.functions.keys import surrogate_key
from wayfare.functions.times import service_date, utc_to_local
from wayfare.operators.select import classify, keep_valid, validity
from wayfare.operators.sets import union_all, unpivot_roles
from wayfare.operators.windows import flag_duplicates, keep_first

ZONE = "America/New_York"
#: Accepted actions and media; fixed values.
ACTIONS = ("Purchase", "Enter", "Exit", "Transfer entrance", "Transfer exit", "Add", "New", "Capture", "Extend", "Combine", "Void", "Activate", "Adjust", "Other")
MEDIA = ("Cash or coins", "Smart card or ticket", "Magnetic-stripe card or ticket", "Bank card", "Mobile NFC", "Optical scan", "Button pressed by driver or operator to indicate a boarding or alighting passenger.", "Other type")
ENTER, EXIT = ("Enter", "Transfer entrance"), ("Exit", "Transfer exit")


def stage_fares(raw: DataFrame, stamp: str) -> DataFrame:
    """A card table with its service day."""
    return raw.withColumn(stamp, F.col(stamp).cast("timestamp")).withColumn("service_date", service_date(stamp))


def stage_open_payment(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The open-payment tables: texts trimmed, ``*_utc`` as timestamps, amounts as doubles; a tap's ``type`` is ``lp_type``."""

    def typed(name: str) -> Column:
        kind = "timestamp" if name.endswith("_utc") else "double" if name.endswith("_amount") else None
        c = flex_cast(name, kind, True) if kind else flex_cast(name, "string")
        return c.alias("lp_type" if name == "type" else name)

    return {table: df.select(*map(typed, df.columns)) for table, df in raw.items()}


# Codes of sale and use transactions and of media, and the names that the data model gives them.


def sale_action() -> Column:
    kind = F.col("sale_transaction_type")
    return classify([(kind.isin(1, 3), "Activate"), (kind.isin(2, 4), "Add"), (kind == 0, "New"), (kind == 5, "Purchase"), (kind == 6, "Other")], "Unknown action type")


def use_action() -> Column:
    use, kind = F.col("use_type"), F.col("use_transaction_type")
    return classify([(use.isin(9, 12), "Enter"), (use.isin(10, 11), "Exit"), ((use == 1) & (kind == 1), "Transfer entrance"), (kind.isin(0, 1, 2), "Enter"), (kind == 3, "Exit"), (kind == 4, "Transfer entrance"), (kind == 5, "Transfer exit")], "Other")


def media() -> Column:
    kind = F.col("media_type_id")
    return classify([(kind.isin(4, 5), "Smart card or ticket"), (kind.isin(2, 3), "Magnetic-stripe card or ticket"), (kind == 7, "Cash or coins")], "Other type")


def fare_transactions_card(sale: DataFrame, use: DataFrame, instruments: DataFrame | None = None) -> DataFrame:
    """Sales and uses in one shape; ``instruments`` (fare_instrument_id, fare_product) is a small, optional list."""

    def shaped(df: DataFrame, action: Column, source: str, riders: str, stop: Column) -> DataFrame:
        return df.select(
            F.col("rowid").alias("_row_id"), "transaction_id", "service_date", F.col("transaction_dtm").alias("event_timestamp"), F.col("sv_transaction").alias("amount"), action.alias("fare_action"), F.col("bus_id").alias("vehicle_id"),
            F.col("run_id").alias("trip_id_performed"), F.col("route_id").alias("pattern_id"), stop.cast("string").alias("stop_id"), F.col(riders).alias("num_riders"), media().alias("fare_media_id"), F.lit(False).alias("fare_capped"),
            F.col("serial_nbr").alias("token_id"), F.col("sv_remaining").alias("balance"), "device_id", "fare_instrument_id", F.lit("USD").alias("currency_type"), F.lit(source).alias("source_system"),
        )

    rows = union_all(shaped(sale, sale_action(), "FARE_SALE", "quantity", F.lit(None)), shaped(use, use_action(), "FARE_USE", "riders", F.col("stop_point_id")))
    rows = rows.join(instruments.select("fare_instrument_id", "fare_product"), "fare_instrument_id", "left") if instruments is not None else rows.withColumn("fare_product", F.lit(None).cast("string"))
    rows = rows.withColumn("fare_product", F.coalesce("fare_product", F.lit("Unknown fare product"))).drop("fare_instrument_id")
    return rows.withColumn("_key", surrogate_key("device_id", "source_system", "transaction_id", "event_timestamp", "fare_action"))


def open_payment_with_transfers(fares: DataFrame, transfers: DataFrame, connections: DataFrame, taps: DataFrame, zone: str = ZONE) -> DataFrame:
    """Boarded and alighted taps with their transfer or connection.

    Of a tap's copies the most complete and newest stays; of its transfers, one that it ends.
    """
    gaps = [F.coalesce(F.col("location_name") == "", F.lit(True)), *(F.col(c).isNull() for c in ("location_name", "location_id", "device_id", "lp_type"))]
    taps = keep_first(taps, ["vendor_2_transaction_id"], [*(g.cast("int") for g in gaps), F.desc("record_updated_timestamp_utc")], "location_id")
    rows = unpivot_roles(fares, {"boarded_vendor_2_txn_id": "boarded", "alighted_vendor_2_txn_id": "alighted"}, "vendor_2_transaction_id", "transaction_role")

    def linked(df: DataFrame, link: DataFrame, key: str, name: str) -> DataFrame:
        link = link.select(F.col("journey_id").alias("_j"), F.col("from_trip_id").alias("_from"), F.col("to_trip_id").alias("_to"), F.col(key).alias(f"{name}_id"))
        out = df.join(link, (df["journey_id"] == link["_j"]) & ((df["trip_id"] == link["_from"]) | (df["trip_id"] == link["_to"])), "left")
        return out.withColumn(f"{name}_trip_role", F.when(F.col("_from") == F.col("trip_id"), "from_trip").when(F.col("_to") == F.col("trip_id"), "to_trip")).drop("_j", "_from", "_to")

    rows = linked(linked(rows, transfers, "transfer_id", "transfer"), connections, "connection_id", "connection")
    ends = F.when(F.coalesce(F.col("transfer_trip_role") == "to_trip", F.lit(False)), 0).otherwise(1)
    rows = keep_first(rows, ["vendor_2_transaction_id"], [ends, F.asc_nulls_last("transfer_id")], "connection_id")
    rows = rows.withColumns({"has_transfer": F.col("transfer_id").isNotNull(), "has_connection": F.col("connection_id").isNotNull(), "has_adjustment": F.col("adjustment_amount") != 0})
    kind, changes = F.col("lp_type"), F.col("has_transfer") | F.col("has_connection")
    action = classify([(changes & (kind == "ON"), "Transfer entrance"), (changes & (kind == "OFF"), "Transfer exit"), (kind.isin("ON", "SINGLE"), "Enter"), (kind == "OFF", "Exit")])
    same = [c for c in taps.columns if c in rows.columns and c != "vendor_2_transaction_id"]
    out = rows.drop(*same).join(taps, "vendor_2_transaction_id")
    return out.withColumns({"transaction_type": kind, "fare_action": action, "service_date": service_date(utc_to_local("transaction_timestamp_utc", zone))})


def fare_transactions_open_payment(taps: DataFrame, payment_taps: DataFrame, payments: DataFrame, zone: str = ZONE) -> DataFrame:
    """Taps with their payments.  Flat and incomplete fares charge every tap, complete ones the exit."""
    pay = payments.select("micropayment_id", "charge_amount", "charge_type", "funding_source_id")
    rows = taps.join(payment_taps.select("vendor_2_transaction_id", "micropayment_id"), "vendor_2_transaction_id").join(pay, "micropayment_id")
    kind = F.col("charge_type")
    amount = F.when(kind.isin("flat_fare", "incomplete_variable_fare") | ((kind == "complete_variable_fare") & F.col("fare_action").isin(*EXIT)), F.col("charge_amount")).otherwise(0.0)
    local = utc_to_local("transaction_timestamp_utc", zone)
    return rows.select(
        F.col("vendor_2_transaction_id").alias("transaction_id"), service_date(local).alias("service_date"), local.alias("event_timestamp"), amount.alias("amount"), F.lit("USD").alias("currency_type"), "fare_action",
        F.col("route_id").alias("pattern_id"), F.col("location_id").alias("stop_id"), "device_id", F.lit(1.0).alias("num_riders"), F.lit("Bank card").alias("fare_media_id"), F.lit("Open Payment").alias("fare_product"), F.lit(False).alias("fare_capped"),
        F.col("funding_source_id").alias("token_id"), F.lit("vendor_2").alias("source_system"), "micropayment_id", "charge_type", "charge_amount",
    )


def fare_quality_card(txns: DataFrame) -> DataFrame:
    rows = flag_duplicates(txns, ["transaction_id", "service_date", "event_timestamp", "amount", "fare_action", "device_id", "source_system"], "_row_id")
    have = [(f"has_{c}", F.col(c).isNotNull(), f"Missing {c}") for c in ("transaction_id", "service_date", "event_timestamp", "amount", "fare_action")]
    return validity(rows, [*have, ("has_valid_fare_action", F.col("fare_action").isin(*ACTIONS), "Invalid fare_action"), ("has_valid_fare_media_id", F.col("fare_media_id").isin(*MEDIA), "Invalid fare_media_id"), ("dup_row_to_keep", F.col("is_keeper"), "Duplicate record")])


def fare_quality_open_payment(txns: DataFrame) -> DataFrame:
    """Duplicates by time and device; a complete variable fare must have one entry and one exit.

    Rows without a payment have no balance, so they are dealt out by themselves instead of meeting in one task.
    """
    alone = F.when(F.col("micropayment_id").isNull(), F.xxhash64("transaction_id", "event_timestamp", "device_id"))
    same, pay = Window.partitionBy("event_timestamp", "device_id"), Window.partitionBy("micropayment_id", alone)
    complete = F.coalesce(F.col("charge_type") == "complete_variable_fare", F.lit(False))
    count = lambda actions: F.count_if(complete & F.col("fare_action").isin(*actions)).over(pay)
    first = F.min("transaction_id").over(same)
    rows = txns.withColumns({"has_duplicates": F.count("*").over(same) > 1, "_first": F.coalesce(F.col("transaction_id") == first, F.lit(True)), "_in": count(ENTER), "_out": count(EXIT), "_any": F.bool_or(complete).over(pay) & F.col("micropayment_id").isNotNull()})
    # fixed values: the reasons that the data model names
    have = [(f"has_{c}", F.col(c).isNotNull(), f"Missing {c}") for c in ("transaction_id", "service_date", "event_timestamp", "fare_action", "micropayment_id")]
    bad = lambda cond: ~(F.col("_any") & cond)
    balance = [("one_entry", bad(F.col("_in") > 1), "Multiple entry records for complete variable fare"), ("one_exit", bad(F.col("_out") > 1), "Multiple exit records for complete variable fare"), ("has_entry", bad(F.col("_in") == 0), "No entry record for complete variable fare"), ("has_exit", bad(F.col("_out") == 0), "No exit record for complete variable fare")]
    return validity(rows, [*have, ("dup_row_to_keep", F.col("_first"), "Duplicate record"), *balance]).drop("_first", "_in", "_out", "_any")


def fare_transactions(card: DataFrame, open_payment: DataFrame) -> DataFrame:
    """Valid transactions of both systems, in the columns that both have."""
    both = [c for c in card.columns if c in open_payment.columns and not c.startswith(("has_", "is_", "dup_")) and c != "invalid_reason"]
    return union_all(keep_valid(card).select(*both), keep_valid(open_payment).select(*both))
