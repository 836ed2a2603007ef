"""Registered sources, sinks and loads: each writes tables derived from the given ones, reads them back and has its SQL."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.functions import keys
from wayfare.plans import checks
from wayfare.plans.catalog import c, day, query, table, text
from wayfare.sources import readers as r
from wayfare.sources import writers as w
from wayfare.streaming import incremental, streams

ZONE = "America/New_York"

# --- bundles and seeds ------------------------------------------------------------------


def feeds(s: SparkSession, d: str) -> DataFrame:
    """Schedule bundles (path, retrieved, content): one ZIP for each thousand order keys, made by Spark."""

    def bundle(rows: pd.DataFrame) -> pd.DataFrame:
        out, feed = io.BytesIO(), rows["feed"].iloc[0]
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("feed_info.txt", f"feed_version,feed_start_date\n{feed},19950101\n")
            z.writestr("stops.txt", rows.sort_values("o_orderkey")[["o_orderkey", "o_orderpriority"]].rename(columns={"o_orderkey": "stop_id", "o_orderpriority": "stop_name"}).to_csv(index=False))
        return pd.DataFrame({"path": [f"feed-{feed}"], "retrieved": [rows["o_orderdate"].min()], "content": [out.getvalue()]})

    o = table(s, d, "orders").select(F.floor(c("o_orderkey") / 1000).alias("feed"), "o_orderkey", "o_orderpriority", "o_orderdate")
    return o.groupBy("feed").applyInPandas(bundle, "path string, retrieved timestamp, content binary")


FEEDS = "WITH o AS (SELECT *, 'feed-' || (o_orderkey // 1000) AS source, o_orderkey // 1000 AS feed FROM orders)"


@query("SRC-4_read_feed_bundles", "SELECT CAST(o_orderkey AS VARCHAR) AS stop_id, o_orderpriority AS stop_name, CAST(NULL AS VARCHAR) AS stop_lat FROM orders")
def read_feed_bundles(s, d):
    return r.bundle_tables(r.parse_bundles(feeds(s, d)), {"stops": ["stop_id", "stop_name", "stop_lat"]})["stops"].drop("feed_hash")


@query("SRC-5_new_bundles", FEEDS + " SELECT DISTINCT source FROM o WHERE feed % 2 = 1")
def new_bundles(s, d):
    meta = r.feed_metadata(r.parse_bundles(feeds(s, d)), ZONE)
    number = F.substring("source", 6, 20).cast("bigint")
    return r.new_bundles(meta, meta.where(number % 2 == 0)).select("source")


@query("SRC-6_feed_metadata", FEEDS + f" SELECT source, strftime(min(o_orderdate) AT TIME ZONE 'UTC' AT TIME ZONE '{ZONE}', '%Y-%m-%d %H:%M:%S') AS date_retrieved FROM o GROUP BY 1")
def feed_metadata(s, d):
    return r.feed_metadata(r.parse_bundles(feeds(s, d)), ZONE).select("source", text("date_retrieved").alias("date_retrieved"))


@query("SRC-7_read_seed", "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def read_seed(s, d):
    path = w.scratch(s)
    table(s, d, "nation").select("n_nationkey", "n_name").write.csv(path, header=True)
    seed = r.read_seed(s, path, "n_nationkey long, n_name string")
    return table(s, d, "customer").join(seed, c("c_nationkey") == c("n_nationkey")).select("c_custkey", "n_name")


# --- sinks --------------------------------------------------------------------------------

ORDERS = "SELECT o_orderkey AS k, o_orderstatus AS status, o_totalprice AS price, strftime(o_orderdate, '%Y-%m-%d') AS placed FROM orders"


def orders(s, d) -> DataFrame:
    return table(s, d, "orders").select(c("o_orderkey").alias("k"), c("o_orderstatus").alias("status"), c("o_totalprice").alias("price"), c("o_orderdate").alias("placed"))


def dearer(df: DataFrame) -> DataFrame:
    return df.withColumn("price", c("price") + 1)


def shown(df: DataFrame) -> DataFrame:
    return df.select("k", "status", "price", F.date_format("placed", "yyyy-MM-dd").alias("placed"))


def raised(where: str) -> str:
    return f"SELECT k, status, CASE WHEN {where} THEN price + 1 ELSE price END AS price, placed FROM ({ORDERS})"


def held(s, d, by: str | None = None, transform: str = "month") -> tuple[DataFrame, str]:
    """Orders, and a new table of them; ``by`` is the column that it is partitioned by."""
    target, o = w.scratch(s), orders(s, d)
    w.create_partitioned(o, target, by, transform) if by else w.write(o, target)
    return o, target


@query("SNK-1_append", ORDERS)
def append(s, d):
    target, o = w.scratch(s), orders(s, d)
    for part in (o.where("k % 2 = 0"), o.where("k % 2 = 1")):
        w.append(part, target)
    return shown(w.stored(s, target))


@query("SNK-2_replace_by_value", raised("status = 'O'"))
def replace_by_value(s, d):
    o, target = held(s, d, "status", "identity")
    w.write(dearer(o.where("status = 'O'")), target, strategy="identity_equals", col="status", value="O")
    return shown(w.stored(s, target))


@query("SNK-2_replace_feed", "SELECT o_orderkey AS k, o_totalprice + CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END AS price, o_orderpriority AS _feed_hash FROM orders WHERE o_orderpriority <> '1-URGENT'")
def replace_feed(s, d):
    """A table by ``_feed_hash``: one feed comes anew, another one is taken back and leaves nothing."""
    o, target = orders(s, d).select("k", "price").join(table(s, d, "orders").select(c("o_orderkey").alias("k"), c("o_orderpriority").alias("_feed_hash")), "k"), w.scratch(s)
    w.create_partitioned(o, target, "_feed_hash")
    w.write(dearer(o.where("_feed_hash = '2-HIGH'")), target, strategy="identity_equals", col="_feed_hash", value="2-HIGH")
    w.write(o.limit(0), target, strategy="identity_equals", col="_feed_hash", value="1-URGENT")
    return w.stored(s, target)


@query("SNK-3_emptied_day", f"SELECT * FROM ({ORDERS}) WHERE placed <> '1995-03-15' AND NOT (placed >= '1996-02-01' AND placed < '1996-03-01')")
def emptied_day(s, d):
    """A day and a month for which nothing came."""
    o, target = held(s, d, "placed", "day")
    w.write(o.limit(0), target, strategy="date_equals", col="placed", value="1995-03-15")
    w.write(o.limit(0), target, strategy="time_between", col="placed", start="1996-02-01", end="1996-03-01")
    return shown(w.stored(s, target))


@query("SNK-3_replace_by_day", raised("placed = '1995-03-15'"))
def replace_by_day(s, d):
    o, target = held(s, d)
    w.write(dearer(o.where(day("placed") == "1995-03-15")), target, strategy="date_equals", col="placed", value="1995-03-15")
    return shown(w.stored(s, target))


@query("SNK-4_replace_by_window", raised("placed >= '1995-01-10' AND placed < '1995-02-20'"))
def replace_by_window(s, d):
    o, target = held(s, d, "placed")
    inside = (c("placed") >= "1995-01-10") & (c("placed") < "1995-02-20")
    w.write(dearer(o.where(inside)), target, strategy="time_between", col="placed", start="1995-01-10", end="1995-02-20")
    return shown(w.stored(s, target))


@query("SNK-5_replace_all", raised("TRUE"))
def replace_all(s, d):
    o, target = held(s, d, "placed", "year")
    w.write(dearer(o), target, strategy="full")
    return shown(w.stored(s, target))


@query("SNK-6_create_partitioned", "SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m') AS placed_month FROM orders")
def create_partitioned(s, d):
    return w.stored(s, held(s, d, "placed")[1]).select("k", "placed_month")


@query("SNK-7_check_schema", "SELECT o_orderkey AS k, CAST(NULL AS DOUBLE) AS price FROM orders")
def check_schema(s, d):
    o, target = held(s, d)
    w.write(o.drop("price"), target, strategy="full")
    return w.stored(s, target).select("k", "price")


@query("SNK-8_write_partition", raised("status = 'F'"))
def write_partition(s, d):
    target, o = w.scratch(s), orders(s, d)
    for status in ("F", "O", "P"):
        w.write_partition(o.where(c("status") == status), target, "status", status)
    w.write_partition(dearer(o.where("status = 'F'")).drop("status"), target, "status", "F")
    return shown(w.stored(s, target))


@query("SNK-8_emptied_partition", f"SELECT * FROM ({ORDERS}) WHERE status <> 'P'")
def emptied_partition(s, d):
    target, o = w.scratch(s), orders(s, d)
    for status in ("F", "O", "P"):
        w.write_partition(o.where(c("status") == status), target, "status", status)
    w.write_partition(o.limit(0), target, "status", "P")
    return shown(w.stored(s, target))


@query("SNK-9_normalise_types", "SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS nothing FROM orders")
def normalise_types(s, d):
    return w.normalise_types(orders(s, d).select("k", "status", F.lit(None).alias("nothing")), force_string=True)


@query("SNK-10_write_report", "SELECT count(*) FILTER (o_orderstatus = 'O' AND o_totalprice > 1000) AS n_written, count(*) FILTER (o_orderstatus = 'O') AS n_replaced, 'identity_equals' AS strategy FROM orders")
def write_report(s, d):
    o, target = held(s, d)
    report = w.write(o.where("status = 'O' and price > 1000"), target, strategy="identity_equals", col="status", value="O")
    return s.createDataFrame([(report.rows, report.replaced, report.strategy)], "n_written long, n_replaced long, strategy string")


def drained(stream: DataFrame, target: str, put: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    q = stream.writeStream.outputMode(mode).foreachBatch(put).option("checkpointLocation", f"{target}.checkpoint").trigger(availableNow=True).start()
    q.awaitTermination()


def streamed(s: SparkSession, d: str, name: str) -> DataFrame:
    """A table as a stream; times are instants, which watermarks need."""
    stream = s.readStream.schema(table(s, d, name).schema).parquet(f"{d}/{name}.parq*")
    return stream.withColumns({x: c(x).cast("timestamp") for x, kind in stream.dtypes if kind == "timestamp_ntz"})


@query("SNK-11_stream_replace", f"SELECT k, status, price, placed FROM ({ORDERS}) UNION ALL SELECT k, status, price + 1, placed FROM ({ORDERS}) WHERE k % 3 = 0")
def stream_replace(s, d):
    """An old load's table; then a stream whose first batch replaces it and whose second, given twice, adds to it."""
    o, target = held(s, d, "status", "identity")
    later = dearer(o.where("k % 3 = 0"))

    def put(batch: DataFrame, n: int) -> None:
        first = batch.select(c("o_orderkey").alias("k"), c("o_orderstatus").alias("status"), c("o_totalprice").alias("price"), c("o_orderdate").alias("placed"))
        w.stream_replace(first, n, target, "status", "day")

    drained(streamed(s, d, "orders"), target, put)
    for _ in range(2):
        w.stream_replace(later, 1_000_000, target, "status", "day")
    return shown(w.stored(s, target))


@query("SNK-11_stream_two_loads", f"SELECT k, status, CASE WHEN status = 'F' THEN price + 1 ELSE price END AS price, placed FROM ({ORDERS}) WHERE status <> 'F' OR k % 5 = 0")
def stream_two_loads(s, d):
    """A second load, in two batches of one window with prices as texts, replaces what the first one left there."""
    o, target = orders(s, d), w.scratch(s)
    w.stream_replace(o, 0, target, "status", "first")
    again = dearer(o.where("status = 'F' and k % 5 = 0")).withColumn("price", c("price").cast("string"))
    for n, part in enumerate((again.where("k % 2 = 0"), again.where("k % 2 = 1"), again.where("k % 2 = 1"))):
        w.stream_replace(part, min(n, 1), target, "status", "first.next")
    return shown(w.stored(s, target))


@query("SNK-12_compact", ORDERS)
def compact(s, d):
    target = w.scratch(s)
    for i in range(3):
        w.append(orders(s, d).where(c("k") % 3 == i), target)
    w.compact(s, target)
    return shown(w.stored(s, target))


@query("SNK-13_truncate", f"SELECT * FROM ({ORDERS}) WHERE status = 'O'")
def truncate(s, d):
    o, target = held(s, d, "placed", "year")
    w.truncate(s, target)
    w.append(o.where("status = 'O'"), target)
    return shown(w.stored(s, target))


@query("F-20_table_name", "SELECT o_orderkey AS k, o_orderstatus AS status FROM orders")
def table_name(s, d):
    name = keys.table_name("dev", "orders_by_status")
    orders(s, d).createOrReplaceTempView(name)
    return r.read_table(s, "dev_orders_by_status", ["k", "status"])


@query("Q-24_written_count", "SELECT count(*) + count(*) FILTER (o_orderstatus = 'O') AS n_stored, count(*) AS n_reported FROM orders HAVING n_stored <> n_reported")
def written_count(s, d):
    o, target = held(s, d, "status", "identity")
    n = w.write(o, target, strategy="full").rows
    w.append(o.where("status = 'O'"), target)
    return checks.written_count(w.stored(s, target), F.lit(True), n)


# --- loads --------------------------------------------------------------------------------

EVENTS = "WITH e AS (SELECT *, CAST(ts AS DATE) AS service_date FROM events)"


def events(s, d) -> DataFrame:
    return table(s, d, "events").withColumn("service_date", day("ts"))


def per_day(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Events a day, and those of known customers."""
    known = customers.select(c("c_custkey").alias("user_id"), F.lit(1).alias("known")).distinct()
    return events.join(known, "user_id", "left").groupBy("service_date").agg(F.count("*").alias("n"), F.count("known").alias("n_known"))


def days(s, target: str) -> DataFrame:
    return s.read.parquet(target).select(c("service_date").cast("string").alias("service_date"), "n", "n_known")


PER_DAY = "SELECT strftime(service_date, '%Y-%m-%d') AS service_date, count(*) AS n, count(*) FILTER (user_id IN (SELECT c_custkey FROM customer)) AS n_known FROM e WHERE {} GROUP BY 1"


@query("ST-1_incremental_by_day", EVENTS + PER_DAY.format("service_date >= DATE '2024-01-07' AND service_date < DATE '2024-01-12'"))
def incremental_by_day(s, d):
    target = w.scratch(s)
    inputs = {"events": (events(s, d), True), "customers": (table(s, d, "customer"), False)}
    for _ in range(2):  # the second run changes nothing
        incremental.incremental_overwrite(per_day, inputs, target, "service_date", date(2024, 1, 10), date(2024, 1, 12), per_day=True)
    return days(s, target)


@query("ST-1_emptied_day", EVENTS + PER_DAY.format("service_date >= DATE '2024-01-05' AND service_date < DATE '2024-01-15' AND service_date NOT IN (DATE '2024-01-08', DATE '2024-01-09')"))
def emptied_days(s, d):
    """Two days that a correction took back: the load that runs again leaves them empty, once over all days, once a day at a time."""
    target, customers = w.scratch(s), (table(s, d, "customer"), False)
    span = {"start": date(2024, 1, 5), "end": date(2024, 1, 15), "lookback_days": 0}
    for taken, singly in (("", False), ("2024-01-08", False), ("2024-01-09", True)):
        left = events(s, d).where(~c("service_date").cast("string").between("2024-01-08", taken))
        incremental.incremental_overwrite(per_day, {"events": (left, True), "customers": customers}, target, "service_date", per_day=singly, **span)
    return days(s, target)


LATE = "CASE WHEN service_date < DATE '2024-01-12' THEN event_id % 10 <> 0 ELSE TRUE END AND service_date >= DATE '2024-01-05' AND service_date < DATE '2024-01-20'"


@query("ST-2_look_back", EVENTS + PER_DAY.format(LATE))
def look_back(s, d):
    """A first load without late events; a second one reaches three days back, and no further, for them."""
    target, customers = w.scratch(s), (table(s, d, "customer"), False)
    early = events(s, d).where("event_id % 10 <> 0")
    incremental.incremental_overwrite(per_day, {"events": (early, True), "customers": customers}, target, "service_date", date(2024, 1, 5), date(2024, 1, 15), lookback_days=0)
    incremental.incremental_overwrite(per_day, {"events": (events(s, d), True), "customers": customers}, target, "service_date", date(2024, 1, 15), date(2024, 1, 20))
    return days(s, target)


@query("ST-3_windowed_inputs", EVENTS + " SELECT event_id, c_custkey IS NOT NULL AS known FROM e LEFT JOIN customer ON user_id = c_custkey WHERE service_date >= DATE '2024-01-08' AND service_date < DATE '2024-01-10'")
def windowed_inputs(s, d):
    cut = incremental.windowed_inputs({"events": (events(s, d), True), "customers": (table(s, d, "customer"), False)}, "service_date", date(2024, 1, 8), date(2024, 1, 10))
    return cut["events"].join(cut["customers"].select("c_custkey"), c("user_id") == c("c_custkey"), "left").select("event_id", c("c_custkey").isNotNull().alias("known"))


@query("ST-5_rolling_window", EVENTS + " SELECT event_id FROM e WHERE service_date >= DATE '2024-01-12' AND service_date < DATE '2024-01-20'")
def rolling_window(s, d):
    low, high = incremental.rolling_window(date(2024, 1, 20))
    return events(s, d).where((c("service_date") >= F.lit(low)) & (c("service_date") < F.lit(high))).select("event_id")


@query("ST-6_window_from_key", EVENTS + " SELECT event_id FROM e WHERE service_date >= DATE '2024-01-05' AND service_date < DATE '2024-01-09'")
def window_from_key(s, d):
    low, high = incremental.window_from_key("2024-01-05/2024-01-09", date(2024, 1, 20))
    return events(s, d).where((c("service_date") >= F.lit(low)) & (c("service_date") < F.lit(high))).select("event_id")


@query("ST-10_backfill", EVENTS + PER_DAY.format("TRUE"))
def backfill(s, d):
    """All days in one run, then a range of them again in one run a day."""
    target = w.scratch(s)
    inputs = {"events": (events(s, d), True), "customers": (table(s, d, "customer"), False)}
    first, last = events(s, d).agg(F.min("service_date"), F.date_add(F.max("service_date"), 1)).first()
    incremental.incremental_overwrite(per_day, inputs, target, "service_date", first, last, lookback_days=0)
    incremental.incremental_overwrite(per_day, inputs, target, "service_date", date(2024, 1, 8), date(2024, 1, 10), lookback_days=0, per_day=True)
    return days(s, target)


#: Rows of a file in a stream's batches.
A_FILE = 500_000


def streamed_batches(s: SparkSession, d: str) -> DataFrame:
    """Events as a stream of three batches by time, a tenth of them a batch too late and a tenth too early; rows of later years let the watermark pass all."""
    folder, e = w.scratch(s), table(s, d, "events").select("event_id", "user_id", "event_type", "value", c("ts").cast("timestamp").alias("ts"))
    first, last = e.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    third = F.floor((F.unix_micros("ts") - first) * 3 / (last - first + 1)) + F.when(c("event_id") % 10 == 0, 1).when(c("event_id") % 10 == 1, -1).otherwise(0)
    third = F.least(F.greatest(third, F.lit(0)), F.lit(2))
    # each batch is as many files, so that no task writes or reads a batch alone
    counts = [n for _, n in e.groupBy(third).count().collect()]
    files = min(counts) // A_FILE + 1 if len(counts) == 3 else 1
    for n in range(3):
        batch = e.where(third == n)
        (batch.repartition(files) if files > 1 else batch.coalesce(1)).write.mode("append").parquet(folder)
    for years in (1, 2):
        end = F.timestamp_micros(F.lit(last)) + F.make_interval(years=F.lit(years))
        s.range(0, files, 1, files).select(F.lit(0).cast("long").alias("event_id"), F.lit(0).cast("long").alias("user_id"), F.lit("end").alias("event_type"), F.lit(0.0).alias("value"), end.alias("ts")).write.mode("append").parquet(folder)
    return s.readStream.schema(e.schema).option("maxFilesPerTrigger", files).parquet(folder)


def given(s: SparkSession, stream: DataFrame, ts: str) -> DataFrame:
    """What a stream gives in append mode over all batches, without the rows of later years."""
    target = w.scratch(s)
    drained(stream, target, lambda batch, n: batch.write.mode("overwrite").parquet(f"{target}/batch={n}"))
    return s.read.schema(stream.schema).parquet(target).where(F.year(ts) == 2024)


#: Rows come up to two thirds of the tables' month late.
LATENESS = "25 days"


def first_events(s, d):
    return given(s, streams.stream_first_seen(streamed_batches(s, d), ["user_id", "event_type"], "ts", "event_id", LATENESS), "ts")


@query("ST-7_stream_first_seen", "SELECT DISTINCT user_id, event_type FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL")
def stream_first_seen(s, d):
    return first_events(s, d).select("user_id", "event_type")


@query("ST-7_stream_first_event", "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL) WHERE n = 1")
def stream_first_event(s, d):
    """The first event, which is often not the first to arrive."""
    return first_events(s, d).select("user_id", "event_type", "event_id")


@query("ST-8_stream_hourly", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY 1, 2")
def stream_hourly(s, d):
    """In update mode into a table by day: each batch puts the figures of the hours that it touched."""
    target = w.scratch(s)
    hours = streams.stream_hourly(streamed_batches(s, d), "ts", ["event_type"], LATENESS, ("value",))
    drained(hours, target, streams.hourly_to(target, ["event_type"], "live"), "update")
    return w.stored(s, target).where(F.year("hour") == 2024).select(text("hour").alias("hour"), "event_type", "n", F.round("value", 4).alias("value"))


STREAM_SESSIONS = """WITH e AS (SELECT user_id, {} AS moment, event_id FROM events),
g AS (SELECT *, CASE WHEN lag(moment) OVER w IS NULL OR epoch_us(moment) - epoch_us(lag(moment) OVER w) >= 3600000000 THEN 1 ELSE 0 END AS fresh FROM e WINDOW w AS (PARTITION BY user_id ORDER BY moment, event_id)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY moment, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, count(*) AS n, {} AS session_start, {} AS session_end FROM n GROUP BY user_id, session"""
SECONDS = [f"strftime({x}(moment), '%Y-%m-%d %H:%M:%S')" for x in ("min", "max")]


@query("ST-9_stream_sessions", STREAM_SESSIONS.format("date_trunc('second', ts)", *SECONDS))
def stream_sessions(s, d):
    seconds = streamed_batches(s, d).select("user_id", F.date_trunc("second", "ts").alias("moment"))
    out = given(s, streams.stream_sessions(seconds, ["user_id"], "moment", watermark=LATENESS), "session_start")
    return out.select("user_id", "n", text("session_start").alias("session_start"), text("session_end").alias("session_end"))


@query("ST-9_exact_sessions", STREAM_SESSIONS.format("ts", "epoch_us(min(moment))", "epoch_us(max(moment))"))
def exact_sessions(s, d):
    """Sessions to the microsecond."""
    out = given(s, streams.stream_sessions(streamed_batches(s, d).select("user_id", "ts"), ["user_id"], "ts", watermark=LATENESS), "session_start")
    return out.select("user_id", "n", F.unix_micros("session_start").alias("session_start"), F.unix_micros("session_end").alias("session_end"))
