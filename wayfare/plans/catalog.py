"""Registered queries: each operator on the given tables, next to its SQL.

The tables hold no transit records, so they stand in for them: ``events`` for pings
(user: vehicle, type: stop, value: load), ``orders`` for versions and transactions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from wayfare.functions import casts, keys, places, times
from wayfare.operators import aggregates as a
from wayfare.operators import joins as j
from wayfare.operators import select as p
from wayfare.operators import sets as u
from wayfare.operators import windows as w
from wayfare.sources import readers as r

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
c = F.col


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql:
            SQL[key] = sql
        return fn

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: c(n).cast("bigint") for n in names})


def day(col: str) -> Column:
    return c(col).cast("date")


def text(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


# --- sources -----------------------------------------------------------------


@query("SRC-1_read_window", "SELECT event_id, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12'")
def read_window(s, d):
    return r.read_window(table(s, d, "events"), ["event_id", "user_id", "event_type"], "ts", "2024-01-05", "2024-01-12")


@query("SRC-2_read_by_date_key", """
WITH cal AS (SELECT DISTINCT CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_key, CAST(o_orderdate AS DATE) AS dateday FROM orders)
SELECT o_orderkey, strftime(cal.dateday, '%Y-%m-%d') AS service_date FROM orders JOIN cal ON CAST(strftime(o_orderdate, '%Y%m%d') AS INT) = cal.date_key
WHERE cal.dateday BETWEEN DATE '1995-01-01' AND DATE '1995-03-31'""")
def read_by_date_key(s, d):
    orders = table(s, d, "orders").withColumn("key", F.date_format("o_orderdate", "yyyyMMdd").cast("int"))
    cal = orders.select(c("key").alias("date_key"), day("o_orderdate").alias("dateday")).distinct()
    return r.read_by_date_key(orders, cal, "key", "date_key", "dateday", "1995-01-01", "1995-03-31").select("o_orderkey", c("service_date").cast("string").alias("service_date"))


@query("SRC-3_read_equals", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def read_equals(s, d):
    return r.read_equals(table(s, d, "customer"), ["c_custkey", "c_name"], "c_mktsegment", "BUILDING")


@query("SRC-8_read_table", "SELECT p_partkey, p_brand FROM part")
def read_table(s, d):
    return r.read_table(s, f"{d}/part.parquet", ["p_partkey", "p_brand"])


@query("SRC-9_inline", "SELECT n.n_name, m.label FROM nation n JOIN (VALUES (0, 'first'), (1, 'second')) m(k, label) ON n.n_regionkey = m.k")
def inline(s, d):
    rows = r.inline(s, [(0, "first"), (1, "second")], "k int, label string")
    n = table(s, d, "nation")
    return n.join(rows, n.n_regionkey == rows.k).select("n_name", "label")


@query("SRC-10_date_spine", """
SELECT strftime(g.d, '%Y-%m-%d') AS service_date, count(o_orderkey) AS n FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '1995-12-31', INTERVAL 1 DAY)) AS d) g
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(g.d AS DATE) GROUP BY ALL""")
def date_spine(s, d):
    spine = r.date_spine(s, "1995-01-01", "1996-01-01")
    o = table(s, d, "orders").withColumn("date", day("o_orderdate"))
    return spine.join(o, "date", "left").groupBy(c("date").cast("string").alias("service_date")).agg(F.count("o_orderkey").alias("n"))


# --- projections and filters ---------------------------------------------------


@query("P-1_stage", "SELECT event_id AS ping_id, CAST(user_id AS VARCHAR) AS vehicle_id, TRY_CAST(nullif(trim(event_type), '') AS INT) AS code, CAST(value AS DOUBLE) AS load FROM events")
def stage(s, d):
    return p.stage(table(s, d, "events"), [("event_id", "ping_id", "bigint", False), ("user_id", "vehicle_id", "string", False), ("event_type", "code", "int", True), ("value", "load", "double", True)])


@query("P-2_select_except", "SELECT * EXCLUDE (c_acctbal, c_mktsegment) FROM customer")
def select_except(s, d):
    return p.select_except(table(s, d, "customer"), ["c_acctbal", "c_mktsegment"])


@query("P-3_conform", "SELECT s_name, CAST(s_suppkey AS VARCHAR) AS s_suppkey, CAST(NULL AS DOUBLE) AS speed FROM supplier")
def conform(s, d):
    return p.conform(table(s, d, "supplier"), StructType([StructField("s_name", StringType()), StructField("s_suppkey", StringType()), StructField("speed", DoubleType())]))


@query("P-4_classify", "SELECT p_partkey, CASE WHEN p_type LIKE 'PROMO%' THEN 'promo' WHEN p_size IN (1, 2, 3) THEN 'small' WHEN p_size > 40 THEN 'large' ELSE 'other' END AS kind FROM part")
def classify(s, d):
    rules = [(c("p_type").like("PROMO%"), "promo"), (c("p_size").isin(1, 2, 3), "small"), (c("p_size") > 40, "large")]
    return table(s, d, "part").select("p_partkey", p.classify(rules, "other").alias("kind"))


@query("P-5_time_period", """
SELECT event_id, CASE WHEN isodow(ts) >= 6 THEN 'Weekend' WHEN hour(ts) BETWEEN 4 AND 6 THEN 'Early Morning' WHEN hour(ts) BETWEEN 7 AND 8 THEN 'AM Peak'
WHEN hour(ts) BETWEEN 9 AND 15 THEN 'Midday' WHEN hour(ts) BETWEEN 16 AND 17 THEN 'PM Peak' WHEN hour(ts) BETWEEN 18 AND 21 THEN 'Evening' ELSE 'Late Night' END AS period FROM events""")
def time_period(s, d):
    return table(s, d, "events").select("event_id", times.time_period(F.hour("ts"), day("ts")).alias("period"))


@query("P-6_redact", "SELECT o_orderkey, sha1(CAST(o_custkey AS VARCHAR) || strftime(o_orderdate, '%Y-%m-%d')) AS o_custkey FROM orders")
def redact(s, d):
    return p.redact(table(s, d, "orders"), ["o_custkey"], "o_orderdate", ["o_orderkey"])


@query("P-7_keep_valid", "SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND CASE WHEN o_orderstatus = 'P' THEN NULL ELSE TRUE END")
def keep_valid(s, d):
    flag = (c("o_totalprice") > 100000) & F.when(c("o_orderstatus") == "P", None).otherwise(True)
    return p.keep_valid(table(s, d, "orders").withColumn("is_valid", flag)).select("o_orderkey")


@query("P-8_differs", "SELECT event_id FROM events WHERE CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END IS DISTINCT FROM 'click'")
def differs(s, d):
    return table(s, d, "events").where(keys.differs(F.when(c("event_id") % 5 != 0, c("event_type")), F.lit("click"))).select("event_id")


@query("P-9_not_in_or_null", "SELECT event_id FROM events WHERE (CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END) NOT IN ('click', 'view') OR event_id % 5 = 0")
def not_in_or_null(s, d):
    return table(s, d, "events").where(keys.not_in_or_null(F.when(c("event_id") % 5 != 0, c("event_type")), ["click", "view"])).select("event_id")


@query("P-10_recent", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-06-17' - 30 AND DATE '1995-06-17'")
def recent(s, d):
    return p.recent(table(s, d, "orders"), "o_orderdate", "1995-06-17", 30).select("o_orderkey")


# --- joins ---------------------------------------------------------------------


@query("J-1_inner", "SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def inner(s, d):
    o = table(s, d, "orders").withColumnRenamed("o_orderkey", "l_orderkey").select("l_orderkey", "o_orderstatus")
    return j.inner(table(s, d, "lineitem").select("l_orderkey", "l_linenumber"), o, ["l_orderkey"])


@query("J-2_left", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
def left(s, d):
    o = table(s, d, "orders").select(c("o_custkey").alias("c_custkey"), "o_orderkey")
    return j.left(table(s, d, "customer").select("c_custkey"), o, ["c_custkey"])


@query("J-3_override", """
WITH b AS (SELECT o_custkey AS k, min(o_orderstatus) AS v FROM orders WHERE o_custkey % 3 <> 0 GROUP BY 1), e AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 4 = 0)
SELECT coalesce(b.k, e.k) AS k, coalesce(e.v, b.v) AS v FROM b FULL OUTER JOIN e ON b.k = e.k""")
def override(s, d):
    base = table(s, d, "orders").where("o_custkey % 3 <> 0").groupBy(c("o_custkey").alias("k")).agg(F.min("o_orderstatus").alias("v"))
    return j.override(base, table(s, d, "customer").where("c_custkey % 4 = 0").select(c("c_custkey").alias("k"), c("c_mktsegment").alias("v")), ["k"], "v")


@query("J-4_expand_ranges", "SELECT o_orderkey, strftime(unnest(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INT), INTERVAL 1 DAY)), '%Y-%m-%d') AS service_date FROM orders")
def expand_ranges(s, d):
    o = table(s, d, "orders").select("o_orderkey", day("o_orderdate").alias("a"), F.date_add(day("o_orderdate"), (c("o_orderkey") % 4).cast("int")).alias("b"))
    return j.expand_ranges(o, "a", "b", "day").select("o_orderkey", c("day").cast("string").alias("service_date"))


# a point takes the versions of its own key only
VERSIONS = """WITH v AS (SELECT o_custkey AS k, o_orderkey AS version, CAST(o_orderdate AS DATE) AS a,
  coalesce(lead(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE), o_orderkey), CAST(o_orderdate AS DATE) + 90) AS b FROM orders),
p AS (SELECT c_custkey AS point, c_custkey AS k, CAST(DATE '1995-01-01' + CAST(c_custkey * 7 % 700 AS INT) AS DATE) AS day FROM customer)"""


def versions(s, d):
    o = table(s, d, "orders").select(c("o_custkey").alias("k"), c("o_orderkey").alias("version"), day("o_orderdate").alias("a"))
    points = table(s, d, "customer").select(c("c_custkey").alias("point"), c("c_custkey").alias("k"), F.date_add(F.lit("1995-01-01").cast("date"), (c("c_custkey") * 7 % 700).cast("int")).alias("day"))
    return w.close_intervals(o, ["k"], "a", F.date_add("a", 90), "version", "b"), points


@query("J-5_match_ranges", VERSIONS + " SELECT point, version FROM p JOIN v ON p.k = v.k AND day BETWEEN a AND b")
@query("J-5_match_ranges_whole", VERSIONS + " SELECT point, version FROM p JOIN v ON p.k = v.k AND day BETWEEN a AND b")
def match_ranges(s, d):
    v, points = versions(s, d)
    return j.match_ranges(points, v, "day", "a", "b", ("k",)).select("point", "version")


@query("J-13_as_of_version", VERSIONS + """ SELECT point, version FROM (SELECT point, version, row_number() OVER (PARTITION BY point ORDER BY a DESC, version DESC) AS n FROM p JOIN v ON p.k = v.k AND day BETWEEN a AND b WHERE a <= day - 2) WHERE n = 1""")
@query("J-13_as_of_version_whole", VERSIONS + """ SELECT point, version FROM (SELECT point, version, row_number() OVER (PARTITION BY point ORDER BY a DESC, version DESC) AS n FROM p JOIN v ON p.k = v.k AND day BETWEEN a AND b WHERE a <= day - 2) WHERE n = 1""")
def as_of_version(s, d):
    v, points = versions(s, d)
    return j.as_of_version(points, v, ["point"], "day", "a", "b", [F.desc("a"), F.desc("version")], c("a") <= F.date_sub("day", 2), ("k",)).select("point", "version")


GEO = """WITH a AS (SELECT c_custkey AS ping, c_nationkey AS k, 38.9 + (c_custkey % 97) / 20000.0 AS lat, -77.0 + (c_custkey % 89) / 20000.0 AS lon, c_custkey % 7 AS seq FROM customer),
b AS (SELECT s_suppkey AS stop, s_nationkey AS k, 38.9 + (s_suppkey % 83) / 20000.0 AS s_lat, -77.0 + (s_suppkey % 79) / 20000.0 AS s_lon, s_suppkey % 7 AS s_seq FROM supplier),
m AS (SELECT a.*, b.stop, s_lat, s_lon, abs(seq - s_seq) + 1 AS f, 2 * 6371000.0 * asin(sqrt(pow(sin(radians(s_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(s_lat)) * pow(sin(radians(s_lon - lon) / 2), 2))) AS m
 FROM a LEFT JOIN b ON a.k = b.k AND lat BETWEEN s_lat - 300 / 111320.0 AND s_lat + 300 / 111320.0 AND lon BETWEEN s_lon - 300 / (111320.0 * cos(radians(s_lat))) AND s_lon + 300 / (111320.0 * cos(radians(s_lat))))"""


def geo(s, d):
    at = lambda k, m: (38.9 if m in (97, 83) else -77.0) + (c(k) % m) / 20000.0
    pings = table(s, d, "customer").select(c("c_custkey").alias("ping"), c("c_nationkey").alias("k"), at("c_custkey", 97).alias("lat"), at("c_custkey", 89).alias("lon"), (c("c_custkey") % 7).alias("seq"))
    stops = table(s, d, "supplier").select(c("s_suppkey").alias("stop"), c("s_nationkey").alias("k"), at("s_suppkey", 83).alias("s_lat"), at("s_suppkey", 79).alias("s_lon"), (c("s_suppkey") % 7).alias("s_seq"))
    return pings, stops


@query("J-6_within_box", GEO + " SELECT ping, stop FROM m")
def within_box(s, d):
    pings, stops = geo(s, d)
    return j.dealt_box(pings.drop("seq"), stops.drop("s_seq"), ["k"], ("lat", "lon"), ("s_lat", "s_lon")).select("ping", "stop")


@query("J-7_nearest", GEO + " SELECT ping, stop, round(w, 3) AS weighted FROM (SELECT ping, stop, m * f AS w, row_number() OVER (PARTITION BY ping ORDER BY m * f, f, stop) AS n FROM m) WHERE n = 1")
def nearest(s, d):
    pings, stops = geo(s, d)
    return j.nearest(pings, stops, ["k"], ("lat", "lon"), ("s_lat", "s_lon"), "ping", "stop", "stop", steps=F.abs(c("seq") - c("s_seq")), shared=True).select("ping", "stop", F.round("weighted", 3).alias("weighted"))


@query("J-8_join_any", """
WITH x AS (SELECT l_orderkey AS k, l_linenumber AS n, l_suppkey AS ref FROM lineitem), y AS (SELECT l_orderkey AS k, l_linenumber AS m, l_suppkey AS a, l_suppkey + 1 AS b FROM lineitem WHERE l_quantity > 25)
SELECT x.k, n, m FROM x LEFT JOIN y ON x.k = y.k AND (x.ref = y.a OR x.ref = y.b)""")
def join_any(s, d):
    line = table(s, d, "lineitem")
    x = line.select(c("l_orderkey").alias("k"), c("l_linenumber").alias("n"), c("l_suppkey").alias("ref"))
    y = line.where("l_quantity > 25").select(c("l_orderkey").alias("k"), c("l_linenumber").alias("m"), c("l_suppkey").alias("a"), (c("l_suppkey") + 1).alias("b"))
    return j.join_any(x, y, ["k"], "ref", ["a", "b"]).select("k", "n", "m")


@query("J-9_cross", "SELECT r_name, m FROM region, (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS m FROM orders)")
def cross(s, d):
    months = table(s, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("m")).distinct()
    return j.cross(months, table(s, d, "region").select("r_name"))


@query("J-10_flag_member", "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000) AS big FROM customer")
def flag_member(s, d):
    return j.flag_member(table(s, d, "customer").select("c_custkey"), table(s, d, "orders").where("o_totalprice > 300000"), "c_custkey", "o_custkey", "big")


@query("J-11_missing_from", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def missing_from(s, d):
    return j.missing_from(table(s, d, "customer").select("c_custkey"), table(s, d, "orders").select(c("o_custkey").alias("c_custkey")), ["c_custkey"])


@query("J-12_align_nth", """
WITH x AS (SELECT o_custkey AS k, o_orderkey AS a, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth FROM orders),
y AS (SELECT user_id AS k, event_id AS b, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth FROM events) SELECT k, nth, a, b FROM x LEFT JOIN y USING (k, nth)""")
def align_nth(s, d):
    x = table(s, d, "orders").select(c("o_custkey").alias("k"), c("o_orderkey").alias("a"), "o_orderdate")
    y = table(s, d, "events").select(c("user_id").alias("k"), c("event_id").alias("b"), "ts")
    return longs(j.align_nth(x, y, ["k"], ["o_orderdate", "a"], ["ts", "b"]).select("k", "nth", "a", "b"), "nth")


@query("J-14_with_group_stats", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey) AS n, min(o_totalprice) OVER (PARTITION BY o_custkey) AS least FROM orders")
def with_group_stats(s, d):
    return j.with_group_stats(table(s, d, "orders"), ["o_custkey"], n=F.count("*"), least=F.min("o_totalprice")).select("o_orderkey", "n", "least")


@query("J-15_map_code", "SELECT event_id, n_name FROM (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'x' ELSE CAST(user_id % 30 AS VARCHAR) END AS code FROM events) LEFT JOIN nation ON TRY_CAST(code AS INT) = n_nationkey")
def map_code(s, d):
    e = table(s, d, "events").select("event_id", F.when(c("event_id") % 9 == 0, "x").otherwise((c("user_id") % 30).cast("string")).alias("code"))
    return j.map_code(e, table(s, d, "nation"), "code", "n_nationkey", "int").select("event_id", "n_name")


@query("J-16_star", """
SELECT r_name, n_name, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def star(s, d):
    o = table(s, d, "orders").select(c("o_orderkey").alias("l_orderkey"), c("o_custkey").alias("c_custkey"))
    cu = table(s, d, "customer").select("c_custkey", c("c_nationkey").alias("n_nationkey"))
    n = table(s, d, "nation").select("n_nationkey", "n_name", c("n_regionkey").alias("r_regionkey"))
    f = j.star(table(s, d, "lineitem"), [(o, ["l_orderkey"]), (cu, ["c_custkey"]), (n, ["n_nationkey"]), (table(s, d, "region"), ["r_regionkey"])])
    return a.agg(f, ["r_name", "n_name"], n=F.count("*"), revenue=F.round(F.sum(c("l_extendedprice") * (1 - c("l_discount"))), 2))


# --- aggregates ------------------------------------------------------------------


@query("A-1_agg", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty, min(l_discount) AS lo, max(l_discount) AS hi FROM lineitem GROUP BY 1, 2")
def agg(s, d):
    return a.agg(table(s, d, "lineitem"), ["l_returnflag", "l_linestatus"], n=F.count("*"), qty=F.round(F.sum("l_quantity"), 2), lo=F.min("l_discount"), hi=F.max("l_discount"))


@query("A-2_count_distinct", "SELECT l_orderkey, count(DISTINCT l_suppkey) AS distinct_l_suppkey FROM lineitem GROUP BY 1")
def count_distinct(s, d):
    return a.count_distinct(table(s, d, "lineitem"), ["l_orderkey"], "l_suppkey")


@query("A-3_count_if", "SELECT o_custkey, count(*) FILTER (o_orderstatus = 'O') AS n_open FROM orders GROUP BY 1")
def count_if(s, d):
    return a.agg(table(s, d, "orders"), ["o_custkey"], n_open=F.count_if(c("o_orderstatus") == "O"))


@query("A-4_arg_extremes", "SELECT o_custkey, arg_min(o_orderkey, o_orderkey * 7919 % 10007 + o_orderkey / 1e9) AS a, arg_max(o_orderkey, o_orderkey * 7919 % 10007 + o_orderkey / 1e9) AS b FROM orders GROUP BY 1")
def arg_extremes(s, d):
    by = c("o_orderkey") * 7919 % 10007 + c("o_orderkey") / 1e9
    return a.agg(table(s, d, "orders"), ["o_custkey"], a=F.min_by("o_orderkey", by), b=F.max_by("o_orderkey", by))


@query("A-5_first_last_by", "SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_type, arg_max(event_type, (ts, event_id)) AS last_type FROM events GROUP BY 1")
def first_last_by(s, d):
    return a.agg(table(s, d, "events"), ["user_id"], first_type=a.first_by("event_type", "ts", "event_id"), last_type=a.last_by("event_type", "ts", "event_id"))


@query("A-6_any_of", "SELECT n_regionkey, min(n_name) AS one FROM nation GROUP BY 1")
def any_of(s, d):
    return a.agg(table(s, d, "nation"), ["n_regionkey"], one=a.any_of("n_name"))


@query("A-7_join_text", "SELECT p_brand, string_agg(DISTINCT p_type, ';' ORDER BY p_type) AS types, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_size, CAST(p_partkey AS VARCHAR)) AS parts FROM part GROUP BY 1")
def join_text(s, d):
    return a.agg(table(s, d, "part"), ["p_brand"], types=a.join_text("p_type", ";", distinct=True), parts=a.join_text("p_partkey", ",", order="p_size"))


@query("A-8_merge_priority", "SELECT o_custkey, arg_min(o_orderpriority, (CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 3 END, o_orderpriority)) AS worst, bool_or(o_orderstatus = 'O') AS any_open FROM orders GROUP BY 1")
def merge_priority(s, d):
    return a.agg(table(s, d, "orders"), ["o_custkey"], worst=a.merge_priority("o_orderpriority", ["1-URGENT", "2-HIGH"]), any_open=a.any_true(c("o_orderstatus") == "O"))


@query("A-9_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING n > 12")
def having(s, d):
    return a.agg(table(s, d, "orders"), ["o_custkey"], "n > 12", n=F.count("*"))


@query("A-10_distinct", "SELECT DISTINCT p_brand, p_size FROM part")
def distinct(s, d):
    return a.distinct(table(s, d, "part"), ["p_brand", "p_size"])


@query("A-11_mode", "SELECT user_id, event_type AS mode_event_type FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS n FROM events WHERE event_type IS NOT NULL GROUP BY 1, 2) WHERE n = 1")
def mode(s, d):
    return a.mode(table(s, d, "events"), ["user_id"], "event_type")


@query("A-12_first_last", "SELECT o_custkey, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_o_totalprice, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_o_totalprice FROM orders GROUP BY 1")
def first_last(s, d):
    return a.first_last(table(s, d, "orders"), ["o_custkey"], "o_totalprice", ["o_orderdate"], "o_orderkey")


@query("A-13_roll_up", "SELECT strftime(ts, '%Y-%m-%d') AS service_date, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def roll_up(s, d):
    hourly = table(s, d, "events").groupBy(F.date_trunc("hour", "ts").alias("h"), "event_type").agg(F.count("*").alias("n"))
    return a.roll_up(hourly.withColumn("service_date", F.date_format("h", "yyyy-MM-dd")), ["service_date", "event_type"], ["n"])


@query("A-14_safe_ratio", "SELECT user_id, round(count(*) FILTER (event_type = 'click') / nullif(CAST(count(*) FILTER (event_type = 'view') AS DOUBLE), 0), 2) AS ratio FROM events GROUP BY 1")
def safe_ratio(s, d):
    n = lambda v: F.count_if(c("event_type") == v)
    return a.agg(table(s, d, "events"), ["user_id"], ratio=keys.safe_ratio(n("click"), n("view")))


@query("A-15_null_rate", """SELECT k, count(*) AS n_rows, count(*) - count(v) AS n_null, round(100.0 * (count(*) - count(v)) / count(*), 2) AS pct_null
FROM (SELECT o_custkey % 10 AS k, CASE WHEN o_orderkey % (o_custkey % 10 + 2) = 0 THEN NULL ELSE 1 END AS v FROM orders) GROUP BY 1 HAVING pct_null > 15""")
def null_rate(s, d):
    o = table(s, d, "orders").select((c("o_custkey") % 10).alias("k"), F.when(c("o_orderkey") % (c("o_custkey") % 10 + 2) != 0, 1).alias("v"))
    return a.null_rate(o, ["k"], "v", 15)


# --- windows -------------------------------------------------------------------------


@query("W-1_keep_first", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_orderdate DESC, o_orderkey) = 1")
def keep_first(s, d):
    rank = p.classify([(c("o_orderstatus") == "F", 1), (c("o_orderstatus") == "O", 2)], 3)
    return w.keep_first(table(s, d, "orders"), ["o_custkey"], [rank, F.desc("o_orderdate")], "o_orderkey").select("o_custkey", "o_orderkey")


PINGS = "SELECT event_id, row_number() OVER p = 1 AS is_first, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AS is_last FROM events WINDOW p AS (PARTITION BY user_id ORDER BY ts, event_id)"


@query("W-2_flag_ends", PINGS)
def flag_ends(s, d):
    return w.flag_ends(table(s, d, "events"), ["user_id"], ["ts"], "event_id").select("event_id", "is_first", "is_last")


def windowed(s, d, /, **cols: Column) -> DataFrame:
    return table(s, d, "events").select("event_id", *(v.alias(k) for k, v in cols.items()))


KEYS, ORDER = ["user_id"], ["ts", "event_id"]
OVER = "OVER (PARTITION BY user_id ORDER BY ts, event_id"
HALF = "CASE WHEN event_id % 3 = 0 THEN event_type END"


@query("W-3_previous", f"SELECT event_id, lag(event_type) {OVER}) AS before FROM events")
def previous(s, d):
    return windowed(s, d, before=w.previous("event_type", KEYS, ORDER))


@query("W-4_close_intervals", "SELECT o_orderkey, strftime(coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), TIMESTAMP '2030-01-01'), '%Y-%m-%d') AS valid_to FROM orders")
def close_intervals(s, d):
    return w.close_intervals(table(s, d, "orders"), ["o_custkey"], "o_orderdate", F.lit("2030-01-01").cast("timestamp"), "o_orderkey").select("o_orderkey", F.date_format("valid_to", "yyyy-MM-dd").alias("valid_to"))


@query("W-5_running_sum", f"SELECT event_id, round(sum(value) {OVER} ROWS UNBOUNDED PRECEDING), 4) AS total FROM events")
def running_sum(s, d):
    return windowed(s, d, total=F.round(w.running_sum("value", KEYS, ORDER), 4))


@query("W-6_group_figures", "SELECT event_id, min(value) OVER (PARTITION BY user_id) AS least, count(*) OVER (PARTITION BY user_id) AS n FROM events")
def group_figures(s, d):
    return windowed(s, d, least=w.group_min("value", KEYS), n=w.group_count(KEYS))


def half() -> Column:
    return F.when(c("event_id") % 3 == 0, c("event_type"))


@query("W-7_fill_down", f"SELECT event_id, last_value({HALF} IGNORE NULLS) {OVER} ROWS UNBOUNDED PRECEDING) AS v FROM events")
def fill_down(s, d):
    return windowed(s, d, v=w.fill_down(half(), KEYS, ORDER))


@query("W-8_fill_up", f"SELECT event_id, first_value({HALF} IGNORE NULLS) {OVER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v FROM events")
def fill_up(s, d):
    return windowed(s, d, v=w.fill_up(half(), KEYS, ORDER))


@query("W-9_fill_both", f"SELECT event_id, coalesce({HALF}, last_value({HALF} IGNORE NULLS) {OVER} ROWS UNBOUNDED PRECEDING), first_value({HALF} IGNORE NULLS) {OVER} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM events")
def fill_both(s, d):
    return windowed(s, d, v=w.fill_both(half(), KEYS, ORDER))


SESSIONS = f"""WITH g AS (SELECT *, CASE WHEN lag(ts) {OVER}) IS NULL OR epoch(ts) - epoch(lag(ts) {OVER})) >= 3600 THEN 1 ELSE 0 END AS new FROM events),
n AS (SELECT *, CAST(sum(new) {OVER} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session FROM g), s AS (SELECT *, min(ts) OVER (PARTITION BY user_id, session) AS start FROM n)"""


@query("W-10_gap_sessions", SESSIONS + " SELECT event_id, session, strftime(start, '%Y-%m-%d %H:%M:%S') AS session_start FROM s")
def gap_sessions(s, d):
    return w.gap_sessions(table(s, d, "events"), KEYS, "ts", 3600, "event_id").select("event_id", "session", text("session_start").alias("session_start"))


@query("W-11_visit_index", f"SELECT event_id, CAST(sum(new) {OVER} ROWS UNBOUNDED PRECEDING) AS BIGINT) AS visit FROM (SELECT *, CASE WHEN row_number() {OVER}) = 1 OR event_type IS DISTINCT FROM lag(event_type) {OVER}) THEN 1 ELSE 0 END AS new FROM events)")
def visit_index(s, d):
    return w.visit_index(table(s, d, "events"), KEYS, "event_type", ["ts"], "event_id").select("event_id", "visit")


@query("W-12_guarded_delta", f"SELECT event_id, CASE WHEN value > lag(value) {OVER}) THEN round((value - lag(value) {OVER})) * 0.3048, 6) END AS metres FROM events")
def guarded_delta(s, d):
    return windowed(s, d, metres=F.round(w.guarded_delta("value", KEYS, ORDER, 0.3048), 6))


@query("W-13_balance_check", f"""
WITH e AS (SELECT *, event_id % 4 AS on_, event_id % 3 AS off_, event_id % 5 - 1 AS load FROM events), f AS (SELECT *, sum(on_ - off_) {OVER} ROWS UNBOUNDED PRECEDING) AS bal, row_number() {OVER}) AS i,
row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM e)
SELECT user_id, count(*) FILTER (load <> bal) AS n_unbalanced, count(*) FILTER (load < 0) AS n_negative, bool_or(load - on_ + off_ <> 0) FILTER (i = 1) AS starts_loaded, bool_or(load <> 0) FILTER (k = 1) AS ends_loaded FROM f GROUP BY 1""")
def balance_check(s, d):
    e = table(s, d, "events").withColumns({"on_": c("event_id") % 4, "off_": c("event_id") % 3, "load": c("event_id") % 5 - 1})
    return w.balance_check(e, KEYS, ["ts"], "event_id", "on_", "off_", "load")


@query("W-14_first_seen", f"SELECT event_id, CASE WHEN t IS NOT NULL THEN n END AS seen_rank, coalesce(CASE WHEN t IS NOT NULL THEN n END = 1, FALSE) AS is_first_seen FROM (SELECT event_id, {HALF} AS t, row_number() OVER (PARTITION BY user_id, {HALF} ORDER BY ts, event_id) AS n FROM events)")
def first_seen(s, d):
    e = table(s, d, "events").withColumn("t", half())
    return longs(w.first_seen(e, KEYS, "t", ["ts"], "event_id").select("event_id", "seen_rank", "is_first_seen"), "seen_rank")


@query("W-15_suffix_duplicates", "SELECT o_orderkey, CASE WHEN n = 1 THEN CAST(o_custkey AS VARCHAR) ELSE o_custkey || '-' || n END AS id FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders)")
def suffix_duplicates(s, d):
    return w.suffix_duplicates(table(s, d, "orders"), "o_custkey", ["o_orderdate"], "o_orderkey", "id").select("o_orderkey", "id")


@query("W-16_flag_duplicates", "SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) > 1 AS is_duplicate, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) = 1 AS is_keeper FROM orders")
def flag_duplicates(s, d):
    return w.flag_duplicates(table(s, d, "orders"), ["o_custkey", "o_orderpriority"], "o_orderkey").select("o_orderkey", "is_duplicate", "is_keeper")


@query("O-1_sort", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey")
def sort(s, d):
    return p.sort(table(s, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), [c("c_mktsegment"), F.desc("c_acctbal"), c("c_custkey")])


@query("O-2_nulls_last", f"SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY {HALF} NULLS LAST, event_id) AS n FROM events")
def nulls_last(s, d):
    return windowed(s, d, n=F.row_number().over(w.over(KEYS, [p.nulls_last(half()), c("event_id")])).cast("bigint"))


@query("O-3_head", "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def head(s, d):
    return p.head(table(s, d, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey"), 100).select("o_orderkey")


@query("O-4_top1", "SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1")
def top1(s, d):
    return w.top1(table(s, d, "orders"), ["o_custkey"], [F.desc("o_totalprice")], "o_orderkey").select("o_custkey", "o_orderkey")


# --- sets ----------------------------------------------------------------------------


@query("U-1_union_all", "SELECT c_nationkey AS k, c_name AS name FROM customer UNION ALL SELECT s_nationkey, s_name FROM supplier")
def union_all(s, d):
    return u.union_all(table(s, d, "customer").select(c("c_nationkey").alias("k"), c("c_name").alias("name")), table(s, d, "supplier").select(c("s_nationkey").alias("k"), c("s_name").alias("name")))


@query("U-2_union_distinct", "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(s, d):
    return u.union_distinct(table(s, d, "customer").select(c("c_nationkey").alias("k")), table(s, d, "supplier").select(c("s_nationkey").alias("k")))


@query("U-3_transform_where", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE o_orderpriority END AS label FROM orders")
def transform_where(s, d):
    o = table(s, d, "orders").select("o_orderkey", "o_orderstatus", c("o_orderpriority").alias("label"))
    return u.transform_where(o, c("o_orderstatus") == "O", lambda x: x.withColumn("label", F.lit("open"))).select("o_orderkey", "label")


@query("U-4_unpivot_roles", "SELECT l_orderkey, l_linenumber, l_partkey AS id, 'part' AS role FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, l_suppkey, 'supplier' FROM lineitem")
def unpivot_roles(s, d):
    return u.unpivot_roles(table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), {"l_partkey": "part", "l_suppkey": "supplier"}, "id")


@query("U-5_union_groups", """
WITH g AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS o_totalprice FROM orders GROUP BY 1 HAVING count(*) > 10)
SELECT o_custkey, o_totalprice, o_custkey IN (SELECT o_custkey FROM g) AS is_absorbed, FALSE AS is_group FROM orders UNION ALL SELECT o_custkey, o_totalprice, FALSE, TRUE FROM g""")
def union_groups(s, d):
    o = table(s, d, "orders").select("o_custkey", "o_totalprice")
    return u.union_groups(o, o.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("o_totalprice"), F.count("*").alias("n")).where("n > 10").drop("n"), "o_custkey")


@query("U-6_with_today", "SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-10' OR CAST(ts AS DATE) = DATE '2024-01-10'")
def with_today(s, d):
    e = table(s, d, "events").select("event_id", day("ts").alias("date"))
    return u.with_today(e.where("date < '2024-01-10'"), e, "date", "2024-01-10").select("event_id")


# --- functions -------------------------------------------------------------------------


def on_events(s, d, /, **cols: Column) -> DataFrame:
    return windowed(s, d, **cols)


@query("F-1_flex_cast", "SELECT event_id, TRY_CAST(nullif(trim(CASE event_id % 4 WHEN 0 THEN '  ' WHEN 1 THEN ' 12 ' WHEN 2 THEN 'x' ELSE event_type END), '') AS INT) AS n, nullif(trim(CASE event_id % 4 WHEN 0 THEN '  ' WHEN 1 THEN ' 12 ' WHEN 2 THEN 'x' ELSE event_type END), '') AS v FROM events")
def flex_cast(s, d):
    x = p.classify([(c("event_id") % 4 == 0, "  "), (c("event_id") % 4 == 1, " 12 "), (c("event_id") % 4 == 2, "x")])
    x = F.coalesce(x, c("event_type"))
    return on_events(s, d, n=casts.flex_cast(x, "int", True), v=casts.flex_cast(x, "string"))


@query("F-2_nan_like", "SELECT event_id, lower(x) IN ('nan', 'inf', '-inf', 'infinity', '-infinity') AS odd FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'NaN' WHEN 1 THEN '-Inf' ELSE '1' END AS x FROM events)")
def nan_like(s, d):
    return on_events(s, d, odd=casts.nan_like(p.classify([(c("event_id") % 3 == 0, "NaN"), (c("event_id") % 3 == 1, "-Inf")], "1")))


@query("F-3_parse_datetime", "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS at FROM events")
def parse_datetime(s, d):
    x = F.when(c("event_id") % 5 == 0, F.lit("-40101000000")).otherwise(F.date_format("ts", "yyMMddHHmmss"))
    return on_events(s, d, at=text(casts.parse_datetime(x, "%y%m%d%H%M%S", 12)))


@query("F-4_as_date", "SELECT event_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS d, strftime(CAST(CAST(ts AS DATE) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS t FROM events")
def as_date(s, d):
    return on_events(s, d, d=casts.as_date("ts").cast("string"), t=text(casts.as_timestamp(casts.as_date("ts"))))


@query("F-5_utc_to_local", "SELECT event_id, strftime(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York', '%Y-%m-%d %H:%M:%S') AS local FROM events")
def utc_to_local(s, d):
    return on_events(s, d, local=text(times.utc_to_local("ts", "America/New_York")))


@query("F-6_service_date", "SELECT event_id, strftime(date_trunc('day', ts - INTERVAL 4 HOUR), '%Y-%m-%d') AS d, strftime(date_trunc('hour', ts + to_hours(CAST(event_id % 5 AS INT))), '%Y-%m-%d %H:%M:%S') AS h FROM events")
def service_date(s, d):
    return on_events(s, d, d=times.service_date("ts").cast("string"), h=text(times.shift_trunc("ts", c("event_id") % 5, "hour", "hour")))


@query("F-7_shift", "SELECT event_id, strftime(ts + to_seconds(event_id % 100), '%Y-%m-%d %H:%M:%S') AS at FROM events")
def shift(s, d):
    return on_events(s, d, at=text(times.shift("ts", c("event_id") % 100, "second")))


CLOCK = "printf('%02d:%02d:%02d', event_id % 30, event_id % 60, event_id % 59)"


def clock() -> Column:
    part = lambda m: F.lpad((c("event_id") % m).cast("string"), 2, "0")
    return F.when(c("event_id") % 11 == 0, "bad").otherwise(F.concat_ws(":", part(30), part(60), part(59)))


@query("F-8_clock_interval", "SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN (event_id % 30 * 3600 + event_id % 60 * 60 + event_id % 59) END AS s FROM events")
def clock_interval(s, d):
    zero = F.lit("2000-01-01").cast("timestamp")
    return on_events(s, d, s=F.timestamp_diff("SECOND", zero, zero + times.clock_interval(clock())))


@query("F-9_clock_seconds", "SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN CAST(event_id % 30 * 3600 + event_id % 60 * 60 + event_id % 59 AS BIGINT) END AS s FROM events")
def clock_seconds(s, d):
    return on_events(s, d, s=times.clock_seconds(clock()).cast("bigint"))


@query("F-10_diff", f"SELECT event_id, date_diff('second', date_trunc('second', lag(ts) {OVER})), date_trunc('second', ts)) AS s FROM events")
def diff(s, d):
    return table(s, d, "events").withColumn("b", w.previous("ts", KEYS, ORDER)).select("event_id", times.diff("second", "b", "ts").alias("s"))


@query("F-11_format_ts", "SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS a, strftime(ts, '%A') AS b FROM events")
def format_ts(s, d):
    return on_events(s, d, a=times.format_ts("ts", "%Y%m%d%H%M%S"), b=times.format_ts("ts", "%A"))


@query("F-12_service_anchor", "SELECT event_id, strftime((CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR) AT TIME ZONE 'America/New_York' AT TIME ZONE 'UTC' - INTERVAL 12 HOUR, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def service_anchor(s, d):
    return on_events(s, d, at=text(times.service_anchor(day("ts"), "America/New_York")))


@query("F-13_today", "SELECT event_id, date_diff('day', CAST(ts AS DATE), DATE '2024-03-01') AS age FROM events")
def today(s, d):
    return on_events(s, d, age=F.datediff(times.today("America/New_York", "2024-03-01"), day("ts")).cast("bigint"))


@query("F-14_date_parts", "SELECT event_id, isodow(ts) AS dow, year(ts) AS y, month(ts) AS m, dayofyear(ts) AS doy, hour(ts) AS h FROM events")
def date_parts(s, d):
    return longs(on_events(s, d, dow=times.iso_dow("ts"), y=F.year("ts"), m=F.month("ts"), doy=F.dayofyear("ts"), h=F.hour("ts")), "dow", "y", "m", "doy", "h")


@query("F-15_text_functions", "SELECT p_partkey, regexp_full_match(p_brand, 'Brand#[1-3]+') AS low, nullif(regexp_extract(p_brand, '#([0-9]+)', 1), '') AS code, split_part(p_type, ' ', 2) AS second, replace(p_name, ' ', '_') AS name FROM part")
def text_functions(s, d):
    return table(s, d, "part").select("p_partkey", keys.full_match("p_brand", "Brand#[1-3]+").alias("low"), keys.extract("p_brand", "#([0-9]+)").alias("code"), F.split_part("p_type", F.lit(" "), F.lit(2)).alias("second"), F.replace("p_name", F.lit(" "), F.lit("_")).alias("name"))


@query("F-16_haversine_m", GEO + " SELECT a.ping, b.stop, round(2 * 6371000.0 * asin(sqrt(pow(sin(radians(s_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(s_lat)) * pow(sin(radians(s_lon - lon) / 2), 2))), 3) AS metres FROM a JOIN b USING (k)")
def haversine(s, d):
    pings, stops = geo(s, d)
    return j.dealt(pings.drop("seq"), stops.drop("s_seq"), ["k"]).select("ping", "stop", places.rounded(places.haversine_m(c("lat"), c("lon"), c("s_lat"), c("s_lon")), 3).alias("metres"))


@query("F-17_in_box", GEO + " SELECT ping, stop FROM m WHERE stop IS NOT NULL")
def in_box(s, d):
    pings, stops = geo(s, d)
    return j.dealt_box(pings.drop("seq"), stops.drop("s_seq"), ["k"], ("lat", "lon"), ("s_lat", "s_lon"), how="inner").select("ping", "stop")


@query("F-18_surrogate_key", f"SELECT event_id, md5(concat_ws('-', CAST(user_id AS VARCHAR), coalesce({HALF}, '_dbt_utils_surrogate_key_null_'))) AS key FROM events")
def surrogate_key(s, d):
    return on_events(s, d, key=keys.surrogate_key("user_id", half()))


@query("F-19_extremes", "SELECT event_id, greatest(value, CASE WHEN event_id % 2 = 0 THEN 50.0 END) AS g, least(value, CASE WHEN event_id % 2 = 0 THEN 50.0 END) AS l FROM events")
def extremes(s, d):
    x = F.when(c("event_id") % 2 == 0, 50.0)
    return on_events(s, d, g=F.greatest("value", x), l=F.least("value", x))


