"""Versions on events: a signup from 2024-01-05 on announces version user_id % 3; purchases are observed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.operators import versions as op
from feedspark.plans.tables import events, table


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).filter((F.col("event_type") == "signup") & (F.col("ts") >= F.lit("2024-01-05").cast("timestamp")))
    return e.select(F.col("ts").alias("checked_at"), "event_id", (F.col("user_id") % 3).alias("version"))


def asof_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = events(spark, sf_dir).filter(F.col("event_type") == "purchase").select("event_id", "ts")
    history = _history(spark, sf_dir).withColumnRenamed("event_id", "line")
    return op.as_of(seen, history, "ts", "checked_at", ["line"], ["version"]).select("event_id", "version")


def day_end_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = events(spark, sf_dir).select("day").distinct()
    return op.day_end(days, _history(spark, sf_dir), "day", "checked_at", ["event_id"], ["version"])


def version_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = op.timeline(_history(spark, sf_dir), "checked_at", ["event_id"], ["version"])
    return got.select("version", F.unix_micros("valid_from").alias("from_us"), F.unix_micros("valid_to").alias("to_us"), "n_checks")


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    trips = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    stops = li.filter("l_returnflag <> 'R'").select("l_orderkey", "l_linenumber", "l_suppkey").distinct()
    return op.static_matches(li.select("l_orderkey", "l_linenumber", "l_suppkey"), trips, table(spark, sf_dir, "customer"), stops, "l_orderkey", "c_custkey", ["l_linenumber", "l_suppkey"], "c_mktsegment")


def static_match_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers whose key 50 divides have no version: unresolved."""
    got = op.match_rates(_matches(spark, sf_dir), resolved=F.col("l_suppkey") % 50 != 0)
    return got.withColumn("warnings", F.array_join("warnings", ","))


def version_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a snapshot, its source the version, its language the confidence."""
    got = op.version_usage(table(spark, sf_dir, "documents"), ["source"], "lang")
    return got.select("source", "snapshots", "confidence", F.array_join(F.transform("by_confidence", lambda x: F.concat_ws(":", x["confidence"], x["snapshots"])), ",").alias("by_confidence"))


def unmatched_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    route = F.coalesce(F.col("l_suppkey").cast("string"), F.lit("(missing_route_id)")).alias("route")
    return _matches(spark, sf_dir).filter(~F.col("trip_matched")).groupBy(route).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "route")


_H = "WITH h AS (SELECT ts AS checked_at, min_by(user_id % 3, event_id) AS version FROM events WHERE event_type = 'signup' AND ts >= TIMESTAMP '2024-01-05' GROUP BY ts)\n"
_M = """WITH o AS (SELECT l_orderkey, l_linenumber, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL),
s AS (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_returnflag <> 'R'),
m AS (SELECT o.*, t.o_orderkey IS NOT NULL AS trip_matched, s.l_orderkey IS NOT NULL AS exact, CASE WHEN t.o_orderkey IS NULL THEN 'external_or_unmatched_valid_realtime' ELSE coalesce(c.c_mktsegment, 'static_route_type_unknown') END AS mode
FROM o LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') t ON t.o_orderkey = o.l_orderkey LEFT JOIN customer c ON c.c_custkey = t.o_custkey
LEFT JOIN s ON s.l_orderkey = o.l_orderkey AND s.l_linenumber = o.l_linenumber AND s.l_suppkey = o.l_suppkey)
"""
SQL = {
    "asof_version": _H + "SELECT e.event_id, h.version FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF LEFT JOIN h ON e.ts >= h.checked_at",
    "day_end_version": _H + "SELECT d.day, h.version FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) d ASOF LEFT JOIN h ON CAST(d.day + 1 AS TIMESTAMP) > h.checked_at",
    "version_timeline": _H + """, n AS (SELECT *, lead(checked_at) OVER (ORDER BY checked_at) AS nxt, CASE WHEN version = lag(version) OVER (ORDER BY checked_at) THEN 0 ELSE 1 END AS new FROM h),
r AS (SELECT *, sum(new) OVER (ORDER BY checked_at) AS run FROM n)
SELECT version, epoch_us(min(checked_at)) AS from_us, CASE WHEN count(*) = count(nxt) THEN epoch_us(max(nxt)) END AS to_us, count(*) AS n_checks FROM r GROUP BY run, version""",
    "static_match_rates": _M + """, k AS (SELECT *, l_suppkey % 50 <> 0 AS known FROM m),
b AS (SELECT CASE WHEN known THEN mode END AS mode, sum(n) AS updates, sum(CASE WHEN known AND trip_matched THEN n ELSE 0 END) AS trip_matches, sum(CASE WHEN known AND exact THEN n ELSE 0 END) AS exact_matches, sum(CASE WHEN known THEN 0 ELSE n END) AS unresolved FROM k GROUP BY 1),
a AS (SELECT * FROM b WHERE mode IS NOT NULL UNION ALL SELECT 'all', sum(updates), sum(trip_matches), sum(exact_matches), sum(unresolved) FROM b)
SELECT mode, CAST(updates AS BIGINT) AS updates, CAST(trip_matches AS BIGINT) AS trip_matches, CAST(exact_matches AS BIGINT) AS exact_matches, CAST(unresolved AS BIGINT) AS unresolved, trip_matches / updates AS trip_rate, exact_matches / updates AS exact_rate,
concat_ws(',', CASE WHEN mode = 'all' AND unresolved > 0 THEN 'unresolved_updates' END, CASE WHEN mode = 'all' AND trip_matches / updates < 0.9 THEN 'low_trip_rate' END,
 CASE WHEN mode <> 'external_or_unmatched_valid_realtime' AND exact_matches / updates < 0.9 THEN 'low_exact_rate' END) AS warnings FROM a""",
    "version_usage": """WITH c AS (SELECT source, coalesce(lang, 'unknown') AS c, count(*) AS n FROM documents GROUP BY ALL)
SELECT source, CAST(sum(n) AS BIGINT) AS snapshots, CASE WHEN count(*) > 1 THEN 'mixed' ELSE min(c) END AS confidence, string_agg(c || ':' || n, ',' ORDER BY c) AS by_confidence FROM c GROUP BY source""",
    "unmatched_routes": _M + "SELECT coalesce(CAST(l_suppkey AS VARCHAR), '(missing_route_id)') AS route, CAST(sum(n) AS BIGINT) AS n FROM m WHERE NOT trip_matched GROUP BY ALL",
}
QUERIES = {f.__name__: f for f in (asof_version, day_end_version, version_timeline, static_match_rates, version_usage, unmatched_routes)}
