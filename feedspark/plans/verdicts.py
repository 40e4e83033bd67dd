"""Verdicts: presence logs made of events, intervals of users, days of feeds, matches of order lines with versions of reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedspark.operators import manifest, replay, status, verdict
from feedspark.operators import versions as op
from feedspark.plans.manifests import FEEDS, _days
from feedspark.plans.manifests import SQL as MANIFESTS
from feedspark.plans.tables import events, table

HOURS = 3_600_000_000
_LISTS = "array<array<string>>"


def presence_log_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event is a record of its day's log; a number that 50 divides is a baseline, a user's number modulo 5 the trip.

    A signup lets the trip enter, an error withdraws it, a view or click is a stop that enters, a
    purchase withdraws the view. Some counts, sequences and poll ids are wrong."""
    e, i = events(spark, sf_dir).select("day", "event_id", "user_id", "event_type"), F.col("event_id")
    e = e.withColumns({"kind": F.when(i % 50 == 0, "baseline").otherwise("delta"), "order": i})
    e = replay.segmented(e, ["day"])
    w = Window.partitionBy("day", "segment").orderBy("order")
    kind = F.col("event_type")
    delta = F.col("kind") == "delta"
    enters, leaves, stop = delta & (kind == "signup"), delta & (kind == "error"), delta & kind.isin("view", "click")
    n = lambda c: c.cast("int")
    one = F.struct(F.array((F.col("user_id") % 5).cast("string")).alias("trip"), enters.alias("trip_entered"), leaves.alias("trip_withdrawn"), F.when(stop, F.array(F.array(kind))).otherwise(F.array().cast(_LISTS)).alias("entered_stops"), F.when(kind == "purchase", F.array(F.array(F.lit("view")))).otherwise(F.array().cast(_LISTS)).alias("withdrawn_stops"))
    log = e.select(
        "day", "order", F.when(i % 401 == 0, "x").otherwise(i.cast("string")).alias("poll_id"), F.col("segment").cast("string").alias("stream_id"), (F.row_number().over(w) + n(i % 307 == 0)).alias("sequence"), "kind", F.lit(1).alias("version"),
        (F.sum(n(enters) - n(leaves)).over(w) + n(i % 211 == 0)).alias("trip_count"), F.sum(n(stop) - n(delta & (kind == "purchase"))).over(w).alias("stop_count"), F.when(delta, F.array(one)).otherwise(F.filter(F.array(one), lambda _: F.lit(False))).alias("changes"),
        F.lit(None).cast("int").alias("source_timestamps_version"), F.array().cast("array<struct<trip:array<string>,timestamp:bigint>>").alias("source_timestamp_updates"),
    )
    found = replay.faults(log, ["day"], 1, 1)
    return found.select("day", F.col("segment").cast("long").alias("segment"), "order", "rule", "poll_id")


def source_timestamp_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user is a member for six hours from a view or click, and has a timestamp for five from a purchase or signup."""
    e = events(spark, sf_dir)
    of = lambda kinds, hours: e.filter(F.col("event_type").isin(*kinds)).select("user_id", F.col("us").alias("from_us"), (F.col("us") + hours * HOURS).alias("until_us"))
    return replay.coverage(of(("view", "click"), 6), of(("purchase", "signup"), 5), ["user_id"], "from_us", "until_us")


def _verdicts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e, i = events(spark, sf_dir), F.col("event_id")
    files = e.filter(F.dayofweek("day") != 6).groupBy("event_type", "day").agg(
        F.count_if(i % 3 == 0).alias("raw_snapshots"), (F.max(i % 101) < 100).alias("raw_log_clean"), F.count_if(i % 40 == 0).alias("parquet_files"), F.sum(F.col("k").cast("long")).alias("parquet_rows"),
        F.count_if(i % 499 == 0).alias("pending_spool_segments"), F.count_if(i % 307 == 0).alias("recovered_journal_tail_files"),
    )
    feeds = manifest.daily_manifest(_days(spark, sf_dir), "event_type", "day", files, FEEDS)
    run = F.when(i % 3 == 0, "run-0").otherwise(F.md5((i % 3).cast("string")))
    history = e.filter((F.col("event_type") == "signup") & (F.col("ts") >= F.lit("2024-01-05").cast("timestamp")) & (F.dayofmonth("day") % 3 != 0)).select(
        F.col("ts").alias("checked_at"), "event_id", (F.col("user_id") % 3).cast("string").alias("sha256"), F.concat(F.lit("v"), F.col("user_id") % 3).alias("version_path"), F.when(F.col("user_id") % 40 == 0, verdict.LEGACY_SOURCE).otherwise("daily").alias("source")
    )
    archives = table(spark, sf_dir, "region").filter("r_regionkey < 2").select(F.concat(F.lit("v"), "r_regionkey").alias("path"), (F.col("r_regionkey") * 7).cast("string").alias("sha256"))
    days = e.select("day").distinct()
    rows = verdict.feed_evidence(feeds, "event_type", "day").unionByName(verdict.run_evidence(e.select("day", run.alias("run_id")), e.select(F.md5(F.lit("1")).alias("run_id")).limit(1), "day", "run_id"))
    rows = rows.unionByName(verdict.static_evidence(days, history, archives, "day", "checked_at", ["event_id"]))
    return verdict.day_verdicts(days, rows, "day", FEEDS), feeds


def day_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds as in ``daily_manifest``; a third of the runs has a malformed id, one has no record; signups announce versions, except on each third day."""
    got, _ = _verdicts(spark, sf_dir)
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["source"], x["rule"], F.coalesce(x["detail"], F.lit("")))), ",")
    return got.select("date", "complete", "quality_ok", text("errors").alias("errors"), text("flags").alias("flags"))


def collection_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days before the 28th; a receipt a day, some of an old version, unverified or named by another day."""
    _, feeds = _verdicts(spark, sf_dir)
    n = F.dayofmonth("day")
    receipts = events(spark, sf_dir).select("day").distinct().select("day", F.when(n % 5 == 0, 1).otherwise(2).alias("version"), (n % 3 != 0).alias("remote_verified"), F.when(n == 7, F.date_add("day", 1)).otherwise(F.col("day")).alias("file_date"))
    return status.collection_statistics(feeds, receipts, "day", "event_type", F.lit("2024-01-28").cast("date"))


def static_join_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report for each return flag; order lines are updates, orders trips, customers routes, in three versions by the order's number."""
    li = table(spark, sf_dir, "lineitem")
    own = F.when(F.col("l_suppkey") % 50 != 0, (F.col("l_orderkey") + (F.col("l_linenumber") == 7).cast("int")) % 3).alias("version")
    three = F.explode(F.array(*[F.lit(k).cast("long") for k in range(3)])).alias("version")
    trips = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select((F.col("o_orderkey") % 3).alias("version"), F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    stops = li.filter("l_quantity > 10").select((F.col("l_orderkey") % 3).alias("version"), "l_orderkey", "l_linenumber", "l_suppkey").distinct()
    observed = li.select("l_returnflag", own, "l_orderkey", "l_linenumber", "l_suppkey")
    matches = op.static_matches(observed, trips, table(spark, sf_dir, "customer").select(three, "c_custkey", "c_mktsegment"), stops, "l_orderkey", "c_custkey", ["l_linenumber", "l_suppkey"], "c_mktsegment", ["version"])
    confidence = F.when(F.col("l_orderkey") % 400 == 0, "legacy_schedule_uncertain").otherwise("collector_observed").alias("confidence")
    usage = li.filter("l_linenumber = 1").select("l_returnflag", own, confidence)
    route = F.when(F.col("l_suppkey") % 7 != 0, F.col("l_suppkey").cast("string"))
    got = op.static_join_report(matches.withColumn("route", route), usage, ["l_returnflag"], "version", "route", "confidence")
    text = lambda c, *fields: F.array_join(F.transform(c, lambda x: F.concat_ws(":", *[x[f] for f in fields])), ",")
    return got.select(
        "l_returnflag", "snapshots", text("versions", "version", "confidence", "snapshots").alias("versions"), "unresolved", "updates", "trip_matches", "exact_matches", "trip_rate", "exact_rate",
        text("modes", "mode", "updates", "trip_matches", "exact_matches").alias("modes"), text("unmatched_routes", "route", "n").alias("unmatched_routes"), F.array_join("warnings", ",").alias("warnings"),
    )


_REASONS = (("uncovered", "m > 0 AND v = 0"), ("unowned", "m = 0 AND v > 0"), ("ambiguous", "v > 1"), ("repeated_member", "m > 1"))
_RATE = "CASE WHEN {0} < 0.9 THEN '{1}' END"
SQL = {
    "presence_log_faults": """WITH g AS (SELECT CAST(ts AS DATE) AS day, event_id AS i, user_id % 5 AS trip, event_type AS ty, event_id % 50 = 0 AS base, sum(CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS seg FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY day, seg ORDER BY i) + CASE WHEN i % 307 = 0 THEN 1 ELSE 0 END AS q FROM g),
s AS (SELECT *, lag(q) OVER w AS before, lag(seg) OVER w AS seg_before, i % 401 = 0 AND count(*) FILTER (WHERE i % 401 = 0) OVER w > 1 AS twice FROM r WINDOW w AS (PARTITION BY day ORDER BY i)),
c AS (SELECT *, NOT coalesce(lag(ty = 'error') OVER w, true) AS present, sum(CASE WHEN ty IN ('view', 'click') THEN 1 WHEN ty = 'purchase' THEN -1 ELSE 0 END) OVER w AS kept,
 coalesce(lag(ty <> 'purchase') OVER (PARTITION BY day, seg, trip, CASE WHEN ty = 'click' THEN 'click' WHEN ty IN ('view', 'purchase') THEN 'view' ELSE 'none' || i END ORDER BY i), false) AS was FROM g WHERE NOT base WINDOW w AS (PARTITION BY day, seg, trip ORDER BY i)),
f AS (SELECT day, seg, i, 0 AS n, 'baseline_sequence' AS rule FROM s WHERE base AND q <> 1 UNION ALL SELECT day, seg, i, 1, 'sequence_gap' FROM s WHERE NOT base AND (before IS NULL OR seg_before <> seg OR q <> before + 1) UNION ALL SELECT day, seg, i, 5, 'trip_enters_twice' FROM c WHERE ty = 'signup' AND present
 UNION ALL SELECT day, seg, i, 6, 'not_preceding_membership' FROM c WHERE ty <> 'signup' AND NOT present OR ty IN ('view', 'click') AND was OR ty = 'purchase' AND NOT was
 UNION ALL SELECT day, seg, i, 7, 'withdrawn_trip_keeps_stops' FROM c WHERE ty = 'error' AND kept <> 0 UNION ALL SELECT day, seg, i, 8, 'membership_counts' FROM g WHERE i % 211 = 0 UNION ALL SELECT day, seg, i, 14, 'duplicate_poll' FROM s WHERE twice)
SELECT day, CAST(seg AS BIGINT) AS segment, i AS "order", rule, CASE WHEN i % 401 = 0 THEN 'x' ELSE CAST(i AS VARCHAR) END AS poll_id FROM f QUALIFY row_number() OVER (PARTITION BY day, seg ORDER BY i, n) = 1""",
    "source_timestamp_coverage": """WITH i AS (SELECT user_id AS u, epoch_us(ts) AS a, event_type IN ('view', 'click') AS own, epoch_us(ts) + CASE WHEN event_type IN ('view', 'click') THEN 6 ELSE 5 END * 3600000000 AS b FROM events WHERE event_type <> 'error'),
t AS (SELECT u, a AS t FROM i UNION SELECT u, b FROM i), z AS (SELECT u, t, lead(t) OVER (PARTITION BY u ORDER BY t) AS e FROM t),
n AS (SELECT z.u, z.t, z.e, count(*) FILTER (WHERE own) AS m, count(*) FILTER (WHERE NOT own) AS v FROM z JOIN i ON i.u = z.u AND i.a <= z.t AND i.b > z.t WHERE z.e IS NOT NULL GROUP BY ALL),
p AS (""" + " UNION ALL ".join(f"SELECT u, '{r}' AS reason, t, e FROM n WHERE {c}" for r, c in _REASONS) + """),
q AS (SELECT *, CASE WHEN lag(e) OVER (PARTITION BY u, reason ORDER BY t) = t THEN 0 ELSE 1 END AS new FROM p), k AS (SELECT *, sum(new) OVER (PARTITION BY u, reason ORDER BY t) AS run FROM q)
SELECT u AS user_id, reason, min(t) AS from_us, max(e) AS until_us FROM k GROUP BY u, reason, run""",
    "day_verdicts": MANIFESTS["daily_manifest"].rpartition("SELECT")[0] + """, ht AS (SELECT ts AS checked_at, min_by(user_id % 3, event_id) AS version, min_by(user_id % 40 = 0, event_id) AS old FROM events WHERE event_type = 'signup' AND ts >= TIMESTAMP '2024-01-05' AND day(ts) % 3 <> 0 GROUP BY ts),
dd AS (SELECT DISTINCT day FROM j0), la AS (SELECT dd.day, ht.version FROM dd ASOF LEFT JOIN ht ON CAST(dd.day + 1 AS TIMESTAMP) > ht.checked_at), sa AS (SELECT dd.day, ht.version IS NOT NULL AS covered, coalesce(ht.old, false) AS old FROM dd ASOF LEFT JOIN ht ON CAST(dd.day AS TIMESTAMP) >= ht.checked_at),
wi AS (SELECT CAST(checked_at AS DATE) AS day, bool_or(old) AS old FROM ht GROUP BY ALL), st AS (SELECT la.day, la.version, sa.covered, wi.day IS NOT NULL AS seen, sa.old OR coalesce(wi.old, false) AS old FROM la JOIN sa ON sa.day = la.day LEFT JOIN wi ON wi.day = la.day),
ev AS (SELECT day, 'error' AS kind, event_type AS source, list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type) AS rank, unnest(string_split(errors, ',')) AS rule, generate_subscripts(string_split(errors, ','), 1) AS place, '' AS detail FROM y WHERE errors <> ''
UNION ALL SELECT day, 'flag', event_type, list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type), unnest(string_split(flags, ',')), generate_subscripts(string_split(flags, ','), 1), '' FROM y WHERE flags <> ''
UNION ALL SELECT DISTINCT day, 'error', 'runs', 8, CASE WHEN i % 3 = 0 THEN 'invalid_run_id' ELSE 'missing_run_record' END, CASE WHEN i % 3 = 0 THEN 0 ELSE 1 END, CASE WHEN i % 3 = 0 THEN 'run-0' ELSE md5('2') END FROM j0 WHERE i % 3 <> 1
UNION ALL SELECT day, 'error', 'static', 7, 'no_version', 0, '' FROM st WHERE version IS NULL UNION ALL SELECT day, 'error', 'static', 7, 'archive_missing', 1, 'v2' FROM st WHERE version = 2 UNION ALL SELECT day, 'error', 'static', 7, 'archive_digest', 2, 'v1' FROM st WHERE version = 1
UNION ALL SELECT day, 'flag', 'static', 7, 'no_version_seen', 3, '' FROM st WHERE NOT covered AND NOT seen UNION ALL SELECT day, 'flag', 'static', 7, 'start_not_covered', 4, '' FROM st WHERE seen AND NOT covered UNION ALL SELECT day, 'flag', 'static', 7, 'legacy_schedule_uncertain', 5, '' FROM st WHERE old),
ls AS (SELECT dd.day, coalesce(string_agg(source || ':' || rule || ':' || detail, ',' ORDER BY rank, place, detail) FILTER (WHERE kind = 'error'), '') AS errors, coalesce(string_agg(source || ':' || rule || ':' || detail, ',' ORDER BY rank, place, detail) FILTER (WHERE kind = 'flag'), '') AS flags FROM dd LEFT JOIN ev ON ev.day = dd.day GROUP BY ALL)
SELECT day AS date, errors = '' AS complete, flags = '' AS quality_ok, errors, flags FROM ls""",
    "collection_report": MANIFESTS["daily_manifest"].rpartition("SELECT")[0] + """, q AS (SELECT day, sum(coalesce(attempted_polls, 0)) AS polls, sum(rows) AS rows, sum(rs) AS raw, bool_and(flags = '') AS good FROM y WHERE day < DATE '2024-01-28' GROUP BY day HAVING sum(coalesce(attempted_polls, 0)) > 0),
rc AS (SELECT DISTINCT day FROM j0 WHERE day < DATE '2024-01-28' AND day(day) % 5 <> 0 AND day(day) % 3 <> 0 AND day(day) <> 7)
SELECT (SELECT min(first_success) FROM d WHERE day < DATE '2024-01-28') AS evidenced_since, count(*) AS evidenced_days, CAST(sum(polls) AS BIGINT) AS polls_recorded, CAST(sum(rows) AS BIGINT) AS event_rows, CAST(sum(raw) AS BIGINT) AS raw_snapshots, max(day) AS latest_date, arg_max(CASE WHEN good THEN 'good' ELSE 'flagged' END, day) AS latest_quality,
(SELECT count(*) FROM rc) AS verified_days, (SELECT max(day) FROM rc) AS last_verified_date FROM q""",
    "static_join_report": """WITH o AS (SELECT l_returnflag AS f, CASE WHEN l_suppkey % 50 <> 0 THEN (l_orderkey + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) % 3 END AS ver, l_orderkey, l_linenumber, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL),
s AS (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_quantity > 10),
m AS (SELECT o.*, ver IS NOT NULL AS known, t.o_orderkey IS NOT NULL AS trip, s.l_orderkey IS NOT NULL AS exact, CASE WHEN t.o_orderkey IS NULL THEN 'external_or_unmatched_valid_realtime' ELSE coalesce(c.c_mktsegment, 'static_route_type_unknown') END AS mode, CASE WHEN o.l_suppkey % 7 <> 0 THEN CAST(o.l_suppkey AS VARCHAR) ELSE '(missing_route_id)' END AS route
 FROM o LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') t ON t.o_orderkey = o.l_orderkey AND t.o_orderkey % 3 = o.ver LEFT JOIN customer c ON c.c_custkey = t.o_custkey LEFT JOIN s ON s.l_orderkey = o.l_orderkey AND s.l_linenumber = o.l_linenumber AND s.l_suppkey = o.l_suppkey AND s.l_orderkey % 3 = o.ver),
a AS (SELECT f, CAST(sum(n) AS BIGINT) AS updates, CAST(sum(CASE WHEN known AND trip THEN n ELSE 0 END) AS BIGINT) AS trip_matches, CAST(sum(CASE WHEN known AND exact THEN n ELSE 0 END) AS BIGINT) AS exact_matches, CAST(sum(CASE WHEN known THEN 0 ELSE n END) AS BIGINT) AS unresolved FROM m GROUP BY f),
b AS (SELECT f, mode, sum(n) AS u, sum(CASE WHEN trip THEN n ELSE 0 END) AS t, sum(CASE WHEN exact THEN n ELSE 0 END) AS e FROM m WHERE known GROUP BY ALL), bm AS (SELECT f, string_agg(mode || ':' || u || ':' || t || ':' || e, ',' ORDER BY mode) AS modes, string_agg(CASE WHEN mode <> 'external_or_unmatched_valid_realtime' AND e / u < 0.9 THEN 'low_exact_rate:' || mode END, ',' ORDER BY mode) AS low FROM b GROUP BY f),
k AS (SELECT f, route, sum(n) AS n FROM m WHERE known AND NOT trip GROUP BY ALL), kr AS (SELECT f, string_agg(route || ':' || n, ',' ORDER BY n DESC, route) AS unmatched_routes FROM k GROUP BY f),
x AS (SELECT l_returnflag AS f, CASE WHEN l_suppkey % 50 <> 0 THEN l_orderkey % 3 END AS ver, CASE WHEN l_orderkey % 400 = 0 THEN 'legacy_schedule_uncertain' ELSE 'collector_observed' END AS conf FROM lineitem WHERE l_linenumber = 1),
v AS (SELECT f, ver, count(*) AS n, count(DISTINCT conf) AS kinds, min(conf) AS conf, bool_or(conf = 'legacy_schedule_uncertain') AS old FROM x WHERE ver IS NOT NULL GROUP BY ALL), vs AS (SELECT f, string_agg(ver || ':' || CASE WHEN kinds > 1 THEN 'mixed' ELSE conf END || ':' || n, ',' ORDER BY ver) AS versions, bool_or(old) AS old FROM v GROUP BY f),
w AS (SELECT f, count(*) AS snapshots FROM x GROUP BY f)
SELECT w.f AS l_returnflag, w.snapshots, vs.versions, a.unresolved, a.updates, a.trip_matches, a.exact_matches, a.trip_matches / a.updates AS trip_rate, a.exact_matches / a.updates AS exact_rate, bm.modes, coalesce(kr.unmatched_routes, '') AS unmatched_routes,
concat_ws(',', CASE WHEN unresolved > 0 THEN 'unresolved_updates' END, CASE WHEN old THEN 'legacy_schedule_uncertain' END, """ + _RATE.format("a.trip_matches / a.updates", "low_trip_rate") + ", " + _RATE.format("a.exact_matches / a.updates", "low_exact_rate") + """, bm.low) AS warnings
FROM w LEFT JOIN vs ON vs.f = w.f LEFT JOIN a ON a.f = w.f LEFT JOIN bm ON bm.f = w.f LEFT JOIN kr ON kr.f = w.f""",
}

QUERIES = {f.__name__: f for f in (presence_log_faults, source_timestamp_coverage, day_verdicts, collection_report, static_join_report)}
