"""Manifests, coverage windows and publication: an event is a poll of the feed that its type names, a customer a vehicle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.operators import health, manifest, public
from feedspark.plans.tables import events, table

FEEDS = ["click", "error", "purchase", "signup", "view"]


def _journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, i = events(spark, sf_dir), F.col("event_id")
    return e.select(
        "event_id", "event_type", "day", (F.col("us") / 1e6).alias("received"), (i % 17 != 0).alias("success"), (i % 13 != 0).alias("parse_ok"), (i % 3 == 0).alias("raw_archived"),
        F.when(i % 7 != 0, i % 11 != 0).alias("raw_ok"), F.col("k").cast("long").alias("emitted_rows"), (F.col("k") * 2).cast("long").alias("parsed_rows"),
        F.when(i % 5 == 0, 600.0).when(i % 5 == 1, 900.0).when(i % 5 == 2, 1.0).alias("poll_interval_seconds"), F.when(i % 50 == 0, 1).otherwise(0).cast("long").alias("missed_deadlines_before_request"),
        F.col("value").alias("processing_latency_ms"), F.when(F.col("k") > 95, F.array(F.lit("payload_frozen"))).when(F.col("k") > 90, F.array(F.lit("payload_unchanged_warning"))).alias("freshness_flags"),
        F.concat(F.lit("run-"), i % 3).alias("run_id"), (i % 997 == 0).alias("corrupt"),
    )


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.feed_days(_journal(spark, sf_dir), "event_type", "day", F.when(F.col("event_type") == "error", 1800).otherwise(1200))


def _flat(rows: DataFrame, arrays: tuple[str, ...]) -> DataFrame:
    return rows.withColumns({c: F.array_join(c, ",") for c in arrays})


def feed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _days(spark, sf_dir).withColumn("gap_samples", F.size("gap_samples").cast("long"))
    return _flat(got.withColumn("n_cadences", F.col("n_cadences").cast("long")), ("collector_run_ids",))


def daily_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the day: raw snapshots are events whose number 3 divides, derived rows their k; Fridays have no files."""
    e, i = events(spark, sf_dir).filter(F.dayofweek("day") != 6), F.col("event_id")
    files = e.groupBy("event_type", "day").agg(
        F.count_if(i % 3 == 0).alias("raw_snapshots"), (F.max(i % 101) < 100).alias("raw_log_clean"), F.count_if(i % 40 == 0).alias("parquet_files"), F.sum(F.col("k").cast("long")).alias("parquet_rows"),
        F.count_if(i % 499 == 0).alias("pending_spool_segments"), F.count_if(i % 307 == 0).alias("recovered_journal_tail_files"),
    )
    got = manifest.daily_manifest(_days(spark, sf_dir), "event_type", "day", files, FEEDS)
    return _flat(got.select("event_type", "day", "attempted_polls", "raw_snapshots", "errors", "flags", "complete", "quality_ok"), ("errors", "flags"))


def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    journal = _journal(spark, sf_dir).withColumn("poll_interval_seconds", F.when(F.col("event_type") != "view", 900.0).otherwise(F.col("poll_interval_seconds")))
    got = manifest.window_coverage(journal, "event_type", 1704261600.0, 1705708800.0, F.lit(1200), "day")
    return got.withColumns({"cadences": F.array_join(F.transform("cadences", lambda x: x.cast("long").cast("string")), ","), "run_ids": F.array_join("run_ids", ",")})


def observed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    journal = _journal(spark, sf_dir).withColumn("emitted_rows", F.when(F.dayofmonth("day") % 4 != 0, F.col("emitted_rows")))
    days = manifest.feed_days(journal, "event_type", "day", F.lit(1200))
    derived = events(spark, sf_dir).filter((F.dayofmonth("day") % 4 != 0) & (F.dayofmonth("day") % 7 != 0))
    return manifest.observed_days(days, "event_type", "day", derived)


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("event_type", "event_id", "ts", "user_id")
    return public.latest_snapshot(e, ["event_type"], ["ts", "event_id"]).select("event_type", "event_id", "user_id")


def first_daytime_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = public.in_hours(events(spark, sf_dir), F.col("ts"), 6, 18)
    return public.first_snapshots(e, ["event_type"], ["day"], 5).select("event_id")


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation").filter("n_nationkey % 5 <> 0")
    modes = F.element_at(F.array(*map(F.lit, public.MODES)), F.col("n_regionkey").cast("int") + 1)
    color = F.when(F.col("n_nationkey") % 2 == 0, F.substring(F.upper(F.md5("n_name")), 1, 6))
    catalog = nation.select(F.col("n_nationkey").cast("string").alias("route"), F.initcap("n_name").alias("label"), modes.alias("mode"), color.alias("color"))
    k = F.col("c_custkey")
    vehicles = c.select(
        F.when(k % 4 != 0, F.concat(F.lit("v"), (k / 2).cast("long"))).otherwise("").alias("vehicle_id"), k.cast("string").alias("entity_id"), (F.col("c_acctbal") / 50).alias("lon"), (F.col("c_acctbal") / 100).alias("lat"),
        F.when(k % 9 != 0, F.col("c_nationkey").cast("string")).alias("route"), (F.col("c_acctbal") / 10).alias("bearing"), k.alias("recorded_at"), k.alias("pos"), (k % 31 == 0).alias("deleted"),
    )
    return public.public_vehicles(vehicles, catalog, "route")


def public_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir)


def public_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = _published(spark, sf_dir), F.col("recorded_at")
    bad = p.withColumns({"id": F.when(k % 20 == 1, "twice").otherwise(F.col("id")), "mode": F.when(k % 33 == 2, "hev").otherwise(F.col("mode")), "lat": F.when(k % 41 == 3, F.col("lat") + 100).otherwise(F.col("lat")), "secret": F.lit(1)})
    return public.contract_violations(bad, "recorded_at")


def public_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event is a feed's status: its age k - 20 times 3 seconds."""
    e, i = events(spark, sf_dir), F.col("event_id")
    flags = F.array_compact(F.array(F.when(i % 5 == 0, "payload_unchanged_warning"), F.when(i % 7 == 0, "private_diagnostic"), F.when(i % 11 == 0, "scheduler_missed_deadline"), F.when(i % 13 == 0, "absent")))
    issues = health.public_issues(flags, {"parse_ok": i % 17 != 0, "raw_ok": F.when(i % 2 == 0, i % 19 != 0)})
    rows = e.select("event_id", issues.alias("issues"), ((F.col("k") - 20) * 3).alias("age"), (i % 23 != 0).alias("known"))
    return rows.select("event_id", F.array_join("issues", ",").alias("issues"), health.public_feed_state(F.col("age"), F.col("known"), F.col("issues")).alias("state"))


_J = """WITH j0 AS (SELECT event_id AS i, event_type, CAST(ts AS DATE) AS day, epoch_us(ts) / 1e6 AS t, value AS ms, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
j AS (SELECT *, i % 997 <> 0 AS fine, coalesce(i % 997 <> 0 AND i % 17 <> 0, false) AS ok, coalesce(i % 997 <> 0 AND i % 17 <> 0 AND i % 13 <> 0, false) AS parsed,
 i % 997 <> 0 AND i % 17 <> 0 AND i % 13 <> 0 AND (i % 7 = 0 OR i % 11 <> 0) AS data, i % 7 = 0 OR i % 11 <> 0 AS raw_fine, i % 3 = 0 AS raw,
 CASE WHEN i % 5 = 0 THEN 600.0 WHEN i % 5 = 1 THEN 900.0 WHEN i % 5 = 2 THEN 1.0 END AS pi FROM j0),
g AS (SELECT event_type, day, count(*) FILTER (WHERE fine) AS attempted_polls, count(*) FILTER (WHERE ok) AS successful_http_polls, count(*) FILTER (WHERE parsed) AS successful_parse_polls, count(*) FILTER (WHERE data) AS successful_data_polls,
 count(*) FILTER (WHERE ok AND raw) AS journal_raw_snapshots, count(*) FILTER (WHERE ok AND raw AND raw_fine AND NOT data) AS failed_processing_polls_with_raw_evidence, coalesce(sum(2 * k) FILTER (WHERE parsed), 0) AS parsed_rows_seen, coalesce(sum(k) FILTER (WHERE parsed), 0) AS event_rows_emitted,
 count(*) FILTER (WHERE ok AND k > 95) AS stale_feed_polls, count(*) FILTER (WHERE ok AND k > 90 AND k <= 95) AS freshness_warning_polls, count(*) FILTER (WHERE NOT fine) AS corrupt_journal_lines, count(*) FILTER (WHERE fine AND i % 50 = 0) AS scheduler_missed_deadlines,
 coalesce(string_agg(DISTINCT 'run-' || (i % 3), ',' ORDER BY 'run-' || (i % 3)) FILTER (WHERE fine), '') AS collector_run_ids, min(t) FILTER (WHERE ok) AS first_success, max(t) FILTER (WHERE ok) AS last_success,
 list_sort(list(pi) FILTER (WHERE fine AND pi >= 5)) AS pis, list_sort(list(t) FILTER (WHERE data)) AS ts, epoch_us(day) / 1e6 AS start FROM j GROUP BY ALL),
c AS (SELECT *, CAST(coalesce(pis[len(pis) // 2 + 1], CASE WHEN event_type = 'error' THEN 1800 ELSE 1200 END) AS DOUBLE) AS cadence, CAST(coalesce(len(list_distinct(pis)), 0) AS BIGINT) AS n_cadences, list_transform(range(1, len(ts)), lambda x: ts[x + 1] - ts[x]) AS steps FROM g),
d AS (SELECT *, greatest(1, CAST(round_even(86400.0 / cadence, 0) AS BIGINT)) AS expected_polls, CAST(coalesce(len(list_filter(steps, lambda s: s > cadence * 1.5)), 0) AS BIGINT) AS n_gaps FROM c)
"""
SQL = {
    "feed_days": _J + """SELECT event_type, day, attempted_polls, successful_http_polls, successful_parse_polls, successful_data_polls, journal_raw_snapshots, failed_processing_polls_with_raw_evidence, CAST(parsed_rows_seen AS BIGINT) AS parsed_rows_seen,
CAST(event_rows_emitted AS BIGINT) AS event_rows_selected, CAST(event_rows_emitted AS BIGINT) AS event_rows_emitted, stale_feed_polls, freshness_warning_polls, corrupt_journal_lines, scheduler_missed_deadlines, collector_run_ids, first_success, last_success, cadence, n_cadences, expected_polls,
n_gaps, list_max(steps) AS max_gap, coalesce(ts[1] - start, 86400.0) AS start_without_success, coalesce(start + 86400.0 - ts[len(ts)], 86400.0) AS end_without_success, least(20, n_gaps) AS gap_samples, attempted_polls - successful_http_polls AS failed_http_polls, successful_http_polls - successful_parse_polls AS parse_failures,
greatest(0, expected_polls - attempted_polls) AS poll_count_shortfall, attempted_polls / expected_polls AS poll_ratio, successful_data_polls / expected_polls AS data_ratio, expected_polls AS expected_raw_snapshots FROM d""",
    "daily_manifest": _J + """, f AS (SELECT event_type, day, count(*) FILTER (WHERE i % 3 = 0) AS raw_snapshots, max(i % 101) < 100 AS clean, count(*) FILTER (WHERE i % 40 = 0) AS files, sum(k) AS rows, count(*) FILTER (WHERE i % 499 = 0) AS pend, count(*) FILTER (WHERE i % 307 = 0) AS tails FROM j0 WHERE dayofweek(day) <> 5 GROUP BY ALL),
x AS (SELECT w.event_type, w.day, d.event_type IS NULL AS nothing, coalesce(attempted_polls, 0) AS a, attempted_polls, coalesce(successful_http_polls, 0) AS h, coalesce(successful_parse_polls, 0) AS p, coalesce(successful_data_polls, 0) AS dt, coalesce(journal_raw_snapshots, 0) AS jr, coalesce(corrupt_journal_lines, 0) AS bad,
 coalesce(event_rows_emitted, 0) AS er, coalesce(expected_polls, 0) AS ex, coalesce(n_cadences, 0) AS nc, coalesce(scheduler_missed_deadlines, 0) AS sm, coalesce(stale_feed_polls, 0) AS st, raw_snapshots, coalesce(raw_snapshots, 0) AS rs, clean, coalesce(files, 0) AS files, coalesce(rows, 0) AS rows, coalesce(pend, 0) AS pend, coalesce(tails, 0) AS tails
 FROM (SELECT DISTINCT day, event_type FROM (SELECT DISTINCT day FROM j0), (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS event_type)) w LEFT JOIN d ON d.event_type = w.event_type AND d.day = w.day LEFT JOIN f ON f.event_type = w.event_type AND f.day = w.day),
y AS (SELECT *, concat_ws(',', CASE WHEN nothing THEN 'missing_poll_journal' END, CASE WHEN a = 0 THEN 'no_poll_attempts' END, CASE WHEN h = 0 THEN 'no_successful_responses' END, CASE WHEN h > 0 AND p = 0 THEN 'no_parsed_responses' END, CASE WHEN jr = 0 THEN 'no_archived_snapshots' END, CASE WHEN bad > 0 THEN 'corrupt_journal_lines' END,
 CASE WHEN clean IS NULL THEN 'raw_log_missing' END, CASE WHEN NOT clean THEN 'raw_log_not_clean' END, CASE WHEN (rs > 0 OR coalesce(clean, false)) AND rs < jr THEN 'raw_records_below_journal' END, CASE WHEN files = 0 THEN 'no_parquet_artifact' END, CASE WHEN files > 0 AND rows < er THEN 'parquet_rows_below_journal' END, CASE WHEN pend > 0 THEN 'pending_spool_segments' END) AS errors,
 concat_ws(',', CASE WHEN a < ex - 1 THEN 'polls_missing' END, CASE WHEN sm > 0 THEN 'scheduler_missed_deadlines' END, CASE WHEN nc > 1 THEN 'cadence_changed' END, CASE WHEN tails > 0 THEN 'recovered_journal_tail' END, CASE WHEN a > h THEN 'failed_polls' END, CASE WHEN h > p THEN 'parse_failures' END,
 CASE WHEN dt < p THEN 'processing_failures' END, CASE WHEN st > 0 THEN 'freshness_incidents' END, CASE WHEN rs < ex * 0.9 THEN 'raw_snapshots_missing' END) AS flags FROM x)
SELECT event_type, day, attempted_polls, raw_snapshots, errors, flags, errors = '' AS complete, flags = '' AS quality_ok FROM y""",
    "coverage_report": _J + """, w AS (SELECT event_type, t, ms, CASE WHEN event_type <> 'view' THEN 900.0 ELSE pi END AS q, fine, fine AND t >= 1704261600 AND t < 1705708800 AS inn, i, k, raw, raw_fine, ok, parsed, data FROM j WHERE day BETWEEN DATE '2024-01-03' AND DATE '2024-01-20'),
v AS (SELECT event_type, count(*) FILTER (WHERE inn) AS journalled_polls, count(*) FILTER (WHERE inn AND data) AS successful_data_polls, count(*) FILTER (WHERE inn AND i % 17 = 0) AS http_failures, count(*) FILTER (WHERE inn AND ok AND NOT parsed) AS parse_failures, count(*) FILTER (WHERE inn AND parsed AND NOT data) AS processing_failures,
 count(*) FILTER (WHERE inn AND i % 50 = 0) AS missed_deadlines, count(*) FILTER (WHERE inn AND raw) AS raw_snapshots, CAST(0 AS BIGINT) AS presence_confirmed_polls, CAST(coalesce(sum(k) FILTER (WHERE inn), 0) AS BIGINT) AS emitted_rows, count(*) FILTER (WHERE inn AND raw AND raw_fine AND NOT data) AS failed_processing_polls_with_raw_evidence,
 count(*) FILTER (WHERE inn AND k > 95) AS freshness_incident_polls, count(*) FILTER (WHERE inn AND k > 90 AND k <= 95) AS freshness_warning_polls, count(*) FILTER (WHERE NOT fine) AS corrupt_lines, list_sort(list(DISTINCT q) FILTER (WHERE inn AND q IS NOT NULL)) AS qs,
 coalesce(string_agg(DISTINCT 'run-' || (i % 3), ',' ORDER BY 'run-' || (i % 3)) FILTER (WHERE inn), '') AS run_ids, list_sort(list(t) FILTER (WHERE inn AND data)) AS ts, list_sort(list(ms) FILTER (WHERE inn AND ms IS NOT NULL)) AS l FROM w GROUP BY event_type),
z AS (SELECT *, CASE WHEN len(qs) = 1 THEN qs[1] ELSE 1200.0 END AS cad, list_transform(range(1, len(ts)), lambda x: ts[x + 1] - ts[x]) AS steps FROM v),
u AS (SELECT *, CASE WHEN coalesce(len(qs), 0) <= 1 THEN 1447200.0 / cad END AS expected_polls FROM z)
SELECT * EXCLUDE (qs, ts, l, cad, steps), coalesce(array_to_string(list_transform(qs, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), '') AS cadences, successful_data_polls / expected_polls AS data_ratio, CAST(coalesce(len(list_filter(steps, lambda s: s > cad * 1.5)), 0) AS BIGINT) AS n_gaps, list_max(steps) AS max_gap,
coalesce(ts[1] - 1704261600.0, 1447200.0) AS start_without_success, coalesce(1705708800.0 - ts[len(ts)], 1447200.0) AS end_without_success, l[CAST(floor((len(l) - 1) * 0.95) AS BIGINT) + 1] AS processing_p95, list_max(l) AS processing_max FROM u""",
    "observed_days": _J + """, r AS (SELECT event_type, day, count(*) AS n FROM j0 WHERE day(day) % 4 <> 0 AND day(day) % 7 <> 0 GROUP BY ALL),
e AS (SELECT event_type, day, count(*) FILTER (WHERE parsed) AS p, coalesce(sum(k) FILTER (WHERE parsed AND day(day) % 4 <> 0), 0) AS er FROM j GROUP BY ALL)
SELECT e.event_type, e.day, CASE WHEN n > 0 THEN 'rows' WHEN p > 0 AND er = 0 THEN 'observed_empty' ELSE 'missing' END AS state, coalesce(n, 0) AS n_rows FROM e LEFT JOIN r ON r.event_type = e.event_type AND r.day = e.day""",
    "latest_snapshot": "SELECT event_type, event_id, user_id FROM events QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1",
    "first_daytime_snapshots": """WITH h AS (SELECT event_id, event_type, CAST(ts AS DATE) AS day FROM events WHERE hour(ts) >= 6 AND hour(ts) < 18)
SELECT event_id FROM (SELECT *, dense_rank() OVER (PARTITION BY event_type ORDER BY day) AS n FROM h) WHERE n <= 5""",
}
_P = """WITH cat AS (SELECT CAST(n_nationkey AS VARCHAR) AS route, upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS label, ['tram','metro','trolleybus','bus','ferry','rail','other'][n_regionkey + 1] AS mode, CASE WHEN n_nationkey % 2 = 0 THEN '#' || substr(md5(n_name), 1, 6) END AS color FROM nation WHERE n_nationkey % 5 <> 0),
v AS (SELECT c_custkey AS k, substr(sha256(CASE WHEN c_custkey % 4 <> 0 THEN 'v' || (c_custkey // 2) ELSE CAST(c_custkey AS VARCHAR) END), 1, 20) AS id, round(c_acctbal / 50, 6) AS lon, round(c_acctbal / 100, 6) AS lat, CASE WHEN c_custkey % 9 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS route, CASE WHEN c_acctbal / 10 BETWEEN 0 AND 360 THEN c_acctbal / 10 END AS bearing
 FROM customer WHERE c_acctbal <> 0 AND c_custkey % 31 <> 0 AND c_acctbal / 50 BETWEEN -180 AND 180 AND c_acctbal / 100 BETWEEN -90 AND 90),
p AS (SELECT id, lon, lat, coalesce(label, v.route, 'Unassigned') AS label, coalesce(mode, 'other') AS mode, coalesce(color, '#009fe3') AS color, bearing, k AS recorded_at FROM v LEFT JOIN cat ON cat.route = v.route QUALIFY row_number() OVER (PARTITION BY id ORDER BY k) = 1 ORDER BY k LIMIT 10000)
"""
SQL |= {
    "public_projection": _P + "SELECT * FROM p",
    "public_contract": _P + """, b AS (SELECT recorded_at, CASE WHEN recorded_at % 20 = 1 THEN 'twice' ELSE id END AS id, CASE WHEN recorded_at % 33 = 2 THEN 'hev' ELSE mode END AS mode, CASE WHEN recorded_at % 41 = 3 THEN lat + 100 ELSE lat END AS lat FROM p), n AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM b)
SELECT recorded_at, 'invalid_id' AS violation FROM n WHERE id = 'twice' UNION ALL SELECT recorded_at, 'repeated_id' FROM n WHERE n > 1 UNION ALL SELECT recorded_at, 'latitude' FROM n WHERE NOT lat BETWEEN -90 AND 90
UNION ALL SELECT recorded_at, 'mode' FROM n WHERE mode = 'hev' UNION ALL SELECT NULL, 'unknown_column:secret'""",
    "public_states": """WITH e AS (SELECT event_id AS i, (CAST(json_extract_string(props, '$.k') AS INTEGER) - 20) * 3 AS age FROM events),
s AS (SELECT i, CASE WHEN i % 23 <> 0 THEN age END AS age, concat_ws(',', CASE WHEN i % 13 = 0 THEN 'absent' END, CASE WHEN i % 5 = 0 THEN 'payload_unchanged_warning' END, CASE WHEN i % 17 = 0 THEN 'protobuf_parse_failed' END, CASE WHEN i % 38 = 0 THEN 'raw_archive_failed' END, CASE WHEN i % 11 = 0 THEN 'scheduler_missed_deadline' END) AS issues, i % 13 = 0 OR i % 17 = 0 OR i % 38 = 0 AS bad FROM e)
SELECT i AS event_id, issues, CASE WHEN age IS NULL OR age < -30 OR age > 180 THEN 'unknown' WHEN bad THEN 'degraded' ELSE 'healthy' END AS state FROM s""",
}
QUERIES = {f.__name__: f for f in (feed_days, daily_manifest, coverage_report, observed_days, latest_snapshot, first_daytime_snapshots, public_projection, public_contract, public_states)}
