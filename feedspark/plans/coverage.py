"""Coverage and health on events: a feed is an event type, an event a poll."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.operators import coverage as op
from feedspark.operators import health
from feedspark.plans.tables import events


def _polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("sec", F.col("us") / 1e6)
    return e.withColumns({"success": F.col("event_id") % 17 != 0, "parse_ok": F.col("event_id") % 13 != 0})


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = ["event_type", "day"]
    return op.with_cadence(op.intervals(_polls(spark, sf_dir), stream, "sec", ["ts", "event_id"]), stream, 10.0)


def observation_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.gap_summary(_timed(spark, sf_dir), ["event_type", "day"])


def gap_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.first_gaps(_timed(spark, sf_dir), ["event_type"], ["ts", "event_id"], "day").select("event_type", "gap_no", "event_id", "gap")


def daily_feed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = op.data_poll_success(F.col("success"), F.col("parse_ok"))
    got = _timed(spark, sf_dir).groupBy("event_type", "day", "cadence").agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if("success").alias("responses"), F.count_if("parse_ok").alias("parsed"), F.count_if(data).alias("data_polls"),
        F.sum("k").alias("misses"), F.count_distinct("user_id").alias("runs"), F.min(F.when(data, F.col("us"))).alias("first_us"), F.max(F.when(data, F.col("us"))).alias("last_us"),
    )
    return got.withColumn("expected", op.expected_polls(F.col("cadence"))).withColumn("coverage", op.coverage_percent(F.col("data_polls"), F.col("expected")))


def window_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    since, until = (F.lit(x).cast("timestamp") for x in ("2024-01-03 06:00:00", "2024-01-20"))
    p = _polls(spark, sf_dir).filter((F.col("ts") >= since) & (F.col("ts") < until))
    counts = p.groupBy("event_type").agg(F.count(F.lit(1)).alias("attempts"), F.count_if("success").alias("responses"), F.count_if(op.data_poll_success(F.col("success"), F.col("parse_ok"))).alias("data_polls"), F.sum("k").alias("misses"), F.max("value").alias("max_value"))
    return counts.join(op.lower_quantile(p, ["event_type"], "value", 0.95, "p95_value"), "event_type", "left")


def quality_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = daily_feed_stats(spark, sf_dir)
    errors = [("no_data_polls", F.col("data_polls") == 0), ("parse_failures", F.col("parsed") < F.col("attempts") - 1)]
    flags = [("coverage_shortfall", F.col("coverage") < 90), ("reported_misses_warning", F.col("misses") > 700)]
    got = op.verdict(s, errors, flags)
    return got.select("event_type", "day", F.array_join("errors", ",").alias("errors"), F.array_join("flags", ",").alias("flags"), "complete", "quality_ok")


def consecutive_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = health.consecutive_failures(_polls(spark, sf_dir), ["event_type"], ["ts", "event_id"], F.col("success") & F.col("parse_ok"), "day")
    return got.select("event_id", "failures")


def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _polls(spark, sf_dir).withColumn("content", F.floor(F.col("value") / 20))
    return health.unchanged_since(p, ["event_type"], ["ts", "event_id"], "content", "us", "since_us", "day")


def unchanged_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _content(spark, sf_dir).select("event_id", "since_us")


def _fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    now, since = F.col("us") / 1e6, F.col("since_us") / 1e6
    advisory, empty = F.col("event_type") == "error", F.col("value") < 5
    return health.freshness(_content(spark, sf_dir), now, now - 4 * F.col("k"), since, since, advisory, empty, (180, 1800, 7200), F.when(F.col("value") > 90, now - 8 * F.col("k")))


def freshness_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fresh(spark, sf_dir).select("event_id", F.array_join("flags", ",").alias("flags"))


def feed_health_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = health.health_as_of(_fresh(spark, sf_dir), ["event_type"], "us", 1705708800000000, F.col("success"), F.col("flags"), 600e6, 300e6)
    return got.select("event_type", "last_success", F.array_join("reasons", ",").alias("reasons"), F.array_join("warnings", ",").alias("warnings"), "healthy")


_T = """WITH p AS (SELECT *, CAST(ts AS DATE) AS day, epoch_us(ts) AS us, epoch_us(ts) / 1e6 AS sec, event_id % 17 <> 0 AS success, event_id % 13 <> 0 AS parse_ok, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
g AS (SELECT *, sec - lag(sec) OVER (PARTITION BY event_type, day ORDER BY ts, event_id) AS gap FROM p),
c AS (SELECT event_type, day, coalesce(list_sort(list(gap) FILTER (WHERE gap >= 5))[count(CASE WHEN gap >= 5 THEN 1 END) // 2 + 1], 10.0) AS cadence FROM g GROUP BY ALL),
t AS (SELECT g.*, c.cadence FROM g JOIN c ON g.event_type = c.event_type AND g.day = c.day),
s AS (SELECT event_type, day, cadence, count(*) AS attempts, count_if(success) AS responses, count_if(parse_ok) AS parsed, count_if(success AND parse_ok) AS data_polls, sum(k) AS misses, count(DISTINCT user_id) AS runs,
 min(CASE WHEN success AND parse_ok THEN us END) AS first_us, max(CASE WHEN success AND parse_ok THEN us END) AS last_us, greatest(1, CAST(round_even(86400.0 / cadence, 0) AS BIGINT)) AS expected FROM t GROUP BY ALL),
d AS (SELECT event_type, day, cadence, attempts, CAST(responses AS BIGINT) AS responses, CAST(parsed AS BIGINT) AS parsed, CAST(data_polls AS BIGINT) AS data_polls, CAST(misses AS BIGINT) AS misses, runs, first_us, last_us, expected, round(100.0 * data_polls / expected, 2) AS coverage FROM s),
u AS (SELECT *, max(began) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS since_us FROM (SELECT *, CASE WHEN row_number() OVER w = 1 OR floor(value / 20) IS DISTINCT FROM lag(floor(value / 20)) OVER w THEN us END AS began FROM p WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id))),
f AS (SELECT *, list_filter([CASE WHEN event_type <> 'error' AND 4 * k > 180 THEN 'source_timestamp_stale' END, CASE WHEN event_type <> 'error' AND us - since_us > 1800000000 THEN 'payload_frozen' END,
 CASE WHEN event_type <> 'error' AND us - since_us > 1800000000 THEN 'source_timestamp_frozen' END, CASE WHEN event_type = 'error' AND (4 * k > 180 OR us - since_us > CAST(7200000000 AS BIGINT)) THEN 'source_timestamp_unchanged_warning' END,
 CASE WHEN event_type = 'error' AND value >= 5 AND us - since_us > CAST(7200000000 AS BIGINT) THEN 'payload_unchanged_warning' END, CASE WHEN event_type <> 'error' AND value > 90 AND 8 * k > 180 THEN 'entity_timestamp_stale' END], lambda x: x IS NOT NULL) AS flags FROM u)
"""
SQL = {
    "observation_gaps": _T + "SELECT event_type, day, cadence, count(*) AS n_polls, count(CASE WHEN gap > 1.5 * cadence THEN 1 END) AS n_gaps, max(gap) AS max_gap FROM t GROUP BY ALL",
    "gap_samples": _T + "SELECT * FROM (SELECT event_type, CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS INTEGER) AS gap_no, event_id, gap FROM t WHERE gap > 1.5 * cadence) WHERE gap_no <= 20",
    "daily_feed_stats": _T + "SELECT * FROM d",
    "window_coverage": _T + """SELECT event_type, count(*) AS attempts, CAST(count_if(success) AS BIGINT) AS responses, CAST(count_if(success AND parse_ok) AS BIGINT) AS data_polls, CAST(sum(k) AS BIGINT) AS misses, max(value) AS max_value,
list_sort(list(value))[CAST(floor((count(value) - 1) * 0.95) AS BIGINT) + 1] AS p95_value FROM p WHERE ts >= TIMESTAMP '2024-01-03 06:00:00' AND ts < TIMESTAMP '2024-01-20' GROUP BY event_type""",
    "quality_verdict": _T + """, v AS (SELECT event_type, day, array_to_string(list_filter([CASE WHEN data_polls = 0 THEN 'no_data_polls' END, CASE WHEN parsed < attempts - 1 THEN 'parse_failures' END], lambda x: x IS NOT NULL), ',') AS errors,
array_to_string(list_filter([CASE WHEN coverage < 90 THEN 'coverage_shortfall' END, CASE WHEN misses > 700 THEN 'reported_misses_warning' END], lambda x: x IS NOT NULL), ',') AS flags, coverage FROM d)
SELECT event_type, day, errors, flags, errors = '' AS complete, NOT coalesce(coverage < 90, false) AS quality_ok FROM v""",
    "consecutive_failures": _T + """, i AS (SELECT *, sum(CASE WHEN success AND parse_ok THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS island FROM p)
SELECT event_id, CAST(sum(CASE WHEN success AND parse_ok THEN 0 ELSE 1 END) OVER (PARTITION BY event_type, island ORDER BY ts, event_id) AS BIGINT) AS failures FROM i""",
    "unchanged_since": _T + "SELECT event_id, since_us FROM u",
    "freshness_flags": _T + "SELECT event_id, coalesce(array_to_string(flags, ','), '') AS flags FROM f",
    "feed_health_asof": _T + """, l AS (SELECT event_type, max_by(success, us) AS ok, max_by(flags, us) AS flags, max(CASE WHEN success THEN us END) AS last_success FROM f WHERE us <= CAST(1705708800000000 AS BIGINT) GROUP BY event_type),
h AS (SELECT event_type, last_success, list_concat(list_filter([CASE WHEN last_success IS NULL OR CAST(1705708800000000 AS BIGINT) - last_success > 900000000 THEN 'absent' END, CASE WHEN NOT ok THEN 'request_failed' END], lambda x: x IS NOT NULL), list_filter(flags, lambda x: NOT ends_with(x, '_warning'))) AS reasons, list_filter(flags, lambda x: ends_with(x, '_warning')) AS warnings FROM l)
SELECT event_type, last_success, array_to_string(reasons, ',') AS reasons, array_to_string(warnings, ',') AS warnings, len(reasons) = 0 AS healthy FROM h""",
}
QUERIES = {f.__name__: f for f in (observation_gaps, gap_samples, daily_feed_stats, window_coverage, quality_verdict, consecutive_failures, unchanged_since, freshness_flags, feed_health_asof)}
