"""Change compression, thinning and the guard against silent signals, on events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.operators.compression import CompressionPolicy, compress, null_guard, thin
from feedspark.plans.tables import events

HOURS = 3600


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "k", "ts", "day", (F.col("us") / 1e6).alias("sec"))


def compress_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = CompressionPolicy(("user_id",), ("event_type",), {"value": 30.0}, 6 * HOURS)
    return compress(_rows(spark, sf_dir), policy, "sec", ["ts", "event_id"], ["day"]).select("event_id", "user_id", "event_type", "value")


def compress_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    policy = CompressionPolicy(("event_type",), (), {"value": 30.0}, 6 * HOURS)
    return compress(_rows(spark, sf_dir), policy, "sec", ["ts", "event_id"], ["day"], cut=True).select("event_id", "event_type", "value")


def thin_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thin(_rows(spark, sf_dir), ["event_type"], "sec", ["ts", "event_id"], 2.0 * HOURS, F.col("k") % 10 == 0, "day").select("event_id", "event_type")


def silent_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _rows(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz")).withColumn("date", F.to_date("ts"))
    signal = F.when((F.col("event_type") == "purchase") & (F.col("value") > 50), F.col("value"))
    return null_guard(rows, ["hour"], signal, 20, ["date"])


_COMPRESS = """WITH RECURSIVE o AS (SELECT *, epoch_us(ts) AS us, CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY {key}, CAST(ts AS DATE) ORDER BY ts, event_id) AS rn FROM events),
r AS (SELECT {key}, day, rn, event_id, true AS emit, event_type AS lt, value AS lv, us AS lu FROM o WHERE rn = 1
UNION ALL SELECT {key}, day, rn, event_id, emit, CASE WHEN emit THEN event_type ELSE lt END, CASE WHEN emit THEN value ELSE lv END, CASE WHEN emit THEN us ELSE lu END
FROM (SELECT o.{key}, o.day, o.rn, o.event_id, o.event_type, o.value, o.us, r.lt, r.lv, r.lu,
  {exact} (o.value IS NULL) <> (r.lv IS NULL) OR coalesce(abs(o.value - r.lv) > 30, false) OR o.us - r.lu >= CAST(21600000000 AS BIGINT) AS emit
  FROM r JOIN o ON o.{key} = r.{key} AND o.day = r.day AND o.rn = r.rn + 1))
SELECT {out} FROM r JOIN events e USING (event_id) WHERE emit"""

SQL = {
    "compress_events": _COMPRESS.format(key="user_id", exact="o.event_type IS DISTINCT FROM r.lt OR", out="event_id, e.user_id, e.event_type, e.value"),
    "compress_by_type": _COMPRESS.format(key="event_type", exact="", out="event_id, e.event_type, e.value"),
    "thin_snapshots": """WITH RECURSIVE o AS (SELECT event_id, event_type, epoch_us(ts) AS us, CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 = 0 AS forced, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events),
r AS (SELECT event_type, rn, event_id, true AS keep, us AS lu FROM o WHERE rn = 1
UNION ALL SELECT o.event_type, o.rn, o.event_id, o.forced OR o.us - r.lu >= CAST(7200000000 AS BIGINT), CASE WHEN o.forced OR o.us - r.lu >= CAST(7200000000 AS BIGINT) THEN o.us ELSE r.lu END
FROM r JOIN o ON o.event_type = r.event_type AND o.rn = r.rn + 1)
SELECT event_id, event_type FROM r WHERE keep""",
    "silent_signals": """WITH p AS (SELECT CAST(ts AS DATE) AS date, date_trunc('hour', ts) AS hour, count(*) AS n_rows, count(CASE WHEN event_type = 'purchase' AND value > 50 THEN 1 END) AS n_signals FROM events GROUP BY ALL),
i AS (SELECT *, sum(CASE WHEN n_signals > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY date ORDER BY hour) AS island FROM p),
s AS (SELECT date, hour, n_rows, n_signals, CAST(sum(CASE WHEN n_signals = 0 THEN n_rows ELSE 0 END) OVER (PARTITION BY date, island ORDER BY hour) AS BIGINT) AS silent_rows FROM i)
SELECT *, silent_rows >= 20 AS tripped FROM s""",
}
QUERIES = {f.__name__: f for f in (compress_events, compress_by_type, thin_snapshots, silent_signals)}
