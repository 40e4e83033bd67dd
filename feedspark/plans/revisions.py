"""Revisions of a user's event value, in cents, and sampling intervals by event type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.operators import revisions as op
from feedspark.plans.tables import events


def _histogram(spark: SparkSession, sf_dir: str, by: list[str] | None = None) -> DataFrame:
    e = events(spark, sf_dir).withColumn("cents", F.round(F.col("value") * 100).cast("long"))
    return op.revision_histogram(op.consecutive_delta(e, ["user_id"], ["ts", "event_id"], "cents"), by)


def revision_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _histogram(spark, sf_dir)


def revision_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.lower_quantiles(_histogram(spark, sf_dir, ["event_type"]), ["event_type"])


def revision_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.threshold_shares(_histogram(spark, sf_dir))


def suppression_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.threshold_shares(_histogram(spark, sf_dir), (0, 5, 10, 15, 20, 30, 60), above=False)


def revision_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.most_common(_histogram(spark, sf_dir))


def sampling_comparability(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("sec", F.col("us") / 1e6)
    return op.sampling_intervals(e, ["event_type"], ["ts", "event_id"], "sec", 1000.0, "day")


_HIST = """WITH d AS (SELECT event_type, CAST(round(value * 100) AS BIGINT) - lag(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS delta FROM events WHERE value IS NOT NULL),
h AS (SELECT {by} abs(delta) AS revision, count(*) AS n FROM d WHERE delta IS NOT NULL GROUP BY ALL)
"""
_SHARES = _HIST.format(by="") + """SELECT threshold, CAST(sum(CASE WHEN revision {op} threshold THEN n ELSE 0 END) AS BIGINT) AS n,
100.0 * sum(CASE WHEN revision {op} threshold THEN n ELSE 0 END) / sum(n) AS percent
FROM h, (SELECT CAST(unnest([{values}]) AS INTEGER) AS threshold) GROUP BY threshold"""

SQL = {
    "revision_histogram": _HIST.format(by="") + "SELECT revision, n FROM h",
    "revision_quantiles": _HIST.format(by="event_type,") + """, c AS (SELECT *, sum(n) OVER (PARTITION BY event_type ORDER BY revision) AS upto, sum(n) OVER (PARTITION BY event_type) AS total FROM h)
SELECT event_type, CAST(sum(n) AS BIGINT) AS n, """ + ", ".join(f"min(CASE WHEN upto > floor((total - 1) * {q}) THEN revision END) AS p{round(q * 100)}" for q in op.QUANTILES) + ", max(revision) AS largest FROM c GROUP BY event_type",
    "revision_thresholds": _SHARES.replace("{op}", ">").replace("{values}", "0,1,2,5,10,15,20,30,60"),
    "suppression_rates": _SHARES.replace("{op}", "<=").replace("{values}", "0,5,10,15,20,30,60"),
    "revision_top20": _HIST.format(by="") + "SELECT revision, n FROM h ORDER BY n DESC, revision LIMIT 20",
    "sampling_comparability": """WITH g AS (SELECT event_type, (epoch_us(ts) / 1e6) - lag(epoch_us(ts) / 1e6) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS gap FROM events),
m AS (SELECT event_type, median(gap) FILTER (WHERE gap >= 0) AS median_interval FROM g GROUP BY event_type)
SELECT event_type, coalesce(median_interval, CAST('inf' AS DOUBLE)) AS median_interval, coalesce(median_interval, CAST('inf' AS DOUBLE)) <= 1500 AS comparable FROM m""",
}
QUERIES = {f.__name__: f for f in (revision_histogram, revision_quantiles, revision_thresholds, suppression_rates, revision_top20, sampling_comparability)}
