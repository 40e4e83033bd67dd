"""Presence on events: a poll is a day (the 15th is missing), a trip a user, a stop an event type."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedspark.operators import presence as op
from feedspark.plans.tables import events, table


def _parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = events(spark, sf_dir).filter(F.dayofmonth("day") != 15).select("day", "user_id", "event_type")
    return e, op.poll_grid(e.select("day").distinct(), "day", F.date_diff("day", "_before") > 1)


def presence_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, grid = _parts(spark, sf_dir)
    return op.membership_changes(members, grid, "day", ["user_id", "event_type"])


def presence_trip_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = op.trip_deltas(presence_diff(spark, sf_dir), "day", ["user_id"], "event_type")
    return got.select("day", "user_id", F.array_join("entered", ",").alias("entered"), F.array_join("withdrawn", ",").alias("withdrawn"))


def presence_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, grid = _parts(spark, sf_dir)
    changes = op.membership_changes(members, grid, "day", ["user_id", "event_type"])
    return op.replay(changes, grid, "day").withColumn("segment", F.col("segment").cast("long"))


def presence_sequence_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    o = table(spark, sf_dir, "orders").withColumn("seq", F.row_number().over(w)).filter(F.col("o_orderkey") % 97 != 0)
    return op.sequence_check(o, ["o_custkey"], ["seq"], "seq")


_P = """WITH m AS (SELECT DISTINCT CAST(ts AS DATE) AS day, user_id, event_type FROM events WHERE day(ts) <> 15),
p AS (SELECT day, lag(day) OVER (ORDER BY day) AS before FROM (SELECT DISTINCT day FROM m)),
g AS (SELECT day, before, before IS NULL OR day - before > 1 AS baseline, sum(CASE WHEN before IS NULL OR day - before > 1 THEN 1 ELSE 0 END) OVER (ORDER BY day) AS segment FROM p),
c AS (SELECT m.day, m.user_id, m.event_type, 'baseline' AS change FROM m JOIN g ON m.day = g.day WHERE g.baseline
UNION ALL SELECT m.day, m.user_id, m.event_type, 'entered' FROM m JOIN g ON m.day = g.day WHERE NOT g.baseline AND NOT EXISTS (SELECT 1 FROM m x WHERE x.day = g.before AND x.user_id = m.user_id AND x.event_type = m.event_type)
UNION ALL SELECT g.day, x.user_id, x.event_type, 'withdrawn' FROM g JOIN m x ON x.day = g.before WHERE NOT g.baseline AND NOT EXISTS (SELECT 1 FROM m WHERE m.day = g.day AND x.user_id = m.user_id AND x.event_type = m.event_type))
"""
SQL = {
    "presence_diff": _P + "SELECT * FROM c",
    "presence_trip_deltas": _P + """SELECT day, user_id, coalesce(string_agg(CASE WHEN change <> 'withdrawn' THEN event_type END, ',' ORDER BY event_type), '') AS entered,
coalesce(string_agg(CASE WHEN change = 'withdrawn' THEN event_type END, ',' ORDER BY event_type), '') AS withdrawn FROM c GROUP BY day, user_id""",
    "presence_replay": _P + "SELECT g.day, CAST(g.segment AS BIGINT) AS segment, count(*) AS members FROM g JOIN m ON g.day = m.day GROUP BY ALL",
    "presence_sequence_check": """WITH o AS (SELECT * FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq FROM orders) WHERE o_orderkey % 97 <> 0),
s AS (SELECT *, seq - lag(seq) OVER (PARTITION BY o_custkey ORDER BY seq) AS step FROM o)
SELECT o_custkey, count(*) AS n_records, min(seq) = 1 AS starts_at_one, count(CASE WHEN step <> 1 THEN 1 END) AS n_breaks FROM s GROUP BY o_custkey""",
}
QUERIES = {f.__name__: f for f in (presence_diff, presence_trip_deltas, presence_replay, presence_sequence_check)}
