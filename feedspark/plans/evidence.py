"""Evidence and archive queries on events, orders, lineitem, documents, conversations and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.operators import evidence as op
from feedspark.operators import presence
from feedspark.plans.tables import events, table


def source_timestamp_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A poll is a day (the 15th is missing), a trip a user, its source timestamp the hour of the user's last event."""
    e = events(spark, sf_dir).filter(F.dayofmonth("day") != 15)
    seen = e.groupBy("day", "user_id").agg(F.hour(F.max("ts")).cast("long").alias("stamp"))
    grid = presence.poll_grid(e.select("day").distinct(), "day", F.date_diff("day", "_before") > 1)
    gone = presence.membership_changes(seen, grid, "day", ["user_id"]).filter("change = 'withdrawn'")
    spans = op.source_timestamp_spans(op.source_timestamp_updates(seen, grid, "day", ["user_id"], "stamp"), gone, grid, "day", ["user_id"], "stamp")
    return spans.select("user_id", *[F.col(c).cast("long").alias(c) for c in ("segment", "from_no", "until_no")], "stamp")


def presence_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders promise their customer and date; line items are the records."""
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").filter("l_linenumber <= 2 and l_orderkey % 9 <> 0")
    records = li.filter("l_linenumber = 1 or l_orderkey % 5 = 0").select(F.col("l_orderkey").alias("poll"), F.when(F.col("l_orderkey") % 4 == 0, "b").otherwise("a").alias("stream"), F.lit(1).alias("version"))
    promised = o.select(F.col("o_orderkey").alias("poll"), F.lit("a").alias("stream"), F.when(F.col("o_orderkey") % 7 == 0, 2).when(F.col("o_orderkey") % 3 == 0, 1).alias("version"))
    return op.reconcile_promises(promised, records, ["poll"], ["stream"], ["version"])


def presence_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate"))
    k = F.col("o_orderkey")
    journal = o.select("date", k.alias("poll"), (k % 5 != 0).alias("presence_required"), F.when(k % 11 != 0, k % 7 != 0).alias("presence_ok"), (F.col("o_orderstatus") != "P").alias("parse_ok"))
    records = o.filter("o_orderstatus <> 'O'").select("date", F.when(k % 10 == 0, "baseline").otherwise("delta").alias("kind"), F.when(k % 3 == 0, 1).alias("source_timestamps_version"))
    return op.presence_statistics(journal, records, ["date"], "poll")


def run_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.when(F.col("doc_id") % 6 == 0, F.concat(F.lit("run-"), F.col("doc_id") % 12)).otherwise(F.md5(F.concat_ws("/", "source", "lang"))).alias("run"), "source")
    return op.run_provenance(d, d.filter("source not like '%1%'").select("run"), "run")


def journal_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation is a journal, a turn a line; long lines count as damaged."""
    c = table(spark, sf_dir, "conversations")
    return op.journal_tail(c, "conv_id", "turn", F.length("text") % 7 == 0)


def field_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    rows = li.select("l_linestatus", F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("tax"), F.when(F.col("l_discount") > 0.04, "[1]").otherwise("[]").alias("parts"))
    return op.population(rows, ["tax", "parts"], ["l_linestatus"])


def entity_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("t", F.when(F.col("k") % 10 != 0, F.unix_timestamp("ts")).otherwise(0))
    polls = e.groupBy("day", "user_id").agg(F.collect_list(F.struct("t")).alias("entities"))
    return op.entity_time_range(polls, "entities", lambda x: x["t"]).drop("entities")


def manifest_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's feeds are its order states; artifacts are paths of orders."""
    o = table(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate")).withColumnRenamed("o_orderstatus", "feed")
    urgent = F.count_if(F.col("o_orderpriority") == "1-URGENT").alias
    stats = o.groupBy("date", "feed").agg(
        F.count(F.lit(1)).alias("successful_http_polls"), F.count_if(F.col("o_orderkey") % 2 == 0).alias("successful_parse_polls"), urgent("raw_snapshots"), F.lit(1).alias("parquet_files"),
        F.count_if(F.col("o_totalprice") > 450000).alias("pending_spool_segments"), (F.max("o_totalprice") < 400000).alias("raw_log_clean"),
    )
    paths = o.filter("o_orderpriority <> '5-LOW'").select("date", F.concat(F.lit("raw/"), "feed", F.lit("/date="), F.col("date").cast("string")).alias("path"))
    wanted = {"no_raw_artifact": F.concat(F.lit("raw/"), "feed", F.lit("/date="), F.col("date").cast("string"))}
    return op.manifest_violations(stats, paths, "date", "feed", "path", ["F", "O"], wanted)


def representative_artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.concat("l_linestatus", "l_linenumber").alias("kind"), F.concat_ws("/", "l_orderkey", "l_linenumber", "l_returnflag").alias("path"), F.col("l_extendedprice").cast("long").alias("size"))
    return op.representatives(li, "kind", "path", "size", {"F1": "/R", "O2": "/N"})


def manifest_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("path"), F.col("n_chars").cast("long").alias("size"), (F.col("doc_id") * 10).alias("mtime"))
    now = d.filter("path % 97 <> 3").select("path", F.when(F.col("path") % 89 == 5, F.col("size") + 1).otherwise(F.col("size")).alias("size"), "mtime")
    return op.manifest_reusable(d.withColumn("part", F.col("path") % 13), now, ["source", "part"], "path")


def backlog_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.to_date("o_orderdate").alias("date")).distinct()
    return op.backlog_state(o, "date", F.lit("1998-08-02 00:00:00").cast("timestamp"))


def new_static_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders are checks of a dataset, their priority its content."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", F.col("o_orderkey").alias("path"))
    return op.new_versions(o, ["o_custkey"], ["o_orderkey"], "o_orderpriority", "path").select("o_custkey", "o_orderkey", "is_new", "stored_as")


def completed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return op.completed_dates(F.lit("1997-06-01").cast("date"), o.select(F.to_date("o_orderdate").alias("date")), li.select(F.to_date("l_shipdate").alias("date")))


def publication_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.when(F.col("c_nationkey") > 4, F.col("c_nationkey")).cast("long").alias("nation"))
    return c.select("c_custkey", op.publication_row(["c_name", "c_custkey", "nation"]).alias("row"))


def publication_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = publication_rows(spark, sf_dir)
    return rows.select(*op.publication_columns(F.col("row"), {"c_name": "string", "c_custkey": "bigint", "nation": "bigint"}))


_O = "SELECT *, CAST(o_orderdate AS DATE) AS date FROM orders"
SQL = {
    "source_timestamp_replay": """WITH s AS (SELECT CAST(ts AS DATE) AS day, user_id, CAST(hour(max(ts)) AS BIGINT) AS stamp FROM events WHERE day(ts) <> 15 GROUP BY ALL),
p AS (SELECT day, lag(day) OVER (ORDER BY day) AS before FROM (SELECT DISTINCT day FROM s)),
g AS (SELECT day, row_number() OVER (ORDER BY day) AS no, sum(CASE WHEN before IS NULL OR day - before > 1 THEN 1 ELSE 0 END) OVER (ORDER BY day) AS segment FROM p),
m AS (SELECT user_id, segment, no, stamp, CASE WHEN lag(no) OVER w = no - 1 AND lag(stamp) OVER w = stamp THEN 0 ELSE 1 END AS fresh FROM s JOIN g USING (day) WINDOW w AS (PARTITION BY user_id, segment ORDER BY no)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id, segment ORDER BY no) AS run FROM m)
SELECT user_id, CAST(segment AS BIGINT) AS segment, min(no) AS from_no, max(no) + 1 AS until_no, stamp FROM r GROUP BY user_id, segment, run, stamp""",
    "presence_reconcile": """WITH r AS (SELECT l_orderkey AS poll, count(*) AS n FROM lineitem WHERE l_orderkey % 9 <> 0 AND (l_linenumber = 1 OR l_linenumber = 2 AND l_orderkey % 5 = 0) GROUP BY 1),
j AS (SELECT o_orderkey AS poll, CASE WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'duplicate' WHEN o_orderkey % 4 = 0 OR o_orderkey % 7 = 0 THEN 'mismatched' END AS problem FROM orders LEFT JOIN r ON poll = o_orderkey)
SELECT * FROM j WHERE problem IS NOT NULL""",
    "presence_statistics": f"""WITH o AS ({_O}),
a AS (SELECT date, count(*) FILTER (WHERE o_orderkey % 5 <> 0 AND o_orderstatus <> 'P') AS expected, count(*) FILTER (WHERE o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 7 <> 0) AS confirmed, count(*) FILTER (WHERE o_orderkey % 5 = 0 AND o_orderstatus <> 'P') AS legacy,
count(*) FILTER (WHERE o_orderstatus <> 'O') AS records, count(*) FILTER (WHERE o_orderstatus <> 'O' AND o_orderkey % 10 = 0) AS baselines, count(*) FILTER (WHERE o_orderstatus <> 'O' AND o_orderkey % 3 = 0) AS source_timestamp_observations FROM o GROUP BY date)
SELECT *, expected - confirmed AS unavailable FROM a""",
    "run_provenance": """WITH d AS (SELECT CASE WHEN doc_id % 6 = 0 THEN 'run-' || (doc_id % 12) ELSE md5(concat_ws('/', source, lang)) END AS run, source FROM documents),
b AS (SELECT run, bool_or(source NOT LIKE '%1%') AS known, regexp_matches(run, '^[0-9a-f]{32}$') AS fine FROM d GROUP BY run)
SELECT run, CASE WHEN fine THEN 'missing_run_record' ELSE 'invalid_run_id' END AS problem FROM b WHERE NOT fine OR NOT coalesce(known, false)""",
    "journal_tail": """WITH l AS (SELECT conv_id, turn, coalesce(length(text) % 7 = 0, false) AS bad, turn = max(turn) OVER (PARTITION BY conv_id) AS tail FROM conversations)
SELECT conv_id, count(*) FILTER (WHERE bad) AS n_corrupt, CASE WHEN count(*) FILTER (WHERE bad) = 1 AND bool_or(bad AND tail) THEN 'torn_tail' ELSE 'interior_corruption' END AS state FROM l GROUP BY conv_id HAVING count(*) FILTER (WHERE bad) > 0""",
    "field_population": "SELECT l_linestatus, count(*) AS n_rows, count(*) FILTER (WHERE l_tax > 0) AS n_tax, count(*) FILTER (WHERE l_discount > 0.04) AS n_parts FROM lineitem GROUP BY 1",
    "entity_time_range": """WITH e AS (SELECT CAST(ts AS DATE) AS day, user_id, CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 <> 0 THEN CAST(floor(epoch(ts)) AS BIGINT) END AS t FROM events)
SELECT day, user_id, min(t) AS entity_time_min, max(t) AS entity_time_max FROM e GROUP BY ALL""",
    "manifest_violations": f"""WITH o AS ({_O}), d AS (SELECT DISTINCT date, feed FROM o, (VALUES ('F'), ('O')) v(feed)),
s AS (SELECT date, o_orderstatus AS feed, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS parsed, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS raw, count(*) FILTER (WHERE o_totalprice > 450000) AS pend, max(o_totalprice) < 400000 AS clean, count(*) FILTER (WHERE o_orderpriority <> '5-LOW') AS paths FROM o GROUP BY ALL),
j AS (SELECT d.date, d.feed, s.feed IS NULL AS none, parsed, raw, pend, clean, coalesce(paths, 0) AS paths FROM d LEFT JOIN s ON s.date = d.date AND s.feed = d.feed)
SELECT date, feed, 'no_statistics' AS rule FROM j WHERE none UNION ALL SELECT date, feed, 'no_successful_parse_polls' FROM j WHERE parsed < 1 UNION ALL SELECT date, feed, 'no_raw_snapshots' FROM j WHERE raw < 1
UNION ALL SELECT date, feed, 'pending_spool_segments' FROM j WHERE pend <> 0 UNION ALL SELECT date, feed, 'raw_log_not_clean' FROM j WHERE NOT clean UNION ALL SELECT date, feed, 'no_raw_artifact' FROM j WHERE paths = 0""",
    "representative_artifacts": """WITH a AS (SELECT l_linestatus || l_linenumber AS kind, concat_ws('/', l_orderkey, l_linenumber, l_returnflag) AS path, CAST(trunc(l_extendedprice) AS BIGINT) AS size FROM lineitem)
SELECT kind, path, size FROM a WHERE (kind <> 'F1' OR path LIKE '%/R') AND (kind <> 'O2' OR path LIKE '%/N') QUALIFY row_number() OVER (PARTITION BY kind ORDER BY size, path) = 1""",
    "manifest_reuse": "SELECT source, doc_id % 13 AS part, count(*) AS n_artifacts, bool_and(doc_id % 97 <> 3 AND doc_id % 89 <> 5) AS reusable FROM documents GROUP BY ALL",
    "backlog_state": "SELECT count(DISTINCT CAST(o_orderdate AS DATE)) AS n_pending, CAST(min(o_orderdate) AS DATE) AS oldest, min(o_orderdate) < DATE '1998-07-31' AS stale FROM orders WHERE o_orderstatus = 'P'",
    "new_static_versions": """SELECT o_custkey, o_orderkey, o_orderpriority IS DISTINCT FROM lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS is_new, min(o_orderkey) OVER (PARTITION BY o_custkey, o_orderpriority) AS stored_as FROM orders""",
    "completed_dates": "SELECT CAST(o_orderdate AS DATE) AS date FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1997-06-01' UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE CAST(l_shipdate AS DATE) < DATE '1997-06-01'",
    "publication_rows": """SELECT c_custkey, '["' || c_name || '",' || c_custkey || ',' || coalesce(CAST(CASE WHEN c_nationkey > 4 THEN c_nationkey END AS VARCHAR), 'null') || ']' AS row FROM customer""",
    "publication_round_trip": "SELECT c_name, CAST(c_custkey AS BIGINT) AS c_custkey, CAST(CASE WHEN c_nationkey > 4 THEN c_nationkey END AS BIGINT) AS nation FROM customer",
}
QUERIES = {
    f.__name__: f
    for f in (
        source_timestamp_replay, presence_reconcile, presence_statistics, run_provenance, journal_tail, field_population, entity_time_range, manifest_violations,
        representative_artifacts, manifest_reuse, backlog_state, new_static_versions, completed_dates, publication_rows, publication_round_trip,
    )
}
