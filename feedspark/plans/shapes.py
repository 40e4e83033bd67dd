"""Flattening, publication and archive queries on orders, customers, suppliers, documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedspark.functions import scalars as fn
from feedspark.operators import archive, coverage, flatten
from feedspark.plans.tables import table


def flatten_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    fields = ["l_linenumber", "l_suppkey", "l_partkey", "l_quantity"]
    nested = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("items"))
    return flatten.explode_outer_rows(o.select("o_orderkey", "o_custkey").join(nested, "o_orderkey", "left"), "items", fields, "pos")


def flatten_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "orders").filter("o_totalprice > 400000")
    nested = big.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderstatus"))).alias("selectors"))
    c = table(spark, sf_dir, "customer").select("c_custkey").join(nested, "c_custkey", "left")
    c = c.withColumn("selectors_json", F.coalesce(flatten.canonical_json(F.col("selectors")), F.lit("[]")))
    return flatten.explode_outer_rows(c, "selectors", ["o_orderkey", "o_orderstatus"], "pos")


def enum_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = fn.optional_int(F.substring("o_orderpriority", 1, 1))
    names = {1: "URGENT", 2: "HIGH", 3: "MEDIUM", 4: "NOT_SPECIFIED"}
    return table(spark, sf_dir, "orders").select("o_orderkey", number.alias("number"), fn.enum_name(number.cast("int"), names).alias("name"))


def route_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("s_suppkey") % 1101
    return table(spark, sf_dir, "supplier").select("s_suppkey", fn.analytic_mode(kind.cast("string")).alias("analytic"), fn.public_mode(kind.cast("string")).alias("public"))


def _vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").filter("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    label = fn.printable_label(F.coalesce("n_name", F.concat(F.lit("route "), F.col("c_nationkey"))))
    mode = F.when(F.lit(False), "")
    for region, name in enumerate(("bus", "tram", "metro", "rail", "ferry")):
        mode = mode.when(F.col("n_regionkey") == region, name)
    mode = mode.otherwise("other")
    c = table(spark, sf_dir, "customer").join(nation, "c_nationkey", "left")
    return c.withColumns({"label": label, "mode": mode, "id": fn.public_id(F.col("c_name"), F.col("c_custkey").cast("string"))})


def route_catalog_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vehicles(spark, sf_dir).select("c_custkey", "label", "mode")


def mode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vehicles(spark, sf_dir).groupBy("mode").agg(F.count(F.lit(1)).alias("n"))


def public_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each id with a plottable position; only public columns."""
    lon, lat = F.col("c_acctbal") / 50, F.col("c_acctbal") / 100
    first = Window.partitionBy("id").orderBy("c_custkey")
    v = _vehicles(spark, sf_dir).withColumns({"lon": fn.rounded_position(lon), "lat": fn.rounded_position(lat)}).filter(fn.plottable(F.col("lon"), F.col("lat")))
    return v.withColumn("_n", F.row_number().over(first)).filter("_n = 1").select("id", "lon", "lat", "label", "mode", fn.valid_bearing(F.col("c_acctbal") / 10).alias("bearing"))


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").withColumns({"id": F.when(F.col("s_suppkey") % 50 == 0, "dup").otherwise(F.col("s_name")), "lat": F.col("s_acctbal") / 100})
    twice = s.groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    rules = [("latitude_range", ~F.col("lat").between(-90, 90)), ("duplicate_id", F.col("_n") > 1), ("unknown_route", F.col("s_nationkey") > 22)]
    got = s.join(twice, "id").withColumn("violations", F.array_join(coverage.flag_list(rules), ","))
    return got.filter("violations <> ''").select("s_suppkey", "violations")


def content_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.content_digest(table(spark, sf_dir, "conversations").withColumn("entity", F.coalesce("text", F.lit(""))), ["conv_id"], "entity")


def _files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.col("n_chars").cast("long").alias("size"), F.sha2("text", 256).alias("sha256"))
    p = F.col("path")
    seen = d.filter(p % 10 != 0).select(F.when(p % 11 == 0, -1 - p).otherwise(p).alias("path"), F.when(p % 7 == 0, F.col("size") + 1).otherwise(F.col("size")).alias("size"), F.when(p % 13 == 0, None).when(p % 17 == 0, F.reverse("sha256")).otherwise(F.col("sha256")).alias("sha256"))
    return d, seen


def artifact_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.reconcile(*_files(spark, sf_dir))


def extra_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    receipt, local = _files(spark, sf_dir)
    return archive.extra_files(local, receipt, receipt.filter("path % 20 = 0").select("path"))


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate"))


def pending_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _dates(spark, sf_dir)
    return archive.pending(o, o.filter("o_orderpriority = '1-URGENT'").select("date").distinct(), o.filter("o_totalprice > 450000").select("date").distinct())


def inventory_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive.inventory_rollup(_dates(spark, sf_dir).withColumn("bytes", F.col("o_totalprice").cast("long")), "date", "bytes", F.col("o_totalprice") > 480000, F.col("o_orderstatus") != "P")


def collection_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _dates(spark, sf_dir)
    return o.agg(F.count_distinct("date").alias("days"), F.count(F.lit(1)).alias("polls"), F.count_if(F.col("o_orderstatus") == "F").alias("stored"), F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.max_by("o_orderkey", F.struct("date", "o_orderkey")).alias("latest"))


def coverage_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = _dates(spark, sf_dir).groupBy("o_orderpriority").agg(F.count_if(F.col("o_orderstatus") == "F").alias("data"), F.count(F.lit(1)).alias("expected"))
    return got.withColumn("percent", coverage.coverage_percent(F.col("data"), F.col("expected")))


def retention_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _dates(spark, sf_dir).groupBy(F.date_trunc("month", "date").cast("date").alias("month")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderstatus").alias("feeds"), F.max("o_totalprice").alias("largest"))
    rules = [("too_recent", F.col("month") < F.lit("1998-01-01").cast("date")), ("feeds_missing", F.col("feeds") == 3), ("pending_work", F.col("largest") < 499000)]
    return archive.eligibility(m, rules).select("month", F.array_join("reasons", ",").alias("reasons"), "eligible")


_V = """WITH v AS (SELECT c.*, coalesce(n_name, 'route ' || c_nationkey) AS label, coalesce(['bus','tram','metro','rail','ferry'][n_regionkey + 1], 'other') AS mode, substr(sha256(coalesce(nullif(c_name, ''), CAST(c_custkey AS VARCHAR))), 1, 20) AS id
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 5 <> 0) n ON n.n_nationkey = c.c_nationkey)
"""
_F = """WITH d AS (SELECT doc_id AS path, CAST(n_chars AS BIGINT) AS size, sha256(text) AS sha FROM documents),
o AS (SELECT CASE WHEN path % 11 = 0 THEN -1 - path ELSE path END AS path, CASE WHEN path % 7 = 0 THEN size + 1 ELSE size END AS size, CASE WHEN path % 13 = 0 THEN NULL WHEN path % 17 = 0 THEN reverse(sha) ELSE sha END AS sha FROM d WHERE path % 10 <> 0)
"""
SQL = {
    "content_digest": """WITH e AS (SELECT conv_id, encode(coalesce(text, '')) AS b FROM conversations)
SELECT conv_id, sha256(unhex(string_agg(lpad(printf('%X', octet_length(b)), 16, '0') || hex(b), '' ORDER BY b))) AS digest, count(*) AS n_entities FROM e GROUP BY conv_id""",
    "flatten_orders": """SELECT o_orderkey, o_custkey, CAST(CASE WHEN l_orderkey IS NULL THEN NULL ELSE row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_quantity) - 1 END AS INTEGER) AS pos, l_linenumber, l_suppkey, l_partkey, l_quantity FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
    "flatten_selectors": """WITH s AS (SELECT o_custkey, o_orderkey, o_orderstatus, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS pos FROM orders WHERE o_totalprice > 400000),
j AS (SELECT o_custkey, '[' || string_agg('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"}', ',' ORDER BY pos) || ']' AS selectors_json FROM s GROUP BY o_custkey)
SELECT c_custkey, coalesce(selectors_json, '[]') AS selectors_json, pos, o_orderkey, o_orderstatus FROM customer LEFT JOIN s ON s.o_custkey = c_custkey LEFT JOIN j ON j.o_custkey = c_custkey""",
    "enum_names": """SELECT o_orderkey, TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS number, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'URGENT' WHEN '2' THEN 'HIGH' WHEN '3' THEN 'MEDIUM' WHEN '4' THEN 'NOT_SPECIFIED' ELSE CAST(TRY_CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS VARCHAR) END AS name FROM orders""",
    "route_modes": """WITH k AS (SELECT s_suppkey, s_suppkey % 1101 AS t FROM supplier)
SELECT s_suppkey, CASE WHEN t IN (0, 900) THEN 'tram' WHEN t = 1 THEN 'metro' WHEN t IN (11, 800) THEN 'trolleybus' WHEN t = 3 OR t BETWEEN 700 AND 799 THEN 'bus' WHEN t = 4 OR t BETWEEN 1000 AND 1099 THEN 'ferry' WHEN t = 109 THEN 'hev' WHEN t = 2 OR t BETWEEN 100 AND 199 THEN 'rail' ELSE 'route_type_' || t END AS analytic,
CASE WHEN t IN (0, 900) THEN 'tram' WHEN t IN (1, 400, 401, 402) THEN 'metro' WHEN t IN (11, 800) THEN 'trolleybus' WHEN t = 3 OR starts_with(CAST(t AS VARCHAR), '7') THEN 'bus' WHEN t IN (4, 1000) THEN 'ferry' WHEN t = 2 OR starts_with(CAST(t AS VARCHAR), '1') THEN 'rail' ELSE 'other' END AS public FROM k""",
    "route_catalog_join": _V + "SELECT c_custkey, label, mode FROM v",
    "mode_counts": _V + "SELECT mode, count(*) AS n FROM v GROUP BY mode",
    "public_vehicles": _V + """, p AS (SELECT *, round(c_acctbal / 50, 6) AS lon, round(c_acctbal / 100, 6) AS lat FROM v),
q AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c_custkey) AS n FROM p WHERE lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 AND NOT (lon = 0 AND lat = 0))
SELECT id, lon, lat, label, mode, CASE WHEN c_acctbal / 10 BETWEEN 0 AND 360 THEN c_acctbal / 10 END AS bearing FROM q WHERE n = 1""",
    "contract_violations": """WITH s AS (SELECT *, CASE WHEN s_suppkey % 50 = 0 THEN 'dup' ELSE s_name END AS id, s_acctbal / 100 AS lat FROM supplier),
t AS (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM s),
v AS (SELECT s_suppkey, array_to_string(list_filter([CASE WHEN lat NOT BETWEEN -90 AND 90 THEN 'latitude_range' END, CASE WHEN n > 1 THEN 'duplicate_id' END, CASE WHEN s_nationkey > 22 THEN 'unknown_route' END], lambda x: x IS NOT NULL), ',') AS violations FROM t)
SELECT * FROM v WHERE violations <> ''""",
    "artifact_reconcile": _F + """SELECT coalesce(d.path, o.path) AS path, CASE WHEN o.path IS NULL THEN 'missing' WHEN d.path IS NULL THEN 'unexpected' WHEN d.size IS DISTINCT FROM o.size THEN 'size_mismatch' WHEN d.sha IS NULL OR o.sha IS NULL THEN 'checksum_unavailable' WHEN d.sha <> o.sha THEN 'sha256_mismatch' ELSE 'match' END AS status FROM d FULL OUTER JOIN o ON d.path = o.path""",
    "extra_files": _F + """SELECT path, 'not_in_receipt' AS problem FROM o WHERE path NOT IN (SELECT path FROM d) UNION ALL
SELECT path, 'gone_without_plan' FROM d WHERE path NOT IN (SELECT path FROM o) AND path % 20 <> 0""",
    "pending_dates": """SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders EXCEPT SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT' OR o_totalprice > 450000""",
    "inventory_rollup": """SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n_files, CAST(sum(CAST(trunc(o_totalprice) AS BIGINT)) AS BIGINT) AS bytes, count(CASE WHEN o_totalprice > 480000 THEN 1 END) AS n_problems,
CASE WHEN max(o_totalprice) > 480000 THEN 'corrupt_or_missing' WHEN bool_and(o_orderstatus <> 'P') THEN 'v2_complete' ELSE 'legacy_present_but_completeness_unverifiable' END AS class FROM orders GROUP BY ALL""",
    "collection_statistics": """SELECT count(DISTINCT CAST(o_orderdate AS DATE)) AS days, count(*) AS polls, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS stored, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day, (SELECT o_orderkey FROM orders ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC LIMIT 1) AS latest FROM orders""",
    "coverage_percent": """SELECT o_orderpriority, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS data, count(*) AS expected, round(100.0 * count(CASE WHEN o_orderstatus = 'F' THEN 1 END) / count(*), 2) AS percent FROM orders GROUP BY 1""",
    "retention_eligible": """WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(DISTINCT o_orderstatus) AS feeds, max(o_totalprice) AS largest FROM orders GROUP BY 1),
r AS (SELECT month, array_to_string(list_filter([CASE WHEN NOT month < DATE '1998-01-01' THEN 'too_recent' END, CASE WHEN feeds <> 3 THEN 'feeds_missing' END, CASE WHEN NOT largest < 499000 THEN 'pending_work' END], lambda x: x IS NOT NULL), ',') AS reasons FROM m)
SELECT month, reasons, reasons = '' AS eligible FROM r""",
}
QUERIES = {
    f.__name__: f
    for f in (flatten_orders, flatten_selectors, enum_names, route_modes, route_catalog_join, mode_counts, public_vehicles, contract_violations, content_digest, artifact_reconcile, extra_files, pending_dates, inventory_rollup, collection_statistics, coverage_percent, retention_eligible)
}
