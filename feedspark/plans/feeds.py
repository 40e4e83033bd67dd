"""Decoded feed messages, nested from orders, customers and parts, flattened by the operators of feeds; rules for texts and values.

A poll holds twenty consecutive keys. Some entities are deleted, with and without a payload, some have none at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.functions import scalars as fn
from feedspark.operators import feeds
from feedspark.plans.tables import table


def _polls(rows: DataFrame, key: str, day: str, payload: str) -> DataFrame:
    """Rows with key, day and a payload column to polls, as feeds expects them."""
    k = F.col(key)
    deleted = F.when(k % 10 == 0, True).when(k % 10 == 1, None).otherwise(False)
    kept = F.when((k % 20 != 0) & (k % 11 != 0), F.col(payload))
    entity = F.struct(k.alias("order"), F.concat(F.lit("e"), k).alias("id"), deleted.alias("is_deleted"), kept.alias(payload))
    grouped = rows.groupBy(F.expr(f"{key} div 20").alias("g")).agg(F.array_sort(F.collect_list(entity)).alias("entities"), F.min(day).alias("first"), F.max(day).alias("last"))
    return grouped.selectExpr(
        "concat('p', g) AS poll_id", "if(g % 3 = 0, NULL, first) AS request_started_at", "last AS response_received_at",
        "named_struct('timestamp', g * 60, 'feed_version', if(g % 4 = 0, '', concat('v', g)), 'incrementality', int(g % 3)) AS header", "entities",
    )


def feed_trip_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ["l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_extendedprice"]
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("items"))
    trip = """named_struct('trip_id', concat('t', o_orderkey), 'route_id', if(o_orderkey % 5 = 0, '', o_orderstatus), 'direction_id', int(o_orderkey % 2), 'start_time', if(o_orderkey % 3 = 0, '', '08:00:00'),
        'start_date', date_format(o_orderdate, 'yyyyMMdd'), 'schedule_relationship', int(o_orderkey % 9), 'modified_trip', if(o_orderkey % 6 = 0, named_struct('affected_trip', concat('m', o_orderkey)), NULL))"""
    extension = "named_struct('deviated', CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END, 'vehicle_type', int(o_orderkey % 7), 'door_open', o_orderkey % 2 = 0, 'stop_distance', o_custkey)"
    vehicle = f"if(o_orderkey % 4 = 0, NULL, named_struct('id', concat('v', o_custkey), 'label', o_orderpriority, 'wheelchair_accessible', int(o_orderkey % 5), 'bkk', if(o_orderkey % 4 = 1, NULL, {extension})))"
    stop = """named_struct('stop_sequence', if(x.l_suppkey % 4 = 0, NULL, x.l_linenumber), 'stop_id', concat('s', x.l_suppkey), 'schedule_relationship', int(x.l_partkey % 5), 'departure_occupancy_status', int(x.l_partkey % 10),
        'stop_time_properties', if(x.l_partkey % 3 = 1, named_struct('assigned_stop_id', concat('a', x.l_partkey)), NULL), 'arrival', if(x.l_partkey % 3 = 0, NULL, named_struct('delay', int(x.l_quantity), 'time', x.l_partkey)),
        'departure', named_struct('delay', if(x.l_suppkey % 2 = 0, NULL, int(x.l_quantity) * 2), 'time', x.l_partkey + 30, 'uncertainty', int(x.l_suppkey)), 'bkk', named_struct('scheduled_arrival', named_struct('time', x.l_partkey - 1)))"""
    update = f"named_struct('trip', {trip}, 'vehicle', {vehicle}, 'timestamp', unix_seconds(timestamp(o_orderdate)), 'delay', int(o_orderkey % 600 - 300), 'stop_time_update', transform(items, x -> {stop}))"
    rows = table(spark, sf_dir, "orders").join(lines, "o_orderkey", "left").selectExpr("o_orderkey", "concat(date_format(o_orderdate, 'yyyy-MM-dd'), 'T00:00:00Z') AS day", f"{update} AS trip_update")
    return feeds.trip_updates(_polls(rows, "o_orderkey", "day", "trip_update"))


def feed_vehicle_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vehicle = """named_struct('trip', named_struct('trip_id', concat('t', c_custkey), 'route_id', c_mktsegment), 'vehicle', named_struct('id', if(c_custkey % 7 = 0, '', c_name), 'label', c_mktsegment, 'license_plate', concat('L', c_custkey)), 'timestamp', c_custkey,
        'position', if(c_custkey % 8 = 0, NULL, named_struct('latitude', c_acctbal / 100, 'longitude', c_acctbal / 50, 'bearing', if(c_custkey % 2 = 0, NULL, c_acctbal / 10))), 'current_stop_sequence', c_nationkey, 'stop_id', concat('s', c_nationkey),
        'current_status', int(c_custkey % 4), 'congestion_level', int(c_custkey % 6), 'occupancy_status', int(c_custkey % 10), 'occupancy_percentage', int(c_custkey % 100),
        'multi_carriage_details', if(c_custkey % 3 = 0, array(named_struct('id', concat('c', c_custkey), 'carriage_sequence', int(c_custkey % 4))), NULL))"""
    rows = table(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name AS day", f"{vehicle} AS vehicle")
    return feeds.vehicle_positions(_polls(rows, "c_custkey", "day", "vehicle"))


def feed_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = "named_struct('translation', if(p_partkey % 3 = 0, array(), array(named_struct('text', p_name, 'language', 'en'), named_struct('text', p_brand, 'language', ''))))"
    periods = "if(p_partkey % 3 = 1, array(), array(named_struct('start', p_partkey, 'end', if(p_partkey % 2 = 0, NULL, p_partkey + 100)), named_struct('start', p_partkey + 200, 'end', p_partkey + 300)))"
    selector = "named_struct('agency_id', '', 'route_id', concat('r', p_size), 'route_type', int(p_partkey % 5), 'stop_id', concat('s', i), 'trip', if(i = 1, NULL, named_struct('trip_id', concat('t', p_partkey), 'schedule_relationship', int(p_partkey % 9))))"
    selectors = f"transform(slice(array(1, 2, 3), 1, int(p_partkey % 4)), i -> {selector})"
    routes = "if(p_partkey % 2 = 0, NULL, array(named_struct('route_id', concat('r', p_size), 'cause', int(p_partkey % 14), 'effect_type', int(p_partkey % 3), 'header_text', named_struct('translation', array(named_struct('text', p_type, 'language', 'hu'))))))"
    alert = f"""named_struct('cause', int(p_partkey % 14), 'effect', int(p_partkey % 12), 'severity_level', int(p_partkey % 6), 'header_text', {texts}, 'active_period', {periods}, 'informed_entity', {selectors},
        'bkk', if(p_partkey % 5 = 0, NULL, named_struct('modifiedTime', p_partkey, 'route', {routes})))"""
    rows = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_brand AS day", f"{alert} AS alert")
    return feeds.alerts(_polls(rows, "p_partkey", "day", "alert"))


def poll_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls in which an entity that is not deleted has no payload, or two, are invalid."""
    some = lambda when: F.when(F.expr(when), F.struct(F.col("o_custkey").alias("id")))
    entity = F.struct(
        F.expr("if(o_orderkey % 3 = 0, NULL, o_orderkey % 31 = 0)").alias("is_deleted"), some("o_orderkey % 31 <> 0 AND o_orderkey % 37 <> 0").alias("vehicle"),
        some("o_orderkey % 41 = 0").alias("trip_update"), some("o_orderkey % 74 = 0").alias("shape"), some("o_orderkey % 43 = 0").alias("alert"),
    )
    polls = table(spark, sf_dir, "orders").groupBy(F.expr("o_orderkey div 20").alias("g")).agg(F.collect_list(entity).alias("entities"))
    return polls.select("g", feeds.valid_poll("entities", "vehicle", ("trip_update", "shape")).alias("valid"))


def time_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict dates, timestamps that name a zone, seconds as ISO text, labels of ages."""
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    dates = F.when(k % 5 == 0, day).when(k % 5 == 1, F.date_format("o_orderdate", "yyyy-M-d")).when(k % 5 == 2, F.concat(F.substring(day, 1, 4), F.lit("-13-01"))).when(k % 5 == 3, F.concat(F.substring(day, 1, 4), F.lit("-02-31")))
    times = F.concat(day, F.when(k % 5 == 0, "T00:00:00Z").when(k % 5 == 1, "T00:00:00+02:00").when(k % 5 == 2, "T00:00:00").when(k % 5 == 3, "T25:00:00Z").otherwise(" no time"))
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.strict_date(dates).alias("date"), F.unix_seconds(fn.aware_timestamp(times)).alias("seconds"), fn.iso_seconds(seconds + k).alias("iso"), fn.age_label(k * 37 - 500).alias("age"))


def value_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty texts, colours, bounded counts, changes beyond a tolerance, confidence of a source."""
    k, price = F.col("o_orderkey"), F.floor("o_totalprice")
    old, new = F.when(k % 7 != 0, price), F.when(k % 5 != 0, price + k % 40 - 20)
    color = F.when(k % 4 == 0, F.lit("12345g")).when(k % 4 != 1, F.lpad(F.hex(k), 6, "A"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fn.empty_to_null(F.when(k % 3 == 0, "").otherwise(F.col("o_orderpriority"))).alias("label"), fn.route_color(color, F.lit("#000000")).alias("color"), fn.bounded_count(price - 100_000, 200_000).alias("count"),
        fn.beyond_tolerance(old, new, 15.0).alias("changed"), fn.beyond_tolerance(old, new, 0.0).alias("differs"), fn.source_confidence(F.when(k % 3 == 0, "legacy_archive_migration").when(k % 3 == 1, "collector")).alias("confidence"),
    )


def _name(number: str, names: dict[int, str]) -> str:
    return f"CASE {number} " + " ".join(f"WHEN {n} THEN '{v}'" for n, v in names.items()) + f" ELSE CAST({number} AS VARCHAR) END"


def _long(columns: dict[str, str], kind: str = "BIGINT") -> str:
    return ", ".join(f"CAST({v} AS {kind}) AS {c}" for c, v in columns.items())


def _enums(columns: dict[str, tuple[str, dict[int, str]]]) -> str:
    return ", ".join(f"CAST({v} AS BIGINT) AS {c}, {_name(v, names)} AS {c}_name" for c, (v, names) in columns.items())


def _poll_sql(source: str, key: str, day: str) -> str:
    """Columns of a poll and entity, for rows x of the source, with k, g, deleted and has."""
    return f"""WITH x AS (SELECT *, {key} AS k, {key} // 20 AS g, {key} % 10 = 0 AS deleted, {key} % 20 <> 0 AND {key} % 11 <> 0 AS has FROM {source}),
p AS (SELECT *, CASE WHEN has THEN k END AS h, min({day}) OVER (PARTITION BY g) AS first, max({day}) OVER (PARTITION BY g) AS last FROM x),
q AS (SELECT *, CAST(2 AS SMALLINT) AS schema_version, 'p' || g AS poll_id, CASE WHEN g % 3 = 0 THEN last ELSE first END AS request_started_at, last AS response_received_at, last AS fetched_at, CAST(g * 60 AS BIGINT) AS feed_header_timestamp,
  CASE WHEN g % 4 <> 0 THEN 'v' || g END AS feed_header_version, {_enums({"feed_incrementality": ("g % 3", feeds.INCREMENTALITY)})}, 'e' || k AS entity_id, deleted AS entity_is_deleted FROM p WHERE has OR deleted)
"""


_POLL = "schema_version, poll_id, request_started_at, response_received_at, fetched_at, feed_header_timestamp, feed_header_version, feed_incrementality, feed_incrementality_name, entity_id, entity_is_deleted"
_EVENTS = {
    "arrival_delay": "CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END", "arrival_time": "CASE WHEN l_partkey % 3 <> 0 THEN l_partkey END", "departure_delay": "CASE WHEN l_suppkey % 2 <> 0 THEN l_quantity * 2 END", "departure_time": "l_partkey + 30",
    "departure_uncertainty": "l_suppkey", "bkk_scheduled_arrival_time": "l_partkey - 1",
}
_ALL_EVENTS = {f"{p}_{n}": _EVENTS.get(f"{p}_{n}", "NULL") for p in ("arrival", "departure", "bkk_scheduled_arrival", "bkk_scheduled_departure") for n in ("delay", "time", "uncertainty", "scheduled_time")}
_NO_VEHICLE = _long({"bkk_vehicle_type": "NULL", "bkk_stop_distance": "NULL"}) + ", CAST(NULL AS VARCHAR) AS bkk_vehicle_model, CAST(NULL AS BOOLEAN) AS bkk_deviated, CAST(NULL AS BOOLEAN) AS bkk_door_open"
_TRIP_JSON = """'{"direction_id":null,"modified_trip_json":null,"route_id":null,"schedule_relationship":' || CASE WHEN i = 1 THEN 'null,"schedule_relationship_name":null' ELSE h % 9 || ',"schedule_relationship_name":"' || """ + _name("(h % 9)", feeds.TRIP_RELATION) + """ || '"' END
  || ',"start_date":null,"start_time":null,"trip_id":' || CASE WHEN i = 1 THEN 'null' ELSE '"t' || h || '"' END || '}'"""
SQL = {
    "feed_trip_updates": _poll_sql("(SELECT *, strftime(o_orderdate, '%Y-%m-%dT00:00:00Z') AS day FROM orders)", "o_orderkey", "day")
    + f""", l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey, l_quantity, l_extendedprice) - 1 AS pos FROM lineitem),
s AS (SELECT *, CASE WHEN h % 4 > 0 THEN h END AS v, CASE WHEN h % 4 > 1 THEN h END AS b FROM q LEFT JOIN l ON l_orderkey = h)
SELECT {_POLL}, {_long({"trip_update_timestamp": "CASE WHEN has THEN epoch(o_orderdate) END", "trip_delay": "h % 600 - 300", "direction_id": "h % 2", "bkk_vehicle_type": "b % 7", "bkk_stop_distance": "CASE WHEN b IS NOT NULL THEN o_custkey END", "stop_time_update_index": "pos", "stop_visit_fallback_index": "CASE WHEN l_suppkey % 4 = 0 THEN pos END", "stop_sequence": "CASE WHEN l_suppkey % 4 <> 0 THEN l_linenumber END"} | _ALL_EVENTS)},
{_enums({"vehicle_wheelchair_accessible": ("(v % 5)", feeds.WHEELCHAIR), "schedule_relationship": ("(h % 9)", feeds.TRIP_RELATION), "stop_schedule_relationship": ("(l_partkey % 5)", feeds.STOP_RELATION), "departure_occupancy_status": ("(l_partkey % 10)", feeds.OCCUPANCY)})},
CAST(NULL AS VARCHAR) AS trip_properties_json, CASE WHEN v IS NOT NULL THEN 'v' || o_custkey END AS vehicle_id, CASE WHEN v IS NOT NULL THEN o_orderpriority END AS vehicle_label, CAST(NULL AS VARCHAR) AS vehicle_license_plate, CAST(NULL AS VARCHAR) AS bkk_vehicle_model,
CASE WHEN b IS NOT NULL THEN b % 3 = 0 END AS bkk_deviated, b % 2 = 0 AS bkk_door_open, 't' || h AS trip_id, CASE WHEN h % 5 <> 0 THEN o_orderstatus END AS route_id, CASE WHEN h % 3 <> 0 THEN '08:00:00' END AS start_time, CASE WHEN has THEN strftime(o_orderdate, '%Y%m%d') END AS start_date,
CASE WHEN h % 6 = 0 THEN '{{"affected_trip":"m' || h || '"}}' END AS modified_trip_json, 's' || l_suppkey AS stop_id, CASE WHEN l_partkey % 3 = 1 THEN '{{"assigned_stop_id":"a' || l_partkey || '"}}' END AS stop_time_properties_json FROM s""",
    "feed_vehicle_positions": _poll_sql("customer", "c_custkey", "c_name")
    + f"""SELECT {_POLL}, {_NO_VEHICLE}, {_long({"vehicle_wheelchair_accessible": "NULL", "vehicle_timestamp": "h", "current_stop_sequence": "CASE WHEN has THEN c_nationkey END", "occupancy_percentage": "h % 100", "direction_id": "NULL", "schedule_relationship": "NULL"})},
{_long({n: "NULL" for n in ("vehicle_wheelchair_accessible_name", "start_time", "start_date", "schedule_relationship_name", "modified_trip_json")}, "VARCHAR")}, {_long({"odometer": "NULL", "speed": "NULL", "latitude": "CASE WHEN h % 8 <> 0 THEN c_acctbal / 100 END", "longitude": "CASE WHEN h % 8 <> 0 THEN c_acctbal / 50 END", "bearing": "CASE WHEN h % 2 <> 0 THEN c_acctbal / 10 END"}, "DOUBLE")},
{_enums({"current_status": ("(h % 4)", feeds.STOP_STATUS), "congestion_level": ("(h % 6)", feeds.CONGESTION), "occupancy_status": ("(h % 10)", feeds.OCCUPANCY)})}, CASE WHEN h % 7 <> 0 THEN c_name END AS vehicle_id, CASE WHEN has THEN c_mktsegment END AS vehicle_label, 'L' || h AS vehicle_license_plate,
CASE WHEN has THEN 's' || c_nationkey END AS stop_id, 't' || h AS trip_id, CASE WHEN has THEN c_mktsegment END AS route_id, CASE WHEN h % 3 = 0 THEN '[{{"id":"c' || h || '","carriage_sequence":' || h % 4 || '}}]' WHEN has THEN '[]' END AS multi_carriage_details_json FROM q""",
    "feed_alerts": _poll_sql("part", "p_partkey", "p_brand")
    + f""", s AS (SELECT *, unnest(CASE WHEN h % 4 > 0 THEN range(1, h % 4 + 1) ELSE [NULL] END) AS i FROM q),
j AS (SELECT k, '[' || string_agg('{{"agency_id":null,"direction_id":null,"route_id":"r' || p_size || '","route_type":' || h % 5 || ',"stop_id":"s' || i || '","trip":' || {_TRIP_JSON} || '}}', ',' ORDER BY i) || ']' AS informed FROM s WHERE i IS NOT NULL GROUP BY k)
SELECT {_POLL}, {_enums({"cause": ("(h % 14)", feeds.CAUSE), "effect": ("(h % 12)", feeds.EFFECT), "severity_level": ("(h % 6)", feeds.SEVERITY), "affected_trip_schedule_relationship": ("(CASE WHEN i > 1 THEN h % 9 END)", feeds.TRIP_RELATION)})},
CASE WHEN h % 3 <> 0 THEN p_name END AS header_text, CASE WHEN h % 3 <> 0 THEN '[{{"language":"en","text":"' || p_name || '"}},{{"language":null,"text":"' || p_brand || '"}}]' WHEN has THEN '[]' END AS header_text_json,
{_long({n: "NULL" for n in ("description_text", "url", "image_json", "cause_detail_json", "effect_detail_json", "affected_agency_id", "affected_trip_route_id", "affected_trip_start_time", "affected_trip_start_date")}, "VARCHAR")},
{", ".join(f"CASE WHEN has THEN '[]' END AS {n}_json" for n in ("description_text", "url", "tts_header_text", "tts_description_text", "image_alternative_text", "communication_periods", "impact_periods", "bkk_start_text", "bkk_end_text"))},
{_long({"active_period_start": "CASE WHEN h % 3 <> 1 THEN h END", "active_period_end": "CASE WHEN h % 3 <> 1 AND h % 2 <> 0 THEN h + 100 END", "bkk_modified_time": "CASE WHEN h % 5 <> 0 THEN h END", "affected_route_type": "CASE WHEN i IS NOT NULL THEN h % 5 END", "affected_direction_id": "NULL", "affected_trip_direction_id": "NULL"})},
CASE WHEN h % 3 <> 1 THEN '[{{"end":' || CASE WHEN h % 2 = 0 THEN 'null' ELSE CAST(h + 100 AS VARCHAR) END || ',"start":' || h || '}},{{"end":' || h + 300 || ',"start":' || h + 200 || '}}]' WHEN has THEN '[]' END AS active_periods_json,
CASE WHEN has THEN coalesce(informed, '[]') END AS informed_entities_json, CASE WHEN i IS NOT NULL THEN 'r' || p_size END AS affected_route_id, 's' || i AS affected_stop_id, CASE WHEN i > 1 THEN 't' || h END AS affected_trip_id,
CASE WHEN h % 5 <> 0 AND h % 2 <> 0 THEN '[{{"cause":' || h % 14 || ',"cause_name":"' || {_name("(h % 14)", feeds.CAUSE)} || '","effect":null,"effect_name":null,"effect_type":' || h % 3 || ',"effect_type_name":"' || {_name("(h % 3)", feeds.EFFECT_TYPE)} || '","header_text":[{{"language":"hu","text":"' || p_type || '"}}],"route_id":"r' || p_size || '"}}]' WHEN has THEN '[]' END AS bkk_route_details_json
FROM s LEFT JOIN j USING (k)""",
    "poll_validity": """WITH e AS (SELECT o_orderkey // 20 AS g, o_orderkey AS k, CAST(k % 31 <> 0 AND k % 37 <> 0 AS INTEGER) + CAST(k % 41 = 0 AS INTEGER) + CAST(k % 74 = 0 AS INTEGER) AS n FROM orders)
SELECT g, bool_and((k % 3 <> 0 AND k % 31 = 0) OR n = 1) AS valid FROM e GROUP BY g""",
    "time_texts": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 OR (o_orderkey % 5 = 1 AND month(o_orderdate) > 9 AND day(o_orderdate) > 9) THEN CAST(o_orderdate AS DATE) END AS date,
CASE o_orderkey % 5 WHEN 0 THEN CAST(epoch(o_orderdate) AS BIGINT) WHEN 1 THEN CAST(epoch(o_orderdate) AS BIGINT) - 7200 END AS seconds, strftime(o_orderdate + to_seconds(o_orderkey), '%Y-%m-%dT%H:%M:%SZ') AS iso,
CASE WHEN a < 60 THEN a || 's' WHEN a < 3600 THEN a // 60 || 'm' WHEN a < 86400 THEN a // 3600 || 'h' ELSE a // 86400 || 'd' END AS age FROM (SELECT *, greatest(0, o_orderkey * 37 - 500) AS a FROM orders)""",
    "value_rules": """WITH v AS (SELECT *, o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) AS price, CASE WHEN o_orderkey % 7 <> 0 THEN 0 END AS o, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 40 - 20 END AS n FROM orders)
SELECT o_orderkey, CASE WHEN k % 3 <> 0 THEN o_orderpriority END AS label, CASE WHEN k % 4 IN (0, 1) THEN '#000000' ELSE '#' || lower(lpad(printf('%X', k), 6, 'A')) END AS color, CASE WHEN price BETWEEN 100000 AND 300000 THEN price - 100000 END AS count,
CASE WHEN o IS NULL OR n IS NULL THEN (o IS NULL) <> (n IS NULL) ELSE abs(n) > 15 END AS changed, CASE WHEN o IS NULL OR n IS NULL THEN (o IS NULL) <> (n IS NULL) ELSE n <> 0 END AS differs, CASE WHEN k % 3 = 0 THEN 'legacy_schedule_uncertain' ELSE 'collector_observed' END AS confidence FROM v""",
}
QUERIES = {f.__name__: f for f in (feed_trip_updates, feed_vehicle_positions, feed_alerts, poll_validity, time_texts, value_rules)}
