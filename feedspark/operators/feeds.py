"""Decoded feed messages to typed rows: vehicle positions, trip updates, alerts.

Input: one row for each poll with poll_id, request_started_at, response_received_at, header
(struct) and entities (array of struct), nested as in the GTFS-Realtime specification. Fields
that the input's schema does not have give nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedspark.functions.scalars import empty_to_null, enum_name

#: Names of the specification's enums, by number.
INCREMENTALITY = {0: "FULL_DATASET", 1: "DIFFERENTIAL"}
TRIP_RELATION = {0: "SCHEDULED", 1: "ADDED", 2: "UNSCHEDULED", 3: "CANCELED", 5: "REPLACEMENT", 6: "DUPLICATED", 7: "DELETED", 8: "NEW"}
STOP_RELATION = {0: "SCHEDULED", 1: "SKIPPED", 2: "NO_DATA", 3: "UNSCHEDULED"}
STOP_STATUS = {0: "INCOMING_AT", 1: "STOPPED_AT", 2: "IN_TRANSIT_TO"}
CONGESTION = {0: "UNKNOWN_CONGESTION_LEVEL", 1: "RUNNING_SMOOTHLY", 2: "STOP_AND_GO", 3: "CONGESTION", 4: "SEVERE_CONGESTION"}
OCCUPANCY = {0: "EMPTY", 1: "MANY_SEATS_AVAILABLE", 2: "FEW_SEATS_AVAILABLE", 3: "STANDING_ROOM_ONLY", 4: "CRUSHED_STANDING_ROOM_ONLY", 5: "FULL", 6: "NOT_ACCEPTING_PASSENGERS", 7: "NO_DATA_AVAILABLE", 8: "NOT_BOARDABLE"}
CAUSE = {1: "UNKNOWN_CAUSE", 2: "OTHER_CAUSE", 3: "TECHNICAL_PROBLEM", 4: "STRIKE", 5: "DEMONSTRATION", 6: "ACCIDENT", 7: "HOLIDAY", 8: "WEATHER", 9: "MAINTENANCE", 10: "CONSTRUCTION", 11: "POLICE_ACTIVITY", 12: "MEDICAL_EMERGENCY"}
EFFECT = {1: "NO_SERVICE", 2: "REDUCED_SERVICE", 3: "SIGNIFICANT_DELAYS", 4: "DETOUR", 5: "ADDITIONAL_SERVICE", 6: "MODIFIED_SERVICE", 7: "OTHER_EFFECT", 8: "UNKNOWN_EFFECT", 9: "STOP_MOVED", 10: "NO_EFFECT", 11: "ACCESSIBILITY_ISSUE"}
SEVERITY = {1: "UNKNOWN_SEVERITY", 2: "INFO", 3: "WARNING", 4: "SEVERE"}
EFFECT_TYPE = {1: "NO_SERVICE", 2: "WARNING"}
WHEELCHAIR = {0: "NO_VALUE", 1: "UNKNOWN", 2: "WHEELCHAIR_ACCESSIBLE", 3: "WHEELCHAIR_INACCESSIBLE"}


def field(df: DataFrame, path: str, kind: str) -> Column:
    """A nested field cast to its type, or a null of that type if the schema lacks it."""
    at: T.DataType = df.schema
    for name in path.split("."):
        if not isinstance(at, T.StructType) or name not in at.fieldNames():
            return F.lit(None).cast(kind)
        at = at[name].dataType
    value = F.col(path)
    if kind == "string" and isinstance(at, (T.StructType, T.ArrayType)):
        return F.to_json(value)
    return empty_to_null(value) if kind == "string" and isinstance(at, T.StringType) else value.cast(kind)


def _named(df: DataFrame, path: str, name: str, names: dict[int, str]) -> list[Column]:
    number = field(df, path, "int")
    return [number.cast("long").alias(name), enum_name(number, names).alias(f"{name}_name")]


def entities(polls: DataFrame) -> DataFrame:
    """One row for each entity, in order."""
    return polls.select("*", F.posexplode("entities").alias("entity_pos", "entity")).drop("entities")


def poll_columns(df: DataFrame, version: int = 2) -> list[Column]:
    received = field(df, "response_received_at", "string")
    return [
        F.lit(version).cast("short").alias("schema_version"), field(df, "poll_id", "string").alias("poll_id"), F.coalesce(field(df, "request_started_at", "string"), received).alias("request_started_at"),
        received.alias("response_received_at"), received.alias("fetched_at"), field(df, "header.timestamp", "long").alias("feed_header_timestamp"), field(df, "header.feed_version", "string").alias("feed_header_version"),
        *_named(df, "header.incrementality", "feed_incrementality", INCREMENTALITY), field(df, "entity.id", "string").alias("entity_id"), F.coalesce(field(df, "entity.is_deleted", "boolean"), F.lit(False)).alias("entity_is_deleted"),
    ]


def trip_columns(df: DataFrame, at: str) -> list[Column]:
    plain = [field(df, f"{at}.{n}", k).alias(n) for n, k in (("trip_id", "string"), ("route_id", "string"), ("direction_id", "long"), ("start_time", "string"), ("start_date", "string"))]
    return [*plain, *_named(df, f"{at}.schedule_relationship", "schedule_relationship", TRIP_RELATION), field(df, f"{at}.modified_trip", "string").alias("modified_trip_json")]


def vehicle_columns(df: DataFrame, at: str) -> list[Column]:
    """The extension's flag is false where the extension is present and the flag is not."""
    ext = f"{at}.bkk"
    present = F.col(ext).isNotNull() if field_exists(df, ext) else F.lit(False)
    return [
        field(df, f"{at}.id", "string").alias("vehicle_id"), field(df, f"{at}.label", "string").alias("vehicle_label"), field(df, f"{at}.license_plate", "string").alias("vehicle_license_plate"),
        *_named(df, f"{at}.wheelchair_accessible", "vehicle_wheelchair_accessible", WHEELCHAIR), field(df, f"{ext}.vehicle_model", "string").alias("bkk_vehicle_model"),
        F.when(present, F.coalesce(field(df, f"{ext}.deviated", "boolean"), F.lit(False))).alias("bkk_deviated"), field(df, f"{ext}.vehicle_type", "long").alias("bkk_vehicle_type"),
        field(df, f"{ext}.door_open", "boolean").alias("bkk_door_open"), field(df, f"{ext}.stop_distance", "long").alias("bkk_stop_distance"),
    ]


def field_exists(df: DataFrame, path: str) -> bool:
    at: T.DataType = df.schema
    for name in path.split("."):
        if not isinstance(at, T.StructType) or name not in at.fieldNames():
            return False
        at = at[name].dataType
    return True


def vehicle_positions(polls: DataFrame) -> DataFrame:
    """One row for each vehicle entity; a deleted one without a payload keeps its poll and entity columns only."""
    df = entities(polls)
    v = "entity.vehicle"
    numbers = [field(df, f"{v}.position.{n}", "double").alias(n) for n in ("latitude", "longitude", "bearing", "odometer", "speed")]
    out = df.select(
        *poll_columns(df), *vehicle_columns(df, f"{v}.vehicle"), field(df, f"{v}.timestamp", "long").alias("vehicle_timestamp"), *numbers, field(df, f"{v}.current_stop_sequence", "long").alias("current_stop_sequence"),
        field(df, f"{v}.stop_id", "string").alias("stop_id"), *_named(df, f"{v}.current_status", "current_status", STOP_STATUS), *_named(df, f"{v}.congestion_level", "congestion_level", CONGESTION),
        *_named(df, f"{v}.occupancy_status", "occupancy_status", OCCUPANCY), field(df, f"{v}.occupancy_percentage", "long").alias("occupancy_percentage"),
        F.when(F.col(v).isNotNull(), F.coalesce(field(df, f"{v}.multi_carriage_details", "string"), F.lit("[]"))).alias("multi_carriage_details_json"), *trip_columns(df, f"{v}.trip"), F.col(v).isNotNull().alias("_has"),
    )
    return out.filter("_has or entity_is_deleted").drop("_has")


def trip_updates(polls: DataFrame) -> DataFrame:
    """One row for each stop update, one with null stop columns where there is none; the list ordinal stands in for a missing sequence."""
    df, t = entities(polls), "entity.trip_update"
    df = df.filter(F.col(t).isNotNull() | F.coalesce(field(df, "entity.is_deleted", "boolean"), F.lit(False)))
    df = df.select("*", F.posexplode_outer(f"{t}.stop_time_update").alias("_at", "_stop"))
    events = [field(df, f"_stop.{e}.{n}", "long").alias(f"{p}_{n}") for p, e in (("arrival", "arrival"), ("departure", "departure"), ("bkk_scheduled_arrival", "bkk.scheduled_arrival"), ("bkk_scheduled_departure", "bkk.scheduled_departure")) for n in ("delay", "time", "uncertainty", "scheduled_time")]
    sequence = field(df, "_stop.stop_sequence", "long")
    return df.select(
        *poll_columns(df), field(df, f"{t}.timestamp", "long").alias("trip_update_timestamp"), field(df, f"{t}.delay", "long").alias("trip_delay"), field(df, f"{t}.trip_properties", "string").alias("trip_properties_json"),
        *vehicle_columns(df, f"{t}.vehicle"), *trip_columns(df, f"{t}.trip"), F.col("_at").cast("long").alias("stop_time_update_index"), F.when(sequence.isNull(), F.col("_at").cast("long")).alias("stop_visit_fallback_index"),
        sequence.alias("stop_sequence"), field(df, "_stop.stop_id", "string").alias("stop_id"), *_named(df, "_stop.schedule_relationship", "stop_schedule_relationship", STOP_RELATION),
        *_named(df, "_stop.departure_occupancy_status", "departure_occupancy_status", OCCUPANCY), field(df, "_stop.stop_time_properties", "string").alias("stop_time_properties_json"), *events,
    )


def _sub(df: DataFrame, path: str) -> T.StructType:
    """The schema of the items of a list, empty where the schema lacks the list."""
    at: T.DataType = df.schema
    for name in path.split("."):
        if not isinstance(at, T.StructType) or name not in at.fieldNames():
            return T.StructType([])
        at = at[name].dataType
    return at.elementType if isinstance(at, T.ArrayType) and isinstance(at.elementType, T.StructType) else T.StructType([])


def _item(item: Column, schema: T.StructType, name: str, kind: str) -> Column:
    """A field of a list's item, null where the schema lacks it; empty texts are null."""
    if name not in schema.fieldNames():
        return F.lit(None).cast(kind)
    return empty_to_null(item[name]) if kind == "string" and isinstance(schema[name].dataType, T.StringType) else item[name].cast(kind)


def _named_struct(values: dict[str, Column]) -> Column:
    """A struct whose fields are in the order of their names."""
    return F.named_struct(*[x for n in sorted(values) for x in (F.lit(n), values[n])])


def _list_json(df: DataFrame, path: str, build) -> Column:
    """Canonical JSON of a list: keys in order, nulls kept, '[]' for none."""
    schema = _sub(df, path)
    if not schema.fieldNames():
        return F.lit("[]")
    return F.coalesce(F.to_json(F.transform(F.col(path), lambda x: build(x, schema)), {"ignoreNullFields": "false"}), F.lit("[]"))


def _translations(x: Column, s: T.StructType) -> Column:
    return _named_struct({"language": _item(x, s, "language", "string"), "text": x["text"]})


def _periods(x: Column, s: T.StructType) -> Column:
    return _named_struct({n: _item(x, s, n, "long") for n in ("start", "end")})


def _trip_json(x: Column, s: T.StructType) -> Column:
    trip = s["trip"].dataType if "trip" in s.fieldNames() else T.StructType([])
    get = lambda n, k: _item(x["trip"], trip, n, k) if trip.fieldNames() else F.lit(None).cast(k)
    number = get("schedule_relationship", "int")
    named = {"schedule_relationship": number, "schedule_relationship_name": enum_name(number, TRIP_RELATION), "direction_id": get("direction_id", "long")}
    modified = F.to_json(x["trip"]["modified_trip"]) if "modified_trip" in trip.fieldNames() else F.lit(None).cast("string")
    named |= {"modified_trip_json": modified} | {n: get(n, "string") for n in ("route_id", "start_date", "start_time", "trip_id")}
    return _named_struct(named)


def _selector_json(x: Column, s: T.StructType) -> Column:
    kinds = {"agency_id": "string", "direction_id": "long", "route_id": "string", "route_type": "long", "stop_id": "string"}
    return _named_struct({n: _item(x, s, n, k) for n, k in kinds.items()} | {"trip": _trip_json(x, s)})


def _route_json(x: Column, s: T.StructType) -> Column:
    cause, effect, kind = (_item(x, s, n, "int") for n in ("cause", "effect", "effect_type"))
    text = s["header_text"].dataType if "header_text" in s.fieldNames() else T.StructType([])
    empty = F.array().cast("array<struct<language:string,text:string>>")
    texts = empty
    if "translation" in text.fieldNames():
        texts = F.coalesce(F.transform(x["header_text"]["translation"], lambda t: _translations(t, text["translation"].dataType.elementType)), empty)
    numbers = {"cause": (cause, CAUSE), "effect": (effect, EFFECT), "effect_type": (kind, EFFECT_TYPE)}
    named = {n: v for n, (v, _) in numbers.items()} | {f"{n}_name": enum_name(v, names) for n, (v, names) in numbers.items()}
    return _named_struct(named | {"header_text": texts, "route_id": _item(x, s, "route_id", "string")})


def alerts(polls: DataFrame) -> DataFrame:
    """One row for each selector of an alert, one without where it has none.

    The alert's lists are repeated on each row as canonical JSON, computed once for each alert
    before its selectors are exploded; first texts and periods are columns too."""
    df, a, s = entities(polls), "entity.alert", "_selector"
    has = F.col(a).isNotNull()
    df = df.filter(has | F.coalesce(field(df, "entity.is_deleted", "boolean"), F.lit(False)))

    def listed(path: str, build, name: str) -> Column:
        return F.when(has, _list_json(df, f"{a}.{path}", build)).alias(name)

    def first(path: str, name: str, kind: str) -> Column:
        schema = _sub(df, f"{a}.{path}")
        return _item(F.get(F.col(f"{a}.{path}"), 0), schema, name, kind) if name in schema.fieldNames() else F.lit(None).cast(kind)

    texts = [c for n in ("header_text", "description_text", "url") for c in (first(f"{n}.translation", "text", "string").alias(n), listed(f"{n}.translation", _translations, f"{n}_json"))]
    texts += [listed(f"{n}.translation", _translations, f"{n}_json") for n in ("tts_header_text", "tts_description_text", "image_alternative_text")]
    texts += [field(df, f"{a}.{n}", "string").alias(f"{n}_json") for n in ("image", "cause_detail", "effect_detail")]
    periods = [first("active_period", n, "long").alias(f"active_period_{n}") for n in ("start", "end")]
    periods += [listed(f"{n}_period", _periods, f"{n}_periods_json") for n in ("active", "communication", "impact")]
    own = [listed("bkk.startText.translation", _translations, "bkk_start_text_json"), listed("bkk.endText.translation", _translations, "bkk_end_text_json")]
    own += [field(df, f"{a}.bkk.modifiedTime", "long").alias("bkk_modified_time"), listed("bkk.route", _route_json, "bkk_route_details_json")]
    plain = [c for n, names in (("cause", CAUSE), ("effect", EFFECT), ("severity_level", SEVERITY)) for c in _named(df, f"{a}.{n}", n, names)]
    base = [*poll_columns(df), *plain, *texts, *periods, listed("informed_entity", _selector_json, "informed_entities_json"), *own]
    selectors = F.col(f"{a}.informed_entity") if field_exists(df, f"{a}.informed_entity") else F.array().cast("array<struct<route_id:string>>")
    rows = df.select(*base, F.explode_outer(selectors).alias(s))
    chosen = [field(rows, f"{s}.{n}", k).alias(f"affected_{n}") for n, k in (("agency_id", "string"), ("route_id", "string"), ("route_type", "long"), ("stop_id", "string"), ("direction_id", "long"))]
    trip = [field(rows, f"{s}.trip.{n}", k).alias(f"affected_trip_{n}".replace("trip_trip", "trip")) for n, k in (("trip_id", "string"), ("route_id", "string"), ("direction_id", "long"), ("start_time", "string"), ("start_date", "string"))]
    return rows.select("*", *chosen, *trip, *_named(rows, f"{s}.trip.schedule_relationship", "affected_trip_schedule_relationship", TRIP_RELATION)).drop(s)


def valid_poll(entities_col: str, expected: str, others: tuple[str, ...] = ()) -> Column:
    """Whether every entity that is not deleted has exactly one payload among the expected one and the others."""
    count = lambda e: sum((e[n].isNotNull().cast("int") for n in (expected, *others)), F.lit(0))
    return F.forall(entities_col, lambda e: F.coalesce(e["is_deleted"], F.lit(False)) | (count(e) == 1))
