"""Decoding of GTFS-Realtime payloads to nested rows. Needs the protobuf package on the executors."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Messages of the public specification, and the operator's extension (field 1006) as ``bkk``.
#: "name number type", "!" for required, "*" for repeated.
MESSAGES = """
FeedMessage: header 1 FeedHeader!, entity 2 FeedEntity*
FeedHeader: gtfs_realtime_version 1 string!, incrementality 2 enum, timestamp 3 uint64, feed_version 4 string
FeedEntity: id 1 string!, is_deleted 2 bool, trip_update 3 TripUpdate, vehicle 4 VehiclePosition, alert 5 Alert, shape 6 bytes, stop 7 bytes, trip_modifications 8 bytes
TripUpdate: trip 1 TripDescriptor!, stop_time_update 2 StopTimeUpdate*, vehicle 3 VehicleDescriptor, timestamp 4 uint64, delay 5 int32, trip_properties 6 TripProperties
TripProperties: trip_id 1 string, start_date 2 string, start_time 3 string, shape_id 4 string, trip_headsign 5 string, trip_short_name 6 string
StopTimeEvent: delay 1 int32, time 2 int64, uncertainty 3 int32, scheduled_time 4 int64
StopTimeUpdate: stop_sequence 1 uint32, arrival 2 StopTimeEvent, departure 3 StopTimeEvent, stop_id 4 string, schedule_relationship 5 enum, stop_time_properties 6 StopTimeProperties, departure_occupancy_status 7 enum, bkk 1006 RealCityStop
StopTimeProperties: assigned_stop_id 1 string, stop_headsign 2 string, pickup_type 3 enum, drop_off_type 4 enum
RealCityStop: scheduled_arrival 1 StopTimeEvent, scheduled_departure 2 StopTimeEvent
VehiclePosition: trip 1 TripDescriptor, position 2 Position, current_stop_sequence 3 uint32, current_status 4 enum, timestamp 5 uint64, congestion_level 6 enum, stop_id 7 string, vehicle 8 VehicleDescriptor, occupancy_status 9 enum, occupancy_percentage 10 uint32, multi_carriage_details 11 CarriageDetails*
CarriageDetails: id 1 string, label 2 string, occupancy_status 3 enum, occupancy_percentage 4 int32, carriage_sequence 5 uint32
Position: latitude 1 float!, longitude 2 float!, bearing 3 float, odometer 4 double, speed 5 float
TripDescriptor: trip_id 1 string, start_time 2 string, start_date 3 string, schedule_relationship 4 enum, route_id 5 string, direction_id 6 uint32, modified_trip 7 ModifiedTrip
ModifiedTrip: modifications_id 1 string, affected_trip_id 2 string, start_time 3 string, start_date 4 string
VehicleDescriptor: id 1 string, label 2 string, license_plate 3 string, wheelchair_accessible 4 enum, bkk 1006 RealCityVehicle
RealCityVehicle: vehicle_model 1 string, deviated 2 bool, vehicle_type 3 int32, door_open 4 bool, stop_distance 5 int32
Alert: active_period 1 TimeRange*, informed_entity 5 EntitySelector*, cause 6 enum, effect 7 enum, url 8 TranslatedString, header_text 10 TranslatedString, description_text 11 TranslatedString, tts_header_text 12 TranslatedString, tts_description_text 13 TranslatedString, severity_level 14 enum, image 15 TranslatedImage, image_alternative_text 16 TranslatedString, cause_detail 17 TranslatedString, effect_detail 18 TranslatedString, communication_period 19 TimeRange*, impact_period 20 TimeRange*, bkk 1006 RealCityAlert
RealCityAlert: startText 1 TranslatedString, endText 2 TranslatedString, modifiedTime 3 uint64, route 4 RouteDetail*
RouteDetail: route_id 1 string!, header_text 2 TranslatedString, cause 3 enum, effect 4 enum, effect_type 5 enum
TimeRange: start 1 uint64, end 2 uint64
EntitySelector: agency_id 1 string, route_id 2 string, route_type 3 int32, trip 4 TripDescriptor, stop_id 5 string, direction_id 6 uint32
TranslatedString: translation 1 Translation*
Translation: text 1 string!, language 2 string
TranslatedImage: localized_image 1 LocalizedImage*
LocalizedImage: url 1 string!, media_type 2 string!, language 3 string
"""
#: Scalar types: in Spark, in Arrow, and in the descriptor; enums stay numbers, so that unknown ones are kept.
SCALARS = {
    "string": (T.StringType(), pa.string(), "STRING"), "bool": (T.BooleanType(), pa.bool_(), "BOOL"), "bytes": (T.BinaryType(), pa.binary(), "BYTES"), "enum": (T.IntegerType(), pa.int32(), "INT32"),
    "int32": (T.IntegerType(), pa.int32(), "INT32"), "uint32": (T.LongType(), pa.int64(), "UINT32"), "int64": (T.LongType(), pa.int64(), "INT64"), "uint64": (T.LongType(), pa.int64(), "UINT64"),
    "float": (T.FloatType(), pa.float32(), "FLOAT"), "double": (T.DoubleType(), pa.float64(), "DOUBLE"),
}


@functools.cache
def messages() -> dict[str, list[tuple[str, int, str, str]]]:
    """For each message its fields: name, number, type, and '!' or '*' or ''."""
    out = {}
    for line in MESSAGES.strip().splitlines():
        name, fields = line.split(": ", 1)
        split = [f.split() for f in fields.split(", ")]
        out[name] = [(n, int(no), kind.rstrip("!*"), kind[-1] if kind[-1] in "!*" else "") for n, no, kind in split]
    return out


def spark_type(message: str) -> T.StructType:
    def of(kind: str, label: str) -> T.DataType:
        one = SCALARS[kind][0] if kind in SCALARS else spark_type(kind)
        return T.ArrayType(one) if label == "*" else one

    return T.StructType([T.StructField(n, of(kind, label)) for n, _, kind, label in messages()[message]])


def arrow_type(message: str) -> pa.StructType:
    def of(kind: str, label: str) -> pa.DataType:
        one = SCALARS[kind][1] if kind in SCALARS else arrow_type(kind)
        return pa.list_(one) if label == "*" else one

    return pa.struct([pa.field(n, of(kind, label)) for n, _, kind, label in messages()[message]])


@functools.cache
def message_class(name: str = "FeedMessage") -> type:
    """The protobuf class, from a descriptor that is built once in a worker."""
    from google.protobuf import descriptor_pb2, descriptor_pool, message_factory

    proto = descriptor_pb2.FieldDescriptorProto
    file = descriptor_pb2.FileDescriptorProto(name="feedspark.proto", package="feedspark", syntax="proto2")
    for m, fields in messages().items():
        message = file.message_type.add(name=m)
        for n, number, kind, label in fields:
            f = message.field.add(name=n, number=number, label={"!": proto.LABEL_REQUIRED, "*": proto.LABEL_REPEATED}.get(label, proto.LABEL_OPTIONAL))
            f.type = getattr(proto, f"TYPE_{SCALARS[kind][2]}") if kind in SCALARS else proto.TYPE_MESSAGE
            if kind not in SCALARS:
                f.type_name = f".feedspark.{kind}"
    pool = descriptor_pool.DescriptorPool()
    pool.AddSerializedFile(file.SerializeToString())
    return message_factory.GetMessageClass(pool.FindMessageTypeByName(f"feedspark.{name}"))


def _plain(message: Any, kind: str) -> dict:
    """Only fields that are set; a number beyond a signed long is null."""
    kinds = {n: (k, label) for n, _, k, label in messages()[kind]}
    out = {}
    for f, v in message.ListFields():
        k, label = kinds[f.name]
        if k not in SCALARS:
            out[f.name] = [_plain(x, k) for x in v] if label == "*" else _plain(v, k)
        else:
            out[f.name] = None if k == "uint64" and v >= 2**63 else v
    return out


def parse(payload: bytes | None) -> tuple[dict | None, str | None]:
    """The message, or why it cannot be read; a missing required field is an error."""
    if payload is None:
        return None, "no payload"
    message = message_class()()
    try:
        message.ParseFromString(payload)
    except Exception as error:  # the package's DecodeError
        return None, type(error).__name__
    return (_plain(message, "FeedMessage"), None) if message.IsInitialized() else (None, "missing required fields")


def decode(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Replaces the payload with header, entities (nested as in the specification) and parse_error.

    Each poll is an Arrow batch of its own, as one may hold megabytes. Reads of the payload
    column are as large as spark.sql.execution.arrow.maxRecordsPerBatch says: set it low for
    large polls."""
    rest = [c for c in df.columns if c != payload]
    whole = spark_type("FeedMessage")
    own = [T.StructField("header", whole["header"].dataType), T.StructField("entities", whole["entity"].dataType), T.StructField("parse_error", T.StringType())]
    names = [*rest, "header", "entities", "parse_error"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = arrow_type("FeedMessage")
        for batch in batches:
            for i in range(batch.num_rows):
                message, error = parse(batch.column(payload)[i].as_py())
                got = message or {}
                made = [pa.array([got.get("header")], kind.field("header").type), pa.array([got.get("entity", []) if message is not None else None], kind.field("entity").type), pa.array([error], pa.string())]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in rest), *made], names=names)

    return df.mapInArrow(run, T.StructType([*df.select(*rest).schema.fields, *own]))
