"""Scalar functions, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def enum_name(number: Column, names: dict[int, str]) -> Column:
    """Name of an enum's number; an unknown number as text."""
    known = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.element_at(known, number), number.cast("string"))


def optional_int(text: Column) -> Column:
    return text.try_cast("bigint")


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def strict_date(text: Column) -> Column:
    """A calendar date in the form YYYY-MM-DD, else null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def aware_timestamp(text: Column) -> Column:
    """A timestamp that names its zone; one without a zone, or malformed, is null."""
    return F.when(text.rlike(r"([zZ]|[+-]\d{2}:?\d{2})$"), F.try_to_timestamp(text))


def iso_seconds(epoch: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def bounded_count(value: Column, most: int = 9_000_000_000_000_000) -> Column:
    return F.when(value.between(0, most), value)


#: Fixed values, in order: mode, basic types, range of further types.
ANALYTIC_MODES = (
    ("tram", (0, 900), None), ("metro", (1,), None), ("trolleybus", (11, 800), None), ("bus", (3,), (700, 799)),
    ("ferry", (4,), (1000, 1099)), ("hev", (109,), None), ("rail", (2,), (100, 199)),
)
#: Fixed values, in order: mode, types as text, prefix of further types.
PUBLIC_MODES = (("tram", ("0", "900"), None), ("metro", ("1", "400", "401", "402"), None), ("trolleybus", ("11", "800"), None), ("bus", ("3",), "7"), ("ferry", ("4", "1000"), None), ("rail", ("2",), "1"))


def analytic_mode(route_type: Column) -> Column:
    """Mode for analyses; other numbers by name, null as unknown."""
    t = route_type.try_cast("int")
    out = F.when(t.isNull(), "static_route_type_unknown")
    for mode, basic, span in ANALYTIC_MODES:
        out = out.when(t.isin(*basic) | (t.between(*span) if span else F.lit(False)), mode)
    return out.otherwise(F.concat(F.lit("route_type_"), t.cast("string")))


def public_mode(route_type: Column) -> Column:
    """Mode for publication, by the text of the type; disagrees with ``analytic_mode`` on purpose."""
    t = F.coalesce(route_type, F.lit(""))
    out = F.when(F.lit(False), "")
    for mode, texts, prefix in PUBLIC_MODES:
        out = out.when(t.isin(*texts) | (t.startswith(prefix) if prefix else F.lit(False)), mode)
    return out.otherwise("other")


def printable_label(text: Column, size: int = 48) -> Column:
    return F.substring(F.regexp_replace(text, r"[\p{C}\p{Z}&&[^ ]]", ""), 1, size)


def route_color(color: Column, fallback: Column) -> Column:
    return F.when(color.rlike("^[0-9A-Fa-f]{6}$"), F.concat(F.lit("#"), F.lower(color))).otherwise(fallback)


def public_id(vehicle: Column, entity: Column) -> Column:
    return F.substring(F.sha2(F.coalesce(empty_to_null(vehicle), entity), 256), 1, 20)


def rounded_position(value: Column) -> Column:
    return F.round(value, 6)


def valid_bearing(value: Column) -> Column:
    return F.when(value.between(0, 360) & ~F.isnan(value), value)


def plottable(lon: Column, lat: Column) -> Column:
    """Both finite, in range and not both zero."""
    fine = ~F.isnan(lon) & ~F.isnan(lat) & lon.between(-180, 180) & lat.between(-90, 90) & ~((lon == 0) & (lat == 0))
    return F.coalesce(fine, F.lit(False))


def age_label(seconds: Column) -> Column:
    s = F.greatest(F.lit(0), F.floor(seconds))
    return F.when(s < 60, F.concat(s, F.lit("s"))).when(s < 3600, F.concat(F.floor(s / 60), F.lit("m"))).when(s < 86_400, F.concat(F.floor(s / 3600), F.lit("h"))).otherwise(F.concat(F.floor(s / 86_400), F.lit("d")))


def beyond_tolerance(old: Column, new: Column, tolerance: float) -> Column:
    """Both null: equal; one null: changed; tolerance 0: any difference; else strictly more than it."""
    differs = F.abs(new - old) > tolerance if tolerance > 0 else old != new
    return F.when(old.isNull() & new.isNull(), False).when(old.isNull() | new.isNull(), True).otherwise(differs)


def source_confidence(source: Column) -> Column:
    return F.when(source == "legacy_archive_migration", "legacy_schedule_uncertain").otherwise("collector_observed")
