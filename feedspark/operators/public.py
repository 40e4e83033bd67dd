"""What is published: latest snapshots, an allow-list of vehicle columns, contract checks, and choices of snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedspark.functions import scalars as fn
from feedspark.operators.coverage import flag_list

#: Columns that may be published, in order, modes, and the largest number of vehicles.
COLUMNS = ("id", "lon", "lat", "label", "mode", "color", "bearing", "recorded_at")
MODES = ("tram", "metro", "trolleybus", "bus", "ferry", "rail", "other")
MOST = 10_000


def latest_snapshot(snapshots: DataFrame, feed: list[str], order: list[str]) -> DataFrame:
    """The last snapshot of each feed, with all its columns (a partial aggregate, no window over a feed's history)."""
    last = snapshots.groupBy(*feed).agg(F.max_by(F.struct(*[F.col(c) for c in snapshots.columns]), F.struct(*order)).alias("_s"))
    return last.select("_s.*")


def in_hours(rows: DataFrame, time: Column, first: int, end: int) -> DataFrame:
    """Rows whose UTC hour is in [first, end)."""
    if not 0 <= first < end <= 24:
        raise ValueError("hours must satisfy 0 <= first < end <= 24")
    hour = F.pmod(F.floor(F.unix_timestamp(time.cast("timestamp")) / 3600), F.lit(24))
    return rows.filter((hour >= first) & (hour < end))


def first_snapshots(rows: DataFrame, feed: list[str], snapshot: list[str], n: int) -> DataFrame:
    """Rows of the first ``n`` snapshots of each feed (a top-n over the distinct snapshots)."""
    w = Window.partitionBy(*feed).orderBy(*snapshot)
    own = rows.select(*feed, *snapshot).distinct().withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")
    return rows.join(own, [*feed, *snapshot], "left_semi")


def public_vehicles(vehicles: DataFrame, catalog: DataFrame, route: str, default_color: str = "#009fe3", most: int = MOST) -> DataFrame:
    """Only COLUMNS of plottable vehicles, the first of each id by ``pos``, at most ``most`` by ``pos``.

    ``vehicles``: vehicle_id, entity_id, lon, lat, route, bearing, recorded_at, pos, deleted;
    ``catalog``: route, label, mode, color (unique by route). A route that it lacks is labelled
    by its id, or 'Unassigned'."""
    known = catalog.select(F.col(route), F.col("label").alias("_label"), F.col("mode").alias("_mode"), F.col("color").alias("_color"))
    v = vehicles.filter(fn.plottable(F.col("lon"), F.col("lat")) & ~F.coalesce("deleted", F.lit(False))).join(known, route, "left")
    out = v.select(
        "pos", fn.public_id(F.col("vehicle_id"), F.col("entity_id")).alias("id"), fn.rounded_position(F.col("lon")).alias("lon"), fn.rounded_position(F.col("lat")).alias("lat"),
        fn.printable_label(F.coalesce("_label", fn.empty_to_null(F.col(route)), F.lit("Unassigned"))).alias("label"), F.coalesce("_mode", F.lit("other")).alias("mode"),
        fn.route_color(F.regexp_replace("_color", "^#", ""), F.lit(default_color)).alias("color"), fn.valid_bearing(F.col("bearing")).alias("bearing"), "recorded_at",
    )
    first = out.groupBy("id").agg(F.min_by(F.struct("pos", *COLUMNS), "pos").alias("v")).select("v.*")
    return first.orderBy("pos").limit(most).select(*COLUMNS)


def contract_violations(published: DataFrame, key: str, most: int = MOST, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """(key, violation): rows that break a rule, and rules of the whole table with a null key.

    Rules: no unknown column, ids of 20 hex digits that do not repeat, coordinates and bearing
    in range, known modes, colors of six hex digits, labels of 1 to 48 characters, at most ``most`` rows."""
    rules = [
        ("invalid_id", ~F.coalesce(F.col("id").rlike("^[0-9a-f]{20}$"), F.lit(False))), ("repeated_id", F.col("_n") > 1), ("longitude", ~F.coalesce(F.col("lon").between(-180, 180), F.lit(False))),
        ("latitude", ~F.coalesce(F.col("lat").between(-90, 90), F.lit(False))), ("mode", ~F.coalesce(F.col("mode").isin(*MODES), F.lit(False))), ("color", ~F.coalesce(F.col("color").rlike("^#[0-9a-f]{6}$"), F.lit(False))),
        ("bearing", ~F.col("bearing").between(0, 360)), ("label", ~F.coalesce(F.length("label").between(1, 48), F.lit(False))),
    ]
    times = published.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("id", "_id")
    rows = published.join(times, F.col("id").eqNullSafe(F.col("_id")), "left").select(key, F.explode(flag_list(rules)).alias("violation"))
    extra = sorted(set(published.columns) - {*columns, key})
    unknown = F.array(*[F.lit(f"unknown_column:{c}") for c in extra]).cast("array<string>")
    whole = published.agg(F.concat(F.when(F.count(F.lit(1)) > most, F.array(F.lit("too_many_rows"))).otherwise(F.array().cast("array<string>")), unknown).alias("v"))
    return rows.unionByName(whole.select(F.lit(None).cast(published.schema[key].dataType).alias(key), F.explode("v").alias("violation")))
