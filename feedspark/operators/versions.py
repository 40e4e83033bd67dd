"""Versions of a reference dataset: validity, as-of joins, timelines, and match rates of observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedspark.operators.coverage import flag_list
from feedspark.operators.health import unchanged_since

UNMATCHED = "external_or_unmatched_valid_realtime"
#: Observations that are ordered together with the checks of their day.
ROWS_OF_A_TASK = 200_000


def checks(history: DataFrame, checked: str, order: list[str]) -> DataFrame:
    """One row for each time of a check, the earliest appended, with its day (_day); rows without a time are left out."""
    first = Window.partitionBy(checked).orderBy(*order)
    return history.filter(F.col(checked).isNotNull()).withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n").withColumn("_day", F.to_date(checked))


def validity(history: DataFrame, checked: str, order: list[str]) -> DataFrame:
    """Adds valid_from and valid_to (exclusive, null for the last); of equal times the earliest appended counts.

    Checks are ordered inside their day; only days, a row each, are ordered along the history."""
    rows = checks(history, checked, order)
    days = rows.groupBy("_day").agg(F.min(checked).alias("_first"))
    following = days.select("_day", F.lead("_first").over(Window.orderBy("_day")).alias("_following"))
    own = F.lead(checked).over(Window.partitionBy("_day").orderBy(checked))
    return rows.join(following, "_day").withColumns({"valid_from": F.col(checked), "valid_to": F.coalesce(own, "_following")}).drop("_day", "_following")


def as_of(observations: DataFrame, history: DataFrame, time: str, checked: str, order: list[str], version: list[str], rows_of_a_task: int = ROWS_OF_A_TASK) -> DataFrame:
    """Each observation with the version valid at its time (null before the first).

    A day of many observations is dealt over shares of about ``rows_of_a_task`` rows, each with all
    checks of the day and the version that the day before it hands on; in each share observations
    and checks are put in one order. So a day, or an instant, of any size is spread over
    tasks, and only checks and days, not observations, are ordered along the history. A day gets no
    more shares than leave the copies of its checks below its observations."""
    v = F.struct(*[F.col(c) for c in version])
    known = checks(history, checked, order).select("_day", F.col(checked).cast("timestamp").alias("_t"), v.alias("_v"))
    seen = observations.select(F.to_date(time).alias("_day"), F.col(time).cast("timestamp").alias("_t"), F.struct(*[F.col(c) for c in observations.columns]).alias("_o"))
    both = seen.groupBy("_day").agg(F.count(F.lit(1)).alias("n")).join(known.groupBy("_day").agg(F.count(F.lit(1)).alias("_c"), F.max_by("_v", "_t").alias("_last")), "_day", "full_outer")
    shares = F.greatest(F.lit(1), F.ceil(F.coalesce("n", F.lit(0)) / F.greatest(F.lit(rows_of_a_task), F.coalesce("_c", F.lit(0))))).cast("int")
    days = both.select("_day", shares.alias("_shares"), F.last("_last", ignorenulls=True).over(Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    days = F.broadcast(days)  # a row for each calendar day
    at = days.withColumnRenamed("_day", "_d")
    dealt = seen.join(at, F.col("_day").eqNullSafe(F.col("_d")), "left").drop("_d").withColumn("_share", F.pmod(F.xxhash64("_o"), F.greatest("_shares", F.lit(1))).cast("int"))
    copies = known.join(at, F.col("_day") == F.col("_d")).drop("_d").withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
    w = Window.partitionBy("_day", "_share").orderBy("_t", F.col("_o").isNotNull())
    got = dealt.unionByName(copies, allowMissingColumns=True).withColumn("_v", F.coalesce(F.last("_v", ignorenulls=True).over(w), "_carried")).filter("_o is not null")
    return got.select("_o.*", *[F.when(F.col("_t").isNotNull(), F.col(f"_v.{c}")).alias(c) for c in version])


def day_end(days: DataFrame, history: DataFrame, day: str, checked: str, order: list[str], version: list[str]) -> DataFrame:
    """The version checked last before the end of each day, from the last check of each day of the history."""
    daily = checks(history, checked, order).groupBy(F.col("_day").alias("_d")).agg(F.max_by(F.struct(*version), checked).alias("_v"))
    grid = daily.unionByName(days.select(F.to_date(day).alias("_d")).distinct(), allowMissingColumns=True).groupBy("_d").agg(F.max("_v").alias("_v"))
    upto = Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)
    last = grid.select("_d", F.last("_v", ignorenulls=True).over(upto).alias("_v"))
    return days.join(last, F.to_date(F.col(day)) == F.col("_d"), "left").select(*[days[c] for c in days.columns], *[F.col(f"_v.{c}").alias(c) for c in version])


def timeline(history: DataFrame, checked: str, order: list[str], version: list[str], start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Consecutive intervals of equal version, merged; clipped to [start, end) where given.

    The begin of a run is carried from day to day, see ``unchanged_since``."""
    spans = validity(history, checked, order).withColumns({"_day": F.to_date("valid_from"), "_v": F.struct(*version)})
    runs = unchanged_since(spans, [], ["valid_from"], "_v", "valid_from", "_began", "_day")
    got = runs.groupBy("_began", *version).agg(F.min("valid_from").alias("valid_from"), F.max_by("valid_to", "valid_from").alias("valid_to"), F.count(F.lit(1)).alias("n_checks")).drop("_began")
    if start is not None:
        got = got.withColumn("valid_from", F.greatest("valid_from", start)).filter(F.col("valid_to").isNull() | (F.col("valid_to") > start))
    if end is not None:
        got = got.withColumn("valid_to", F.least(F.coalesce("valid_to", end), end)).filter(F.col("valid_from") < end)
    return got


def version_usage(snapshots: DataFrame, version: list[str], confidence: str) -> DataFrame:
    """For each version: snapshots, its confidence ('mixed' if there are several), and snapshots by confidence."""
    counts = snapshots.groupBy(*version, F.coalesce(F.col(confidence), F.lit("unknown")).alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    by = F.array_sort(F.collect_list(F.struct(F.col("_c").alias("confidence"), F.col("_n").alias("snapshots"))))
    got = counts.groupBy(*version).agg(F.sum("_n").alias("snapshots"), by.alias("by_confidence"))
    return got.withColumn("confidence", F.when(F.size("by_confidence") > 1, "mixed").otherwise(F.get("by_confidence", F.lit(0))["confidence"]))


def static_matches(observed: DataFrame, trips: DataFrame, routes: DataFrame, stop_times: DataFrame, trip: str, route: str, stop: list[str], mode: str, version: list[str] | None = None) -> DataFrame:
    """Distinct observed stop visits with their count, and whether trip, route and stop match; unmatched ones stay.

    Observations are counted before the joins. Reference tables must be unique on their keys; with
    ``version`` they hold several versions and an observation meets those of its own (null: none)."""
    v = version or []
    counted = observed.groupBy(*[c for c in observed.columns]).agg(F.count(F.lit(1)).alias("n"))
    t = trips.select(*v, trip, F.col(route).alias("_route"), F.lit(True).alias("trip_matched"))
    r = routes.select(*v, F.col(route).alias("_route"), F.col(mode).alias("_mode"))
    s = stop_times.select(*v, trip, *stop, F.lit(True).alias("exact"))
    got = counted.join(t, [*v, trip], "left").join(r, [*v, "_route"], "left").join(s, [*v, trip, *stop], "left")
    flags = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("trip_matched", "exact")}
    return got.withColumns(flags).withColumn("mode", F.when(F.col("trip_matched"), F.coalesce("_mode", F.lit("static_route_type_unknown"))).otherwise(UNMATCHED)).drop("_mode", "_route")


def match_rates(matches: DataFrame, warning_rate: float = 0.9, resolved: Column | None = None) -> DataFrame:
    """By mode and overall ('all'): updates, trip and exact matches, their rates, warnings.

    Where ``resolved`` is false no version was known at the time: such updates count in the
    overall total (and as ``unresolved`` there) only. A mode warns on its exact rate, but for
    unmatched external services, which are valid observations; overall, the trip rate and the
    exact rate warn apart, and so do unresolved updates."""
    known = F.lit(True) if resolved is None else F.coalesce(resolved, F.lit(False))
    rows = matches.withColumn("_known", known)
    of = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    sums = [of(F.lit(True)).alias("updates"), of(F.col("_known") & F.col("trip_matched")).alias("trip_matches"), of(F.col("_known") & F.col("exact")).alias("exact_matches"), of(~F.col("_known")).alias("unresolved")]
    by_mode = rows.groupBy(F.when(F.col("_known"), F.col("mode")).alias("mode")).agg(*sums)
    overall = by_mode.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("updates", "trip_matches", "exact_matches", "unresolved")]).select(F.lit("all").alias("mode"), "*")
    share = lambda c: F.when(F.col("updates") > 0, F.col(c) / F.col("updates"))
    got = by_mode.filter("mode is not null").unionByName(overall).withColumns({"trip_rate": share("trip_matches"), "exact_rate": share("exact_matches")})
    whole = F.col("mode") == "all"
    return got.withColumn("warnings", flag_list([
        ("unresolved_updates", whole & (F.col("unresolved") > 0)),
        ("low_trip_rate", whole & (F.col("trip_rate") < warning_rate)),
        ("low_exact_rate", (F.col("mode") != UNMATCHED) & (F.col("exact_rate") < warning_rate)),
    ]))


def static_join_report(matches: DataFrame, usage: DataFrame, by: list[str], version: str, route: str, confidence: str, warning_rate: float = 0.9) -> DataFrame:
    """One nested row for each ``by`` (a date): how its observations match the reference versions of their time.

    ``matches``: ``static_matches`` with ``by``; ``usage``: a row for each snapshot with ``by``, its
    ``version`` (null: none known) and that version's ``confidence``. Columns: snapshots, versions
    (digest, confidence or 'mixed', snapshots, by_confidence), unresolved, updates, trip_matches,
    exact_matches, their rates, modes (array, by name), unmatched_routes (most frequent first, null as
    '(missing_route_id)'), warnings. Counts are summed once, over grouping sets of mode and route, before
    they are put together; a warned mode is named."""
    known = F.col(version).isNotNull()
    rows = matches.withColumns({"_mode": F.when(known, F.col("mode")), "_route": F.when(known & ~F.col("trip_matched"), F.coalesce(route, F.lit("(missing_route_id)")))})
    of = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    sums = [of(F.lit(True)).alias("updates"), of(known & F.col("trip_matched")).alias("trip_matches"), of(known & F.col("exact")).alias("exact_matches"), of(~known).alias("unresolved"), F.grouping_id().alias("_set")]
    own = [F.col(c) for c in by]
    cells = rows.groupingSets([[*own, F.col("_mode")], [*own, F.col("_route")], own], *own, F.col("_mode"), F.col("_route")).agg(*sums)
    share = lambda c: F.when(F.col("updates") > 0, F.col(c) / F.col("updates"))
    cells = cells.withColumns({"trip_rate": share("trip_matches"), "exact_rate": share("exact_matches")})
    mode = F.struct(F.col("_mode").alias("mode"), "updates", "trip_matches", "exact_matches", "exact_rate")
    place = F.struct((-F.col("updates")).alias("k"), F.col("_route").alias("route"), F.col("updates").alias("n"))
    by_mode, by_route, whole = (F.col("_set") == 1) & F.col("_mode").isNotNull(), (F.col("_set") == 2) & F.col("_route").isNotNull(), F.col("_set") == 3
    got = cells.groupBy(*by).agg(
        *[F.max(F.when(whole, F.col(c))).alias(c) for c in ("updates", "trip_matches", "exact_matches", "unresolved", "trip_rate", "exact_rate")],
        F.array_sort(F.collect_list(F.when(by_mode, mode))).alias("modes"),
        F.transform(F.array_sort(F.collect_list(F.when(by_route, place))), lambda r: F.struct(r["route"].alias("route"), r["n"].alias("n"))).alias("unmatched_routes"),
    )
    used = version_usage(usage.filter(F.col(version).isNotNull()), [*by, version], confidence)
    each = F.struct(F.col(version).alias("version"), "confidence", "snapshots", "by_confidence")
    versions = used.groupBy(*by).agg(F.array_sort(F.collect_list(each)).alias("versions"), F.bool_or(F.exists("by_confidence", lambda c: c["confidence"] == "legacy_schedule_uncertain")).alias("_legacy"))
    snapshots = usage.groupBy(*by).agg(F.count(F.lit(1)).alias("snapshots"))
    out = snapshots.join(versions, by, "left").join(got, by, "left")
    weak = F.transform(F.filter("modes", lambda m: (m["mode"] != UNMATCHED) & (m["exact_rate"] < warning_rate)), lambda m: F.concat(F.lit("low_exact_rate:"), m["mode"]))
    warnings = F.concat(flag_list([
        ("unresolved_updates", F.col("unresolved") > 0), ("legacy_schedule_uncertain", F.coalesce("_legacy", F.lit(False))), ("low_trip_rate", F.col("trip_rate") < warning_rate), ("low_exact_rate", F.col("exact_rate") < warning_rate),
    ]), F.coalesce(weak, F.array().cast("array<string>")))
    return out.withColumn("warnings", warnings).drop("_legacy")
