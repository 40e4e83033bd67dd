"""Validated replay of presence logs: the first fault of each segment, and what may be trusted before it.

A log record: order (its place), poll_id, stream_id, sequence, kind (baseline or delta), version,
trip_count, stop_count, changes array<struct<trip, trip_entered, trip_withdrawn, entered_stops,
withdrawn_stops>>, source_timestamps_version, source_timestamp_updates array<struct<trip,
timestamp>>. Identities are arrays, in which null is a value.

Replaying a log means folding its records in order. But up to a segment's first fault every change fits
the state before it; so the state of a trip or a stop is what its own last change says, and
each rule can be checked by the change before it (a window over one trip or stop) or by sums
over the segment. The first fault found this way is the fault at which a fold would stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedspark.operators.carry import inside, joined, with_previous
from feedspark.storage import staged

#: The versions of a record and of its source timestamps, and the parts of the two identities.
VERSION, SOURCE_VERSION, TRIP_PARTS, STOP_PARTS = 1, 1, 4, 3
#: Records of a log, or changes of trips and stops, that a task holds, about.
ROWS = 100_000
#: The rules in the order in which a record is checked.
RULES = (
    "baseline_sequence", "sequence_gap", "unsupported_record", "trip_identity", "stop_identity", "trip_enters_twice", "not_preceding_membership", "withdrawn_trip_keeps_stops", "membership_counts",
    "unsupported_source_timestamps", "source_timestamps_without_baseline", "invalid_source_timestamp", "source_timestamps_do_not_cover", "promised_evidence", "duplicate_poll",
)


def _parts(n: int | None) -> int:
    return max(1, -(-int(n or 0) // ROWS))


def _dealt(log: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``_chunk``, a range of places of about ROWS records, and ``segment``. Only a row for each chunk is ordered along a log."""
    rows = staged(log.repartitionByRange(_parts(log.count()), *by, "order").withColumn("_chunk", F.spark_partition_id()))
    base = F.coalesce((F.col("kind") == "baseline").cast("int"), F.lit(0))
    sums = rows.groupBy(*by, "_chunk").agg(F.sum(base).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    got = joined(rows, sums.select(*by, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), by, "_chunk")
    return got.withColumn("segment", F.col("_before") + F.sum(base).over(inside(by, "_chunk", ["order"]))).drop("_before")


def segmented(log: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``segment``, counted from 0 (before the first baseline) in each log. A log is a feed's day, a row each poll."""
    return _dealt(log, by).drop("_chunk")


def _rule(name: str) -> Column:
    return F.lit(RULES.index(name))


def _broken(rules: list[tuple[str, Column]]) -> Column:
    """Places of the broken rules; an unknown answer breaks none."""
    return F.array_compact(F.array(*[F.when(cond, _rule(name)) for name, cond in rules]))


def faults(log: DataFrame, by: list[str], trip_parts: int = TRIP_PARTS, stop_parts: int = STOP_PARTS, promised: DataFrame | None = None) -> DataFrame:
    """The first fault of each segment: (by, segment, order, poll_id, rule); segments without one have no row.

    A fault is a broken rule of ``RULES``, the first one of the record. ``promised``: poll_id and
    presence_source_timestamps_version of journals, which a record must repeat where it is not
    null. Records are dealt by ranges of places, changes by trip and stop, about ROWS in a task
    whatever a log's length is; what a range hands on is a row."""
    names = ["order", "poll_id", "stream_id", "sequence", "kind", "version", "trip_count", "stop_count", "changes", "source_timestamps_version", "source_timestamp_updates"]
    rows = staged(_dealt(log.select(*by, *names), by))
    at = [*by, "segment", "order", "poll_id"]
    none = F.array().cast("array<array<string>>")
    changes = F.coalesce("changes", F.array().cast(log.schema["changes"].dataType))
    updates = F.coalesce("source_timestamp_updates", F.array().cast(log.schema["source_timestamp_updates"].dataType))
    baseline = F.col("kind") == "baseline"
    source = F.col("source_timestamps_version")
    trips = F.transform(changes, lambda c: c["trip"])
    stops = F.flatten(F.transform("changes", lambda c: F.concat(F.coalesce(c["entered_stops"], none), F.coalesce(c["withdrawn_stops"], none))))
    updated = F.transform("source_timestamp_updates", lambda u: u["trip"])
    each = lambda c: F.size(F.array_distinct(F.coalesce(c, none)))
    net = lambda c: each(c["entered_stops"]) - each(c["withdrawn_stops"])
    summed = lambda f: F.aggregate(changes, F.lit(0).cast("long"), lambda s, c: s + F.coalesce(f(c), F.lit(0)))
    nets = {"_trips": summed(lambda c: c["trip_entered"].cast("int") - c["trip_withdrawn"].cast("int")), "_stops": summed(net)}

    record = with_previous(rows.withColumns(nets), by, "_chunk", ["order"], F.struct("stream_id", "sequence", source.alias("source")), "_prev")
    polls = rows.groupBy(*by, "poll_id").agg(F.min("order").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    record = joined(record, polls, by, "poll_id")
    handed = record.groupBy(*by, "segment", "_chunk").agg(*[F.sum(c).alias(c) for c in nets])
    before = Window.partitionBy(*by, "segment").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    handed = handed.select(*by, "segment", "_chunk", *[F.sum(c).over(before).alias(f"_before{c}") for c in nets]).filter("_before_trips is not null")
    record = joined(record, handed, [*by, "segment"], "_chunk")
    local = Window.partitionBy(*by, "_chunk", "segment").orderBy("order")
    total = lambda c: F.coalesce(f"_before{c}", F.lit(0)) + F.sum(c).over(local)
    follows = F.col("stream_id").eqNullSafe(F.col("_prev.v.stream_id")) & F.col("sequence").eqNullSafe(F.col("_prev.v.sequence") + 1)
    supported = F.coalesce((F.col("version") == VERSION) & F.col("kind").isin("baseline", "delta"), F.lit(False))
    record = record.withColumns({f"_all{c}": total(c) for c in nets}).withColumn("_rules", _broken([
        ("baseline_sequence", baseline & ~F.col("sequence").eqNullSafe(F.lit(1))), ("sequence_gap", ~baseline & ~F.coalesce(follows, F.lit(False))), ("unsupported_record", ~supported),
        ("trip_identity", F.exists(trips, lambda t: F.size(t) != trip_parts) | (F.size(F.array_distinct(trips)) < F.size(trips))), ("stop_identity", F.exists(stops, lambda s: F.size(s) != stop_parts)),
        ("membership_counts", ~F.col("trip_count").eqNullSafe(F.col("_all_trips")) | ~F.col("stop_count").eqNullSafe(F.col("_all_stops"))),
        ("unsupported_source_timestamps", source.isNotNull() & (source != SOURCE_VERSION)), ("source_timestamps_without_baseline", ~baseline & source.isNotNull() & F.col("_prev.v.source").isNull()),
        ("invalid_source_timestamp", source.isNotNull() & ((F.size(F.array_distinct(updated)) < F.size(updated)) | F.exists("source_timestamp_updates", lambda u: u["timestamp"] < 0))), ("duplicate_poll", F.col("order") > F.col("_first")),
    ]))
    if promised is not None:
        asked = promised.filter("presence_source_timestamps_version is not null").groupBy("poll_id").agg(F.max("presence_source_timestamps_version").alias("_asked"))
        lacking = F.col("_asked").isNotNull() & ~F.col("_asked").eqNullSafe(source)
        record = record.join(asked, "poll_id", "left").withColumn("_rules", F.when(lacking, F.array_append("_rules", _rule("promised_evidence"))).otherwise(F.col("_rules"))).drop("_asked")

    told = lambda t: source.isNotNull() & F.coalesce(F.exists(updates, lambda u: u["trip"] == t), F.lit(False))
    step = lambda t, enters, leaves, n, both, told, owed: F.struct(t.alias("trip"), enters.alias("enters"), leaves.alias("leaves"), n.alias("net"), both.alias("both"), told.alias("told"), owed.alias("owed"))
    changed = F.transform(changes, lambda c: step(c["trip"], c["trip_entered"], c["trip_withdrawn"], net(c), F.size(F.array_intersect(c["entered_stops"], c["withdrawn_stops"])) > 0, told(c["trip"]), source.isNotNull()))
    alone = F.filter(F.array_distinct(F.transform(F.when(source.isNotNull(), updates).otherwise(F.slice(updates, 1, 0)), lambda u: u["trip"])), lambda t: ~F.coalesce(F.array_contains(trips, t), F.lit(False)))
    unknown = lambda kind: F.lit(None).cast(kind)
    only_told = F.transform(alone, lambda t: step(t, unknown("boolean"), unknown("boolean"), unknown("int"), unknown("boolean"), F.lit(True), F.lit(False)))
    move = lambda c, which, enters: F.transform(F.array_distinct(F.coalesce(c[which], none)), lambda s: F.struct(c["trip"].alias("trip"), s.alias("stop"), F.lit(enters).alias("enters")))
    moved = lambda c: F.concat(move(c, "entered_stops", True), move(c, "withdrawn_stops", False))
    steps, moves = F.concat(changed, only_told), F.flatten(F.transform(changes, moved))
    many = rows.agg(F.sum(F.size(changes) + F.size(updates)).alias("steps"), F.sum(F.size(stops)).alias("moves")).first()
    trip = rows.select(*at, F.inline(steps)).repartition(_parts(many.steps), *by, "segment", "trip")
    same_trip = Window.partitionBy(*by, "segment", "trip").orderBy("order")
    last = F.last(F.when(F.col("net").isNotNull(), F.struct("leaves")), ignorenulls=True).over(same_trip.rowsBetween(Window.unboundedPreceding, -1))
    trip = trip.withColumns({"_present": F.coalesce(~last["leaves"], F.lit(False)), "_kept": F.sum("net").over(same_trip), "_here": F.coalesce(F.last(~F.col("leaves"), ignorenulls=True).over(same_trip), F.lit(False))})
    trip = trip.withColumn("_rules", _broken([
        ("trip_enters_twice", F.col("enters") & F.col("_present")), ("not_preceding_membership", (~F.col("enters") & ~F.col("_present")) | F.col("both")), ("withdrawn_trip_keeps_stops", F.col("leaves") & (F.col("_kept") != 0)),
        ("invalid_source_timestamp", F.col("told") & ~F.col("_here")), ("source_timestamps_do_not_cover", F.col("owed") & F.col("enters") & F.col("_here") & ~F.col("told")),
    ]))
    stop = rows.select(*at, F.inline(moves)).repartition(_parts(many.moves), *by, "segment", "trip", "stop")
    was = F.coalesce(F.lag("enters").over(Window.partitionBy(*by, "segment", "trip", "stop").orderBy("order", "enters")), F.lit(False))
    stop = stop.withColumn("_rules", _broken([("not_preceding_membership", F.col("enters") == was)]))

    least = F.min("_f").alias("_f")
    found = [x.filter(F.size("_rules") > 0).select(*by, "segment", F.struct("order", F.array_min("_rules").alias("_rule"), "poll_id").alias("_f")).groupBy(*by, "segment").agg(least) for x in (record, trip, stop)]
    worst = found[0].unionByName(found[1]).unionByName(found[2]).groupBy(*by, "segment").agg(least)
    return worst.select(*by, "segment", F.col("_f.order").alias("order"), F.get(F.array(*map(F.lit, RULES)), F.col("_f._rule")).alias("rule"), F.col("_f.poll_id").alias("poll_id"))


def trusted(log: DataFrame, by: list[str], found: DataFrame) -> DataFrame:
    """The records before their segment's first fault, with ``segment``."""
    ends = found.select(*by, "segment", F.col("order").alias("_end"))
    return joined(segmented(log, by), ends, by, "segment").filter(F.col("_end").isNull() | (F.col("order") < F.col("_end"))).drop("_end")


def log_errors(log: DataFrame, by: list[str], found: DataFrame) -> DataFrame:
    """A row for each log: records, baselines and observations with source timestamps before its first fault, that fault's rule and place (null: none).

    Reading a log ends at its first fault, whatever follows."""
    least = found.groupBy(*by).agg(F.min_by("rule", "order").alias("rule"), F.min("order").alias("at"))
    rows = log.join(least, by, "left")
    fine = F.col("at").isNull() | (F.col("order") < F.col("at"))
    return rows.groupBy(*by).agg(F.count_if(fine).alias("records"), F.count_if(fine & (F.col("kind") == "baseline")).alias("baselines"), F.count_if(fine & F.col("source_timestamps_version").isNotNull()).alias("source_timestamp_observations"), F.first("rule").alias("rule"), F.first("at").alias("at"))


def coverage(members: DataFrame, spans: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Where intervals of values do not cover intervals of membership exactly: (key, reason, start, end).

    Reasons: uncovered (a member without a value), unowned (a value without a member),
    ambiguous (several values at once), repeated_member. Intervals are half-open; empty or reversed ones and
    those with a null end are left out. One sweep over the ends of a key's intervals: equal ends are
    summed first, and neighbouring stretches of one reason are joined. Null keys are keys."""
    n = len(key)

    def ends(df: DataFrame, m: int, v: int) -> DataFrame:
        one = df.filter(F.col(start) < F.col(end)).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(key)], F.explode(F.array(F.struct(F.col(start).alias("at"), F.lit(1).alias("s")), F.struct(F.col(end).alias("at"), F.lit(-1).alias("s")))).alias("e"))
        return one.select(*[f"_k{i}" for i in range(n)], "e.at", (F.col("e.s") * m).alias("m"), (F.col("e.s") * v).alias("v"))

    own = [f"_k{i}" for i in range(n)]
    steps = ends(members, 1, 0).unionByName(ends(spans, 0, 1)).groupBy(*own, "at").agg(F.sum("m").alias("m"), F.sum("v").alias("v"))
    w = Window.partitionBy(*own).orderBy("at")
    state = steps.select(*own, "at", F.lead("at").over(w).alias("_to"), F.sum("m").over(w).alias("m"), F.sum("v").over(w).alias("v")).filter("_to is not null")
    reasons = F.array_compact(F.array(
        F.when((F.col("m") > 0) & (F.col("v") == 0), "uncovered"), F.when((F.col("m") == 0) & (F.col("v") > 0), "unowned"), F.when(F.col("v") > 1, "ambiguous"), F.when(F.col("m") > 1, "repeated_member"),
    ))
    parts = state.select(*own, "at", "_to", F.explode(reasons).alias("reason"))
    r = Window.partitionBy(*own, "reason").orderBy("at")
    fresh = (~F.col("at").eqNullSafe(F.lag("_to").over(r))).cast("int")
    runs = parts.withColumn("_new", fresh).withColumn("_run", F.sum("_new").over(r))
    got = runs.groupBy(*own, "reason", "_run").agg(F.min("at").alias(start), F.max("_to").alias(end))
    return got.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(key)], "reason", start, end)
