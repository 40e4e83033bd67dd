"""Membership of full snapshots: what entered and left between consecutive polls, and its replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedspark.operators.carry import inside, joined


def poll_grid(polls: DataFrame, poll: str, gap: Column, stream: list[str] | None = None, day: Column | None = None) -> DataFrame:
    """Numbers the polls of a stream and its segments: ``gap`` (over _before and the poll) opens a new one.

    Nothing is concluded over a gap; a segment begins with a baseline. Polls are ordered inside
    a ``day`` of the stream (default: the date of a ``poll`` that is a date or time, else none), which hands on its last poll, its number
    of polls and its segments; only days, a row each, are ordered along the stream."""
    own = stream or []
    names = [*own, "_day"]
    dated = polls.schema[poll].dataType.typeName() in ("date", "timestamp", "timestamp_ntz")
    rows = polls.withColumn("_day", (F.to_date(poll) if dated else F.lit(None).cast("date")) if day is None else day)
    w = inside(own, "_day", [poll])
    days = rows.groupBy(*names).agg(F.max(poll).alias("_last"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*own).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select(*names, F.last("_last", ignorenulls=True).over(before).alias("_carried"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_done"))
    out = joined(rows, carried, own, "_day").withColumn("_before", F.coalesce(F.lag(poll).over(w), "_carried"))
    opens = F.col("_before").isNull() | F.coalesce(gap, F.lit(False))
    out = out.withColumns({"poll_no": (F.row_number().over(w) + F.col("_done")).cast("int"), "baseline": opens}).drop("_before", "_carried", "_done")
    opened = out.groupBy(*names).agg(F.sum(F.col("baseline").cast("int")).alias("_opened"))
    earlier = opened.select(*names, F.coalesce(F.sum("_opened").over(before), F.lit(0)).alias("_earlier"))
    out = joined(out, earlier, own, "_day")
    return out.withColumn("segment", F.sum(F.col("baseline").cast("int")).over(w) + F.col("_earlier")).drop("_earlier", "_day")


def membership_changes(members: DataFrame, grid: DataFrame, poll: str, member: list[str], stream: list[str] | None = None) -> DataFrame:
    """(poll, member, change): baseline, entered or withdrawn.

    Works on sightings, not on the product of polls and members: a member enters where its
    previous sighting is not the poll before, and is withdrawn at the next poll of the
    segment if it is not seen there. Members of the grid's polls only."""
    on = [*(stream or []), poll]
    seen = members.select(*on, *member).distinct().join(grid.select(*on, "poll_no", "segment", "baseline"), on)
    w = Window.partitionBy(*(stream or []), *member, "segment").orderBy("poll_no")
    marked = seen.withColumns({"_prev": F.lag("poll_no").over(w), "_next": F.lead("poll_no").over(w)})
    entered = marked.filter(F.col("baseline") | F.col("_prev").isNull() | (F.col("_prev") != F.col("poll_no") - 1))
    entered = entered.select(*on, *member, F.when(F.col("baseline"), "baseline").otherwise("entered").alias("change"))
    following = grid.select(*(stream or []), "segment", F.col("poll_no").alias("_at"), F.col(poll).alias("_poll"))
    left = marked.filter(F.col("_next").isNull() | (F.col("_next") != F.col("poll_no") + 1)).withColumn("_at", F.col("poll_no") + 1)
    left = left.drop(poll).join(following, [*(stream or []), "segment", "_at"]).withColumnRenamed("_poll", poll)
    return entered.unionByName(left.select(*on, *member, F.lit("withdrawn").alias("change")))


def replay(changes: DataFrame, grid: DataFrame, poll: str, stream: list[str] | None = None) -> DataFrame:
    """Number of members at each poll, from the changes alone."""
    on = [*(stream or []), poll]
    net = changes.groupBy(*on).agg(F.sum(F.when(F.col("change") == "withdrawn", -1).otherwise(1)).alias("net"))
    w = Window.partitionBy(*(stream or []), "segment").orderBy("poll_no")
    return grid.join(net, on, "left").withColumn("members", F.sum(F.coalesce("net", F.lit(0))).over(w)).select(*on, "segment", "members")


def replay_violations(changes: DataFrame, grid: DataFrame, poll: str, member: list[str], stream: list[str] | None = None) -> DataFrame:
    """Changes after which a member would be present twice or a negative number of times."""
    on = [*(stream or []), poll]
    w = Window.partitionBy(*(stream or []), *member, "segment").orderBy("poll_no")
    state = changes.join(grid.select(*on, "poll_no", "segment"), on).withColumn("state", F.sum(F.when(F.col("change") == "withdrawn", -1).otherwise(1)).over(w))
    return state.filter(~F.col("state").isin(0, 1)).drop("poll_no")


def trip_deltas(changes: DataFrame, poll: str, trip: list[str], stop: str) -> DataFrame:
    """One row for each poll and trip: sorted arrays of entered and withdrawn stops."""
    pick = lambda kinds: F.array_sort(F.collect_set(F.when(F.col("change").isin(*kinds), F.col(stop))))
    return changes.groupBy(poll, *trip).agg(pick(("baseline", "entered")).alias("entered"), pick(("withdrawn",)).alias("withdrawn"))


def sequence_check(records: DataFrame, stream: list[str], order: list[str], sequence: str) -> DataFrame:
    """For each stream: records, whether it starts at 1, and steps that are not +1."""
    w = Window.partitionBy(*stream).orderBy(*order)
    steps = records.withColumn("_step", F.col(sequence) - F.lag(sequence).over(w)).withColumn("_no", F.row_number().over(w))
    return steps.groupBy(*stream).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.coalesce(F.bool_or((F.col("_no") == 1) & (F.col(sequence) == 1)), F.lit(False)).alias("starts_at_one"),
        F.count(F.when(F.col("_no") > 1, F.when(F.coalesce(F.col("_step") != 1, F.lit(True)), 1))).alias("n_breaks"),
    )
