"""Freshness and health of feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedspark.operators.carry import inside, joined, with_carry, with_previous
from feedspark.operators.coverage import flag_list


def consecutive_failures(polls: DataFrame, feed: list[str], order: list[str], success: Column, bucket: str) -> DataFrame:
    """Adds the number of failures since the feed's last success; zero at a success.

    Rows are ordered inside (feed, bucket); a bucket hands on the failures at its end."""
    w = inside(feed, bucket, order)
    marked = polls.withColumn("_ok", F.coalesce(success, F.lit(False)).cast("int")).withColumn("_island", F.sum("_ok").over(w))
    own = marked.withColumn("failures", F.sum(1 - F.col("_ok")).over(Window.partitionBy(*feed, bucket, "_island").orderBy(*order)))
    daily = own.groupBy(*feed, bucket).agg(F.max("_ok").alias("_any"), F.max_by("failures", F.struct(*order)).alias("_end"))
    days = Window.partitionBy(*feed).orderBy(bucket)
    daily = daily.withColumn("_age", F.sum("_any").over(days)).withColumn("_run", F.sum("_end").over(Window.partitionBy(*feed, "_age").orderBy(bucket)))
    carried = daily.select(*feed, bucket, F.coalesce(F.lag("_run").over(days), F.lit(0)).alias("_carried"))
    got = joined(own, carried, feed, bucket)
    return got.withColumn("failures", F.col("failures") + F.when(F.col("_island") == 0, F.col("_carried")).otherwise(0)).drop("_ok", "_island", "_carried")


def unchanged_since(polls: DataFrame, feed: list[str], order: list[str], value: str, time: str, name: str, bucket: str) -> DataFrame:
    """Adds the time at which the current run of equal values began; null equals null.

    Rows are ordered inside (feed, bucket); a bucket hands on its last value, then the begin of its last run."""
    seen = with_previous(polls, feed, bucket, order, F.col(value), "_before")
    changed = F.col("_before").isNull() | ~F.col(value).eqNullSafe(F.col("_before.v"))
    marked = seen.withColumn("_at", F.when(changed, F.struct(*order, F.col(time).alias("_t")))).drop("_before")
    carried = with_carry(marked, feed, bucket, {"_carried": F.max("_at")})
    own = F.last("_at", ignorenulls=True).over(inside(feed, bucket, order))
    return carried.withColumn(name, F.coalesce(own["_t"], F.col("_carried._t"))).drop("_at", "_carried")


def freshness(polls: DataFrame, now: Column, source: Column, content_since: Column, header_since: Column, advisory: Column, empty: Column, limits: tuple[float, float, float] = (180, 300, 86_400), newest_entity: Column | None = None) -> DataFrame:
    """Adds ``flags``. ``limits``: age of a source, seconds without change, the same for advisory feeds (alerts).

    An advisory feed only warns: about its header, and about content that does not change unless it is empty."""
    stale, plain_frozen, advisory_frozen = limits
    frozen = F.when(advisory, F.lit(float(advisory_frozen))).otherwise(F.lit(float(plain_frozen)))
    old, content, header = now - source > stale, now - content_since > frozen, now - header_since > frozen
    entity = now - newest_entity > stale if newest_entity is not None else F.lit(False)
    rules = [
        ("source_timestamp_stale", ~advisory & old),
        ("payload_frozen", ~advisory & content),
        ("source_timestamp_frozen", ~advisory & header),
        ("source_timestamp_unchanged_warning", advisory & (F.coalesce(old, F.lit(False)) | F.coalesce(header, F.lit(False)))),
        ("payload_unchanged_warning", advisory & ~empty & content),
        ("entity_timestamp_stale", ~advisory & entity),
    ]
    return polls.withColumn("flags", flag_list(rules))


def health_as_of(polls: DataFrame, feed: list[str], time: str, at: float, success: Column, flags: Column, absent: float, interval: float) -> DataFrame:
    """Each feed's state at ``at``: reasons (absent, last request failed, flags) and warnings."""
    state = F.struct(F.col(time).alias("t"), F.coalesce(success, F.lit(False)).alias("ok"), flags.alias("flags"))
    past = F.col(time) <= at
    got = polls.groupBy(*feed).agg(F.max(F.when(past, state)).alias("last"), F.max(F.when(past & success, F.col(time))).alias("last_success"))
    limit = max(absent, 3 * interval)
    own = F.coalesce("last.flags", F.array().cast("array<string>"))
    reasons = F.concat(flag_list([("absent", F.col("last_success").isNull() | (at - F.col("last_success") > limit)), ("request_failed", ~F.col("last.ok"))]), F.filter(own, lambda f: ~f.endswith("_warning")))
    return got.select(*feed, "last_success", reasons.alias("reasons"), F.filter(own, lambda f: f.endswith("_warning")).alias("warnings")).withColumn("healthy", F.size("reasons") == 0)


def public_state(age: Column, healthy: Column, latest: float = 180.0, ahead: float = 30.0) -> Column:
    """'unknown' outside [-ahead, latest] seconds of age, else 'healthy' or 'degraded'."""
    return F.when(age.isNull() | (age < -ahead) | (age > latest), "unknown").when(healthy, "healthy").otherwise("degraded")


#: Issue codes that may be published, and the code of each storage step that failed.
ISSUES = (
    "absent", "http_failed", "poll_journal_failed", "protobuf_parse_failed", "source_timestamp_stale", "source_timestamp_frozen", "entity_timestamp_stale",
    "payload_frozen", "raw_archive_failed", "derived_spool_failed", "tripupdates_presence_failed", "change_tracker_failed", "request_stuck", "scheduler_overdue",
    "source_timestamp_unchanged_warning", "payload_unchanged_warning", "request_exceeds_cadence", "scheduler_missed_deadline",
)
STEP_CODES = {"parse_ok": "protobuf_parse_failed", "raw_ok": "raw_archive_failed", "spool_ok": "derived_spool_failed", "presence_ok": "tripupdates_presence_failed", "change_tracking_ok": "change_tracker_failed", "poll_journal_ok": "poll_journal_failed"}
#: Codes that do not degrade a feed, besides warnings.
ADVISORY = ("request_exceeds_cadence", "scheduler_missed_deadline")


def public_issues(flags: Column, steps: dict[str, Column]) -> Column:
    """Sorted distinct codes that may be published: of the flags, and of steps (by STEP_CODES' names) that are false; null does not fail."""
    failed = F.array_compact(F.array(*[F.when(~ok, F.lit(STEP_CODES[name])) for name, ok in steps.items()], F.lit(None).cast("string")))
    both = F.array_union(F.coalesce(flags, F.array().cast("array<string>")), failed)
    return F.array_sort(F.filter(both, lambda f: f.isin(*ISSUES)))


def public_feed_state(age: Column, known: Column, issues: Column, latest: float = 180.0, ahead: float = 30.0) -> Column:
    """'unknown' for an old status or an unknown feed, 'degraded' with any code that is neither a warning nor advisory."""
    bad = F.exists(issues, lambda f: ~f.endswith("_warning") & ~f.isin(*ADVISORY))
    return public_state(F.when(known, age), ~bad, latest, ahead)
