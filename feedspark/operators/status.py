"""Reports on a collection as a whole: statistics over all days, maintenance, counts of a published snapshot, one table of polls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedspark.operators.coverage import flag_list
from feedspark.operators.health import public_state
from feedspark.operators.public import MOST

#: The largest count that is published, and seconds after which a maintenance status, a viewed snapshot and a check of reference data are old.
LARGEST, MAINTENANCE_OLD, VIEW_OLD, AHEAD, CHECK_OLD = 9_000_000_000_000_000, 300.0, 90.0, 30.0, 172_800.0


def poll_table(feeds: dict[str, DataFrame], name: str = "feed") -> DataFrame:
    """The feeds' rows as one table with their feed's name; columns are matched by name, those that a feed lacks are null."""
    named = [df.withColumn(name, F.lit(feed)) for feed, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def counted(value: Column) -> Column:
    """The count if it is one that may be published, else null."""
    return F.when((value >= 0) & (value <= LARGEST), value.cast("long"))


def collection_statistics(days: DataFrame, receipts: DataFrame, date: str, feed: str, today: Column, repository: Column | None = None) -> DataFrame:
    """One row: evidenced_since, evidenced_days, polls_recorded, event_rows, raw_snapshots, latest_date, latest_quality, verified_days, last_verified_date.

    ``days``: rows by date and feed with attempted_polls, parquet_rows, raw_snapshots, first_success, quality_ok;
    a day is evidence if it is before ``today`` and any feed was polled. ``receipts``: date, version,
    remote_verified, file_date (the date in the file's name). Days are summed first, a row each; only those meet at the end."""
    n = lambda c: F.coalesce(counted(F.col(c)), F.lit(0))
    daily = days.filter(F.col(date) < today).groupBy(date).agg(
        F.sum(n("attempted_polls")).alias("polls"), F.sum(n("parquet_rows")).alias("rows"), F.sum(n("raw_snapshots")).alias("raw"), F.min("first_success").alias("since"), F.bool_and(F.coalesce("quality_ok", F.lit(False))).alias("good")
    ).filter("polls > 0")
    total = daily.agg(
        F.min("since").alias("evidenced_since"), F.count(F.lit(1)).alias("evidenced_days"), F.coalesce(F.sum("polls"), F.lit(0)).alias("polls_recorded"), F.coalesce(F.sum("rows"), F.lit(0)).alias("event_rows"),
        F.coalesce(F.sum("raw"), F.lit(0)).alias("raw_snapshots"), F.max(date).alias("latest_date"), F.max_by(F.when(F.col("good"), "good").otherwise("flagged"), date).alias("latest_quality"),
    )
    fine = (F.col("version") == 2) & F.col("remote_verified") & F.col(date).eqNullSafe(F.col("file_date")) & (F.col(date) < today)
    verified = receipts.filter(fine).agg(F.count(F.lit(1)).alias("verified_days"), F.max(date).alias("last_verified_date"))
    return total.withColumn("_one", F.lit(1)).join(verified.withColumn("_one", F.lit(1)), "_one").drop("_one")


def latest_day_counts(days: DataFrame, date: str, feed: str, today: Column) -> DataFrame:
    """(feed, expected_polls, recorded_polls, data_polls) of the last evidenced day before ``today``; counts that may not be published are null."""
    polled = days.filter(F.col(date) < today)
    last = polled.groupBy(date).agg(F.sum(F.coalesce(counted(F.col("attempted_polls")), F.lit(0))).alias("_n")).filter("_n > 0").agg(F.max(date).alias(date))
    return polled.join(F.broadcast(last), date, "left_semi").select(feed, *[counted(F.col(c)).alias(n) for c, n in (("expected_polls", "expected_polls"), ("attempted_polls", "recorded_polls"), ("successful_data_polls", "data_polls"))])


def maintenance_state(age: Column, healthy: Column) -> Column:
    """'unknown' outside [-30, 300] seconds of age, else 'healthy' or 'degraded'; only a status that says so is healthy."""
    return public_state(age, F.coalesce(healthy, F.lit(False)), MAINTENANCE_OLD, AHEAD)


def viewed_state(state: Column, age: Column) -> Column:
    """A viewer's state of a snapshot: as published while it is at most 90 seconds old (30 ahead), else 'unknown'."""
    return F.when(age.isNull() | (age < -AHEAD) | (age > VIEW_OLD), "unknown").otherwise(state)


def maintenance_report(pending: DataFrame, checks: DataFrame, legacy: DataFrame, date: str, now: Column, enabled: bool = True, check_interval: float = 86_400.0, backlog_hours: float = 48.0, failed_compactions: DataFrame | None = None) -> DataFrame:
    """One row: pending days, the oldest, the last successful check, reasons, warnings, healthy.

    ``pending``: dates that wait for their archive; ``checks``: checked_at and success of reference
    data; ``legacy``: date (null: the reference archives), handled, confirmed, complete; ``failed_compactions``: error.
    Reasons: a check older than twice its interval (48 hours at least) or none, pending dates
    older than ``backlog_hours``, compactions that failed. Warnings: no archive is kept, legacy
    days unconfirmed or incomplete, legacy reference archives unconfirmed."""
    one = lambda df: df.withColumn("_one", F.lit(1))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    seconds = F.unix_timestamp(now)
    waiting = (pending if enabled else pending.filter("1 = 0")).agg(F.count(F.lit(1)).alias("n_pending"), F.min(date).alias("oldest"))
    checked = checks.filter("success").agg(F.max("checked_at").alias("last_check"))
    days = F.col(date).isNotNull()
    old = legacy.agg(F.count_if(days & yes("handled") & ~yes("confirmed")).alias("_unconfirmed"), F.count_if(days & ~yes("complete")).alias("_incomplete"), F.count_if(~days & ~yes("confirmed")).alias("_archives"))
    failed = (failed_compactions.select("error") if failed_compactions is not None else pending.filter("1 = 0").select(F.lit("").alias("error"))).agg(F.array_sort(F.collect_set("error")).alias("_failed"))
    got = one(waiting).join(one(checked), "_one").join(one(old), "_one").join(one(failed), "_one")
    reasons = F.concat(flag_list([
        ("static_gtfs_stale", F.col("last_check").isNull() | (seconds - F.unix_timestamp("last_check") > max(2 * check_interval, CHECK_OLD))),
        ("backup_backlog_stale", seconds - F.unix_timestamp(F.col("oldest").cast("timestamp")) > backlog_hours * 3600),
    ]), F.transform("_failed", lambda e: F.concat(F.lit("compaction:"), e)))
    warnings = flag_list([
        ("offsite_backup_disabled", F.lit(not enabled)), ("legacy_remote_copy_unconfirmed", F.col("_unconfirmed") > 0), ("legacy_inventory_incomplete", F.col("_incomplete") > 0), ("legacy_static_gtfs_remote_copy_unconfirmed", F.col("_archives") > 0),
    ])
    return got.select("n_pending", "oldest", "last_check", reasons.alias("reasons"), warnings.alias("warnings")).withColumn("healthy", F.size("reasons") == 0)


def snapshot_violations(snapshots: DataFrame, vehicles: DataFrame, key: list[str], most: int = MOST) -> DataFrame:
    """(key, violation) of published snapshots: counts that are none, vehicles and omitted records that do not add up to the records, too many vehicles.

    ``snapshots``: key, records_in_source, omitted_records; ``vehicles``: a row each, by key."""
    held = vehicles.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    got = snapshots.join(held, key, "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    is_count = lambda c: counted(F.col(c)).isNotNull()
    rules = [
        ("records_in_source", ~is_count("records_in_source")), ("omitted_records", ~is_count("omitted_records")), ("too_many_vehicles", F.col("_n") > most),
        ("counts_do_not_add_up", ~(F.col("_n") + F.col("omitted_records")).eqNullSafe(F.col("records_in_source").cast("long"))),
    ]
    return got.select(*key, F.explode(flag_list(rules)).alias("violation"))
