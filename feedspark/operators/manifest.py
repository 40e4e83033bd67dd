"""Daily manifests and coverage of a time window, from poll journals.

A journal row is a request: received (seconds), success, parse_ok, raw_archived, raw_ok, spool_ok,
change_tracking_ok, presence_required, presence_ok, emitted_rows, selected_rows, parsed_rows,
poll_interval_seconds, raw_archive_interval_seconds, missed_deadlines_before_request,
processing_latency_ms, freshness_flags (array), run_id, corrupt. Columns that a journal does not
have count as null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedspark.operators.carry import with_previous
from feedspark.operators.coverage import data_poll_success, expected_polls, flag_list
from feedspark.operators.selection import order_statistics
from feedspark.storage import staged

#: The least valid cadence, seconds of a day, the factor beyond which an interval is a gap.
LEAST, DAY, FACTOR = 5.0, 86_400.0, 1.5
JOURNAL = {
    "received": "double", "success": "boolean", "parse_ok": "boolean", "raw_archived": "boolean", "raw_ok": "boolean", "spool_ok": "boolean", "change_tracking_ok": "boolean",
    "presence_required": "boolean", "presence_ok": "boolean", "emitted_rows": "bigint", "selected_rows": "bigint", "parsed_rows": "bigint", "poll_interval_seconds": "double",
    "raw_archive_interval_seconds": "double", "missed_deadlines_before_request": "bigint", "processing_latency_ms": "double", "freshness_flags": "array<string>", "run_id": "string", "corrupt": "boolean",
}


def journal_columns(journal: DataFrame) -> DataFrame:
    """The journal with all columns that it may have, those it lacks null."""
    return journal.withColumns({c: F.lit(None).cast(kind) for c, kind in JOURNAL.items() if c not in journal.columns})


def _yes(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(False))


def _data() -> Column:
    return data_poll_success(F.col("success"), F.col("parse_ok"), [F.col("raw_ok"), F.col("spool_ok"), F.col("change_tracking_ok")], F.col("presence_required"), F.col("presence_ok"))


def _flagged(warning: bool) -> Column:
    return F.exists(F.coalesce("freshness_flags", F.array().cast("array<string>")), lambda f: f.endswith("_warning") == F.lit(warning))


def gap_columns(times: Column, cadence: Column, start: Column, end: Column, samples: int = 20) -> dict[str, Column]:
    """Measures of sorted times inside [start, end): gaps, the longest interval, the edges (all of it without any time), first gaps."""
    n = F.size(times)
    steps = F.when(n > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), n - 1)), lambda i: F.struct(F.get(times, i - 1).alias("previous"), F.get(times, i).alias("next"), (F.get(times, i) - F.get(times, i - 1)).alias("seconds"))))
    long = F.coalesce(F.filter(steps, lambda s: s["seconds"] > cadence * FACTOR), F.array().cast("array<struct<previous:double,next:double,seconds:double>>"))
    return {
        "n_gaps": F.size(long).cast("long"), "max_gap": F.array_max(F.transform(steps, lambda s: s["seconds"])),
        "start_without_success": F.when(n > 0, F.get(times, F.lit(0)) - start).otherwise(end - start),
        "end_without_success": F.when(n > 0, end - F.get(times, n - 1)).otherwise(end - start), "gap_samples": F.slice(long, 1, samples),
    }


def feed_days(journal: DataFrame, feed: str, date: str, defaults: Column) -> DataFrame:
    """Statistics of each feed and day, in one aggregate (a feed's day has a bounded number of polls).

    Corrupt lines are counted and otherwise left out. The cadence is the upper median of the
    valid intervals that the polls state, else ``defaults`` (over the feed column)."""
    rows = journal_columns(journal).withColumns({"_d": ~_yes("corrupt"), "_start": F.unix_timestamp(F.col(date).cast("timestamp")).cast("double")})
    fine = F.col("_d")
    ok, parsed, data = fine & _yes("success"), fine & _yes("success") & _yes("parse_ok"), fine & _data()
    raw = ok & _yes("raw_archived")
    inside = (F.col("received") >= F.col("_start")) & (F.col("received") < F.col("_start") + DAY)
    interval = F.when(fine & ~F.isnan("poll_interval_seconds") & (F.col("poll_interval_seconds") >= LEAST) & (F.col("poll_interval_seconds") < float("inf")), F.col("poll_interval_seconds"))
    total = lambda cond, c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    got = rows.groupBy(feed, date, "_start").agg(
        F.count_if(fine).alias("attempted_polls"), F.count_if(ok).alias("successful_http_polls"), F.count_if(parsed).alias("successful_parse_polls"), F.count_if(data).alias("successful_data_polls"),
        F.count_if(raw).alias("journal_raw_snapshots"), F.count_if(ok & _yes("raw_archived") & F.coalesce("raw_ok", F.lit(True)) & ~_data()).alias("failed_processing_polls_with_raw_evidence"),
        total(parsed, "parsed_rows").alias("parsed_rows_seen"), F.coalesce(F.sum(F.when(parsed, F.coalesce("selected_rows", "emitted_rows"))), F.lit(0)).alias("event_rows_selected"), total(parsed, "emitted_rows").alias("event_rows_emitted"),
        F.count_if(ok & _flagged(False)).alias("stale_feed_polls"), F.count_if(ok & _flagged(True)).alias("freshness_warning_polls"), F.count_if(~fine).alias("corrupt_journal_lines"),
        total(fine, "missed_deadlines_before_request").alias("scheduler_missed_deadlines"), F.array_sort(F.collect_set(F.when(fine, F.col("run_id")))).alias("collector_run_ids"),
        F.min(F.when(ok, F.col("received"))).alias("first_success"), F.max(F.when(ok, F.col("received"))).alias("last_success"),
        F.min_by("raw_archive_interval_seconds", F.when(ok & F.col("raw_archive_interval_seconds").isNotNull(), F.col("received"))).alias("_raw_interval"),
        F.array_sort(F.collect_list(interval)).alias("_intervals"), F.array_sort(F.collect_list(F.when(data & inside, F.col("received")))).alias("_times"),
    )
    median = F.get("_intervals", F.floor(F.size("_intervals") / 2).cast("int"))
    got = got.withColumn("cadence", F.coalesce(median, defaults.cast("double"))).withColumn("n_cadences", F.size(F.array_distinct("_intervals")))
    got = got.withColumns({"expected_polls": expected_polls(F.col("cadence")), **gap_columns(F.col("_times"), F.col("cadence"), F.col("_start"), F.col("_start") + DAY)})
    raw_interval = F.coalesce("_raw_interval", "cadence")
    return got.withColumns({
        "failed_http_polls": F.col("attempted_polls") - F.col("successful_http_polls"), "parse_failures": F.col("successful_http_polls") - F.col("successful_parse_polls"),
        "poll_count_shortfall": F.greatest(F.lit(0), F.col("expected_polls") - F.col("attempted_polls")),
        "poll_ratio": F.col("attempted_polls") / F.col("expected_polls"), "data_ratio": F.col("successful_data_polls") / F.col("expected_polls"),
        "expected_raw_snapshots": expected_polls(F.when(raw_interval <= 0, F.col("cadence")).otherwise(F.greatest("cadence", raw_interval))),
    }).drop("_start", "_intervals", "_times", "_raw_interval")


def daily_manifest(days: DataFrame, feed: str, date: str, files: DataFrame, feeds: list[str]) -> DataFrame:
    """``feed_days`` with what the files of the day hold, errors, flags, and whether the day is complete and of good quality.

    ``files``: feed, date, raw_snapshots, raw_log_clean (null: no raw log), parquet_files,
    parquet_rows, pending_spool_segments, recovered_journal_tail_files. Every date of either
    table has a row for each of ``feeds``: a feed without a journal is an error, not a gap."""
    dates = days.select(date).union(files.select(date)).distinct().withColumn(feed, F.explode(F.array(*map(F.lit, feeds))))
    got = dates.join(days.withColumn("_journal", F.lit(True)), [date, feed], "left").join(files, [date, feed], "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    raw = (n("raw_snapshots") > 0) | F.coalesce("raw_log_clean", F.lit(False))
    errors = [
        ("missing_poll_journal", F.col("_journal").isNull()), ("no_poll_attempts", n("attempted_polls") == 0), ("no_successful_responses", n("successful_http_polls") == 0),
        ("no_parsed_responses", (n("successful_http_polls") > 0) & (n("successful_parse_polls") == 0)), ("no_archived_snapshots", n("journal_raw_snapshots") == 0), ("corrupt_journal_lines", n("corrupt_journal_lines") > 0),
        ("raw_log_missing", F.col("raw_log_clean").isNull()), ("raw_log_not_clean", ~F.col("raw_log_clean")), ("raw_records_below_journal", raw & (n("raw_snapshots") < n("journal_raw_snapshots"))),
        ("no_parquet_artifact", n("parquet_files") == 0), ("parquet_rows_below_journal", (n("parquet_files") > 0) & (n("parquet_rows") < n("event_rows_emitted"))), ("pending_spool_segments", n("pending_spool_segments") > 0),
    ]
    flags = [
        ("polls_missing", n("attempted_polls") < n("expected_polls") - 1), ("scheduler_missed_deadlines", n("scheduler_missed_deadlines") > 0), ("cadence_changed", n("n_cadences") > 1),
        ("recovered_journal_tail", n("recovered_journal_tail_files") > 0), ("failed_polls", n("failed_http_polls") > 0), ("parse_failures", n("parse_failures") > 0),
        ("processing_failures", n("successful_data_polls") < n("successful_parse_polls")), ("freshness_incidents", n("stale_feed_polls") > 0), ("raw_snapshots_missing", n("raw_snapshots") < n("expected_raw_snapshots") * 0.9),
    ]
    out = got.withColumns({"errors": flag_list(errors), "flags": flag_list(flags)}).drop("_journal")
    return out.withColumns({"complete": F.size("errors") == 0, "quality_ok": F.size("flags") == 0})


def as_json(rows: DataFrame, by: list[str]) -> DataFrame:
    """One JSON document for each row beside its ``by`` columns: fields in sorted order, nulls included."""
    fields = sorted(rows.columns)
    return rows.select(*by, F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("document"))


def window_coverage(journal: DataFrame, feed: str, since: float, until: float, defaults: Column, bucket: str | None = None) -> DataFrame:
    """Each feed's coverage of [since, until) seconds: counts, cadences, expected polls and ratio, gaps, edges, processing time.

    With several cadences nothing is expected. ``bucket``: a date column, to prune partitions.
    p95 is the value at index int((n - 1) * 0.95). Intervals are measured inside a day, which
    hands on its last poll, and p95 is selected by counts: no task holds a feed's window. The
    times are written to shared storage, as several passes read them."""
    rows = journal_columns(journal)
    if bucket:
        day = lambda t: F.to_date(F.timestamp_seconds(F.lit(t)))
        rows = rows.filter((F.col(bucket) >= day(since)) & (F.col(bucket) <= day(until)))
    fine = ~_yes("corrupt")
    inside = fine & (F.col("received") >= since) & (F.col("received") < until)
    ok, parsed, data = inside & _yes("success"), inside & _yes("success") & _yes("parse_ok"), inside & _data()
    got = rows.groupBy(feed).agg(
        F.count_if(inside).alias("journalled_polls"), F.count_if(data).alias("successful_data_polls"), F.count_if(inside & ~_yes("success")).alias("http_failures"), F.count_if(ok & ~_yes("parse_ok")).alias("parse_failures"),
        F.count_if(parsed & ~_data()).alias("processing_failures"), F.coalesce(F.sum(F.when(inside, F.col("missed_deadlines_before_request"))), F.lit(0)).alias("missed_deadlines"), F.count_if(inside & _yes("raw_archived")).alias("raw_snapshots"),
        F.count_if(inside & _yes("presence_ok")).alias("presence_confirmed_polls"), F.coalesce(F.sum(F.when(inside, F.col("emitted_rows"))), F.lit(0)).alias("emitted_rows"),
        F.count_if(inside & ~_data() & _yes("raw_archived") & F.coalesce("raw_ok", F.lit(True))).alias("failed_processing_polls_with_raw_evidence"),
        F.count_if(inside & _flagged(False)).alias("freshness_incident_polls"), F.count_if(inside & _flagged(True)).alias("freshness_warning_polls"), F.count_if(~fine).alias("corrupt_lines"),
        F.array_sort(F.collect_set(F.when(inside, F.col("poll_interval_seconds")))).alias("cadences"), F.array_sort(F.collect_set(F.when(inside, F.col("run_id")))).alias("run_ids"),
        F.min(F.when(data, F.col("received"))).alias("_first"), F.max(F.when(data, F.col("received"))).alias("_last"), F.max(F.when(inside, F.col("processing_latency_ms"))).alias("processing_max"),
    )
    one = F.size("cadences") <= 1
    cadence = F.when(F.size("cadences") == 1, F.get("cadences", F.lit(0))).otherwise(defaults.cast("double"))
    got = staged(got.withColumns({"_cadence": cadence, "expected_polls": F.when(one, (until - since) / cadence)}))
    times = staged(rows.filter(inside).select(F.col(feed).alias("_feed"), data.alias("data"), "received", F.to_date(F.timestamp_seconds("received")).alias("_day"), "processing_latency_ms"))
    steps = with_previous(times.filter("data"), ["_feed"], "_day", ["received"], F.col("received"), "_before").select("_feed", (F.col("received") - F.col("_before.v")).alias("_step"))
    known = got.select(F.col(feed).alias("_f"), "_cadence")
    gaps = steps.join(known, F.col("_feed").eqNullSafe(F.col("_f"))).groupBy("_feed").agg(F.count_if(F.col("_step") > F.col("_cadence") * FACTOR).alias("n_gaps"), F.max("_step").alias("max_gap"))
    p95 = order_statistics(times, ["_feed"], "processing_latency_ms", lambda n: F.floor((n - 1) * 0.95), "processing_p95", staged).select(F.col("_feed").alias("_f"), "processing_p95")
    out = got.join(gaps, F.col(feed).eqNullSafe(F.col("_feed")), "left").drop("_feed").join(p95, F.col(feed).eqNullSafe(F.col("_f")), "left").drop("_f")
    whole = F.lit(float(until) - float(since))
    return out.withColumns({
        "data_ratio": F.col("successful_data_polls") / F.col("expected_polls"), "n_gaps": F.coalesce("n_gaps", F.lit(0)),
        "start_without_success": F.coalesce(F.col("_first") - since, whole), "end_without_success": F.coalesce(F.lit(until) - F.col("_last"), whole),
    }).drop("_first", "_last", "_cadence")


def observed_days(days: DataFrame, feed: str, date: str, derived: DataFrame) -> DataFrame:
    """The authority on empty partitions: (feed, date, state): 'rows', 'observed_empty' (polled and parsed, no rows) or 'missing'.

    A partition without rows leaves no file behind; this table tells it from a day never seen."""
    have = derived.groupBy(feed, date).agg(F.count(F.lit(1)).alias("n_rows"))
    got = days.select(feed, date, "successful_parse_polls", "event_rows_emitted").join(have, [feed, date], "full_outer")
    state = F.when(F.col("n_rows") > 0, "rows").when((F.col("successful_parse_polls") > 0) & (F.col("event_rows_emitted") == 0), "observed_empty").otherwise("missing")
    return got.select(feed, date, state.alias("state"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
