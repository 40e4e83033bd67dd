"""The verdict on a day: what feeds, presence, runs and reference archives show, as long rows and as one document.

Evidence is a row (date, source, kind, rule, detail, place): ``kind`` is error or flag, ``place`` orders
the rows of a source. Any number of sources can be united; the day's verdict is an aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedspark.operators.evidence import RUN_ID
from feedspark.operators.versions import as_of, checks, day_end

#: Sources in the order of a day's lists, and the source of versions that were taken over from before.
SOURCES = ("presence", "static", "runs")
LEGACY_SOURCE, LEGACY = "legacy_archive_migration", "legacy_schedule_uncertain"
EVIDENCE = "date date, source string, kind string, rule string, detail string, place int"


def _rows(df: DataFrame, date: str, source: Column, errors: list[tuple[str, Column, Column]], flags: list[tuple[str, Column, Column]]) -> DataFrame:
    """A row for each rule that holds: (rule, condition, detail)."""
    every = [("error", *r) for r in errors] + [("flag", *r) for r in flags]
    made = F.array(*[F.when(cond, F.struct(F.lit(kind).alias("kind"), F.lit(rule).alias("rule"), detail.cast("string").alias("detail"), F.lit(i).alias("place"))) for i, (kind, rule, cond, detail) in enumerate(every)])
    return df.select(F.col(date).cast("date").alias("date"), source.alias("source"), F.explode(F.array_compact(made)).alias("e")).select("date", "source", "e.*")


def feed_evidence(manifest: DataFrame, feed: str, date: str) -> DataFrame:
    """The errors and flags of ``manifest.daily_manifest``, in their order."""
    def of(column: str, kind: str) -> DataFrame:
        return manifest.select(F.col(date).cast("date").alias("date"), F.col(feed).alias("source"), F.lit(kind).alias("kind"), F.posexplode(column).alias("place", "rule")).select("date", "source", "kind", "rule", F.lit(None).cast("string").alias("detail"), "place")

    return of("errors", "error").unionByName(of("flags", "flag"))


def presence_evidence(statistics: DataFrame, logs: DataFrame, broken_promises: DataFrame, date: str, recovered: DataFrame | None = None) -> DataFrame:
    """What presence logs lack: ``evidence.presence_statistics``, ``replay.log_errors``, dates and polls of unmet promises, dates of recovered tails."""
    unmet = broken_promises.groupBy(F.col(date).alias("_d")).agg(F.count(F.lit(1)).alias("_unmet"))
    tails = (recovered.select(F.col(date).alias("_r")).distinct() if recovered is not None else unmet.filter("1 = 0").select(F.col("_d").alias("_r"))).withColumn("_tail", F.lit(True))
    faults = logs.select(F.col(date).alias("_l"), "rule", "at")
    dates = statistics.select(date).unionByName(logs.select(date)).unionByName(broken_promises.select(date)).distinct()
    got = dates.join(statistics, date, "left").join(faults, F.col(date) == F.col("_l"), "left").join(unmet, F.col(date) == F.col("_d"), "left").join(tails, F.col(date) == F.col("_r"), "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0))
    return _rows(got, date, F.lit("presence"), [
        ("log_fault", F.col("rule").isNotNull(), F.concat_ws(" at ", "rule", "at")), ("promised_evidence_missing", F.col("_unmet").isNotNull(), F.col("_unmet")),
    ], [
        ("unconfirmed_polls", n("unavailable") > 0, F.col("unavailable")), ("recovered_tail", F.col("_tail").isNotNull(), F.lit(None)), ("mixed_versions", (n("expected") > 0) & (n("legacy") > 0), F.col("legacy")),
    ])


def run_evidence(runs: DataFrame, known: DataFrame, date: str, run: str) -> DataFrame:
    """Runs of a day whose id is malformed or that left no record; each id once a day."""
    ids = runs.select(date, run).filter(F.col(run).isNotNull()).distinct().join(known.select(F.col(run).alias("_known")).distinct(), F.col(run) == F.col("_known"), "left")
    wrong = ~F.col(run).rlike(RUN_ID)
    return _rows(ids, date, F.lit("runs"), [("invalid_run_id", wrong, F.col(run)), ("missing_run_record", ~wrong & F.col("_known").isNull(), F.col(run))], [])


def static_evidence(days: DataFrame, history: DataFrame, archives: DataFrame, date: str, checked: str, order: list[str], sha: str = "sha256", path: str = "version_path", source: str = "source") -> DataFrame:
    """What the reference data of each day lack: its version at the day's end and that version's archive, versions seen over the day.

    ``archives``: path and sha256 of the files that are there. Errors: no version, archive missing,
    another digest. Flags: no version over the day, none at its start, or one of uncertain age."""
    own = days.select(F.col(date).cast("date").alias("_date")).distinct()
    last = day_end(own, history, "_date", checked, order, [sha, path])
    held = archives.groupBy(F.col("path").alias(path)).agg(F.collect_set("sha256").alias("_held"))
    at_start = as_of(own.withColumn("_start", F.col("_date").cast("timestamp")), history, "_start", checked, order, [sha, source])
    at_start = at_start.select("_date", F.col(sha).isNotNull().alias("_covered"), (F.col(source) == LEGACY_SOURCE).alias("_old"))
    within = checks(history, checked, order).groupBy(F.col("_day").alias("_date")).agg(F.count(F.lit(1)).alias("_seen"), F.bool_or(F.col(source) == LEGACY_SOURCE).alias("_old_within"))
    got = last.join(held, path, "left").join(at_start, "_date", "left").join(within, "_date", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    known = F.col(sha).isNotNull()
    none = ~yes("_covered") & F.col("_seen").isNull()
    return _rows(got, "_date", F.lit("static"), [
        ("no_version", ~known, F.lit(None)), ("archive_missing", known & F.col("_held").isNull(), F.col(path)), ("archive_digest", known & F.col("_held").isNotNull() & ~F.array_contains("_held", F.col(sha)), F.col(path)),
    ], [("no_version_seen", none, F.lit(None)), ("start_not_covered", ~none & ~yes("_covered"), F.lit(None)), (LEGACY, yes("_old") | yes("_old_within"), F.lit(None))])


def day_verdicts(days: DataFrame, evidence: DataFrame, date: str, feeds: list[str]) -> DataFrame:
    """A row for each of ``days``: complete, quality_ok, errors and flags, ordered by source (``feeds``, then SOURCES, then others by name)."""
    sources = F.array(*map(F.lit, [*feeds, *SOURCES]))
    rank = F.array_position(sources, F.col("source"))
    placed = evidence.select("date", "kind", F.struct(F.when(rank > 0, rank).otherwise(F.lit(1 << 20)).alias("rank"), "source", "place", "rule", "detail").alias("e"))
    of = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("e")))), lambda e: F.struct(e["source"].alias("source"), e["rule"].alias("rule"), e["detail"].alias("detail")))
    lists = placed.groupBy("date").agg(of("error").alias("errors"), of("flag").alias("flags"))
    own = days.select(F.col(date).cast("date").alias("date")).distinct()
    none = F.array().cast("array<struct<source:string,rule:string,detail:string>>")
    got = own.join(lists, "date", "left").withColumns({c: F.coalesce(c, none) for c in ("errors", "flags")})
    return got.select("date", (F.size("errors") == 0).alias("complete"), (F.size("flags") == 0).alias("quality_ok"), "errors", "flags")


def day_documents(verdicts: DataFrame, manifest: DataFrame, feed: str, date: str) -> DataFrame:
    """(date, document): a day's verdict with the statistics of its feeds, one JSON object each, feeds and fields in sorted order."""
    fields = sorted(c for c in manifest.columns if c not in (feed, date))
    stats = manifest.groupBy(F.col(date).cast("date").alias("date")).agg(F.array_sort(F.collect_list(F.struct(F.col(feed).alias("feed"), *fields))).alias("feeds"))
    got = verdicts.join(stats, "date", "left")
    return got.select("date", F.to_json(F.struct(F.col("complete"), F.col("date"), F.col("errors"), F.col("feeds"), F.col("flags"), F.col("quality_ok")), {"ignoreNullFields": "false"}).alias("document"))
