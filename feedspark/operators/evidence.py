"""Evidence about polls and archives: source timestamps, journals, manifests, provenance, versions of archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedspark.operators.coverage import flag_list

RUN_ID = "^[0-9a-f]{32}$"
#: The counts that a feed of a complete day needs at least once, and those that must be zero.
AT_LEAST_ONE = ("successful_http_polls", "successful_parse_polls", "raw_snapshots", "parquet_files")
ZERO = ("pending_spool_segments",)
#: Extension columns that are probed in each feed.
_VEHICLE = ("bkk_vehicle_model", "bkk_deviated", "bkk_vehicle_type", "bkk_door_open", "bkk_stop_distance")
EXTENSION_FIELDS = {
    "vehiclepositions": _VEHICLE,
    "tripupdates": (*_VEHICLE, *(f"bkk_scheduled_{event}_{part}" for event in ("arrival", "departure") for part in ("delay", "time", "uncertainty", "scheduled_time"))),
    "alerts": ("bkk_start_text_json", "bkk_end_text_json", "bkk_modified_time", "bkk_route_details_json"),
}


def source_timestamp_updates(seen: DataFrame, grid: DataFrame, poll: str, trip: list[str], timestamp: str) -> DataFrame:
    """The sightings at which a trip's source timestamp is recorded: its first, one after an absence, or a changed value.

    ``seen``: one row for each poll and trip, of the grid's polls only. Null is a value."""
    rows = seen.select(poll, *trip, timestamp).join(grid.select(poll, "poll_no", "segment"), poll)
    w = Window.partitionBy(*trip, "segment").orderBy("poll_no")
    before = F.lag("poll_no").over(w)
    new = before.isNull() | (before != F.col("poll_no") - 1) | ~F.lag(timestamp).over(w).eqNullSafe(F.col(timestamp))
    return rows.withColumn("_new", new).filter("_new").drop("_new")


def source_timestamp_spans(updates: DataFrame, withdrawn: DataFrame, grid: DataFrame, poll: str, trip: list[str], timestamp: str) -> DataFrame:
    """Replay: (trip, segment, from_no, until_no exclusive, timestamp), one row for each recorded value.

    ``updates`` as above; ``withdrawn``: poll and trip of withdrawals. A value holds until the
    next one, the withdrawal, or the end of the segment; spans, not one row for each poll, so
    that the result grows with the changes."""
    gone = withdrawn.select(poll, *trip).join(grid.select(poll, "poll_no", "segment"), poll)
    gone = gone.select(*trip, "segment", "poll_no", F.lit(True).alias("_gone"), F.lit(None).cast(updates.schema[timestamp].dataType).alias(timestamp))
    both = updates.select(*trip, "segment", "poll_no", F.lit(False).alias("_gone"), timestamp).unionByName(gone)
    ends = grid.groupBy("segment").agg((F.max("poll_no") + 1).alias("_end"))
    w = Window.partitionBy(*trip, "segment").orderBy("poll_no")
    spans = both.withColumn("_next", F.lead("poll_no").over(w)).filter("not _gone").join(ends, "segment")
    return spans.select(*trip, "segment", F.col("poll_no").alias("from_no"), F.coalesce("_next", "_end").alias("until_no"), timestamp)


def reconcile_promises(promised: DataFrame, records: DataFrame, key: list[str], must_equal: list[str], if_promised: list[str] = []) -> DataFrame:
    """Promises without an equal record: (key, problem): missing, mismatched, or duplicate where the records repeat a key.

    ``must_equal``: columns that must agree, null with null; ``if_promised``: only where the promise has a value."""
    one = records.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(f"_{c}") for c in (*must_equal, *if_promised)])
    got = promised.select(*key, *must_equal, *if_promised).join(one, key, "left")
    same = F.lit(True)
    for c in must_equal:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    for c in if_promised:
        same = same & (F.col(c).isNull() | F.col(c).eqNullSafe(F.col(f"_{c}")))
    problem = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "duplicate").when(~same, "mismatched")
    return got.select(*key, problem.alias("problem")).filter("problem is not null")


def presence_statistics(journal: DataFrame, records: DataFrame, by: list[str], poll: str) -> DataFrame:
    """By day: expected, confirmed, records, baselines, legacy, source-timestamp observations, unavailable.

    ``journal``: presence_required, presence_ok, parse_ok; ``records``: kind, source_timestamps_version."""
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    a = journal.groupBy(*by).agg(
        F.count_if(yes("presence_required") & yes("parse_ok")).alias("expected"),
        F.count_distinct(F.when(yes("presence_required") & yes("presence_ok"), F.col(poll))).alias("confirmed"),
        F.count_if(yes("parse_ok") & ~yes("presence_required")).alias("legacy"),
    )
    b = records.groupBy(*by).agg(F.count(F.lit(1)).alias("records"), F.count_if(F.col("kind") == "baseline").alias("baselines"), F.count("source_timestamps_version").alias("source_timestamp_observations"))
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("expected", "confirmed", "legacy", "records", "baselines", "source_timestamp_observations")}
    return a.join(b, by, "full_outer").withColumns(filled).withColumn("unavailable", F.col("expected") - F.col("confirmed"))


def run_provenance(runs: DataFrame, known: DataFrame, run: str) -> DataFrame:
    """Run ids of journals with a malformed id or without a run record."""
    ids = runs.select(run).filter(F.col(run).isNotNull()).distinct()
    bad = ids.filter(~F.col(run).rlike(RUN_ID)).withColumn("problem", F.lit("invalid_run_id"))
    missing = ids.filter(F.col(run).rlike(RUN_ID)).join(known.select(run), run, "left_anti").withColumn("problem", F.lit("missing_run_record"))
    return bad.unionByName(missing)


def journal_tail(lines: DataFrame, file: str, number: str, corrupt: Column) -> DataFrame:
    """By file with damaged lines: torn_tail if only its last line is damaged, else interior_corruption; and how many."""
    bad = F.coalesce(corrupt, F.lit(False))
    got = lines.groupBy(file).agg(F.count_if(bad).alias("n_corrupt"), F.max_by(bad, number).alias("_last"))
    state = F.when((F.col("n_corrupt") == 1) & F.col("_last"), "torn_tail").otherwise("interior_corruption")
    return got.filter("n_corrupt > 0").select(file, "n_corrupt", state.alias("state"))


def population(rows: DataFrame, fields: list[str], by: list[str] | None = None) -> DataFrame:
    """How many rows carry each field: neither null nor an empty list."""
    return rows.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "[]")).alias(f"n_{c}") for c in fields])


def extension_probe(rows: DataFrame, feed: str, by: list[str] | None = None) -> DataFrame:
    """``population`` of the feed's extension columns; a column that the table lacks is never filled."""
    fields = [c for c in EXTENSION_FIELDS[feed]]
    return population(rows.withColumns({c: F.lit(None).cast("string") for c in fields if c not in rows.columns}), fields, by)


def entity_time_range(polls: DataFrame, entities: str, time: Column | None = None) -> DataFrame:
    """Adds the earliest and latest time of each poll's entities; ``time`` maps an entity ``e`` to seconds; zero and null do not count."""
    times = F.filter(F.transform(entities, time), lambda t: t.isNotNull() & (t > 0))
    return polls.withColumns({"entity_time_min": F.array_min(times), "entity_time_max": F.array_max(times)})


def manifest_violations(stats: DataFrame, artifacts: DataFrame, date: str, feed: str, path: str, feeds: list[str], required: dict[str, Column]) -> DataFrame:
    """(date, feed, rule) for each rule that a day's manifest breaks: a feed without its statistics, too few or pending counts,
    an unclean raw log, a required artifact that is not listed.

    ``required``: rule name to the path that a row of dates and feeds must have; an artifact path is matched by equality."""
    days = stats.select(date).distinct().select(date, F.explode(F.array(*map(F.lit, feeds))).alias(feed))
    got = days.join(stats.withColumn("_has", F.lit(True)), [date, feed], "left")
    rules = [("no_statistics", F.col("_has").isNull())]
    rules += [(f"no_{c}", F.col("_has") & (F.coalesce(c, F.lit(0)) < 1)) for c in AT_LEAST_ONE]
    rules += [(c, F.col("_has") & (F.coalesce(c, F.lit(0)) != 0)) for c in ZERO] + [("raw_log_not_clean", F.col("_has") & ~F.coalesce("raw_log_clean", F.lit(False)))]
    broken = got.select(date, feed, F.explode(flag_list(rules)).alias("rule"))
    wanted = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), p.alias(path)) for n, p in required.items()]))
    missing = days.select(date, feed, wanted.alias("_w")).select(date, feed, F.col("_w.rule").alias("rule"), F.col(f"_w.{path}").alias(path))
    return broken.unionByName(missing.join(artifacts.select(date, path), [date, path], "left_anti").select(date, feed, "rule"))


def representatives(artifacts: DataFrame, kind: str, path: str, size: str, suffixes: dict[str, str]) -> DataFrame:
    """The smallest artifact of each kind, ties by path; a kind with a suffix counts only paths that end with it."""
    allowed = F.lit(True)
    for k, suffix in suffixes.items():
        allowed = allowed & ((F.col(kind) != k) | F.col(path).endswith(suffix))
    least = F.min(F.struct(F.col(size).alias("size"), F.col(path).alias("path")))
    return artifacts.filter(allowed).groupBy(kind).agg(least.alias("_l")).select(kind, F.col("_l.path").alias(path), F.col("_l.size").alias(size))


def confirmed(receipts: DataFrame, date: str, repository: str) -> DataFrame:
    """Dates of receipts of version 2, verified remotely, of this repository, named by their date, with artifacts."""
    fine = (F.col("version") == 2) & F.col("remote_verified") & (F.col("repo_id") == repository) & (F.col(date).cast("string") == F.col("file_stem")) & (F.col("n_artifacts") > 0)
    return receipts.filter(fine).select(date).distinct()


def manifest_reusable(artifacts: DataFrame, inventory: DataFrame, by: list[str], path: str) -> DataFrame:
    """Whether every artifact still has its size and modification time."""
    now = inventory.select(path, F.col("size").alias("_s"), F.col("mtime").alias("_m"))
    same = F.coalesce((F.col("size") == F.col("_s")) & (F.col("mtime") == F.col("_m")), F.lit(False))
    return artifacts.join(now, path, "left").groupBy(*by).agg(F.count(F.lit(1)).alias("n_artifacts"), F.bool_and(same).alias("reusable"))


def backlog_state(pending: DataFrame, date: str, now: Column, hours: float = 48.0) -> DataFrame:
    """One row: pending dates, the oldest, and whether it is older than the limit."""
    got = pending.agg(F.count(F.lit(1)).alias("n_pending"), F.min(date).alias("oldest"))
    age = (F.unix_timestamp(now) - F.unix_timestamp(F.col("oldest").cast("timestamp"))) / 3600
    return got.withColumn("stale", F.coalesce(age > hours, F.lit(False)))


def new_versions(history: DataFrame, by: list[str], order: list[str], digest: str, path: str) -> DataFrame:
    """Each check with ``is_new`` (digest differs from the check before) and ``stored_as``, the path under which its content was stored first."""
    w = Window.partitionBy(*by).orderBy(*order)
    same = Window.partitionBy(*by, digest).orderBy(*order)
    return history.withColumns({"is_new": ~F.col(digest).eqNullSafe(F.lag(digest).over(w)), "stored_as": F.first(path).over(same)})


def recent_partitions(partitions: DataFrame, date: str, today: Column) -> DataFrame:
    """Today's partition, if there is one, and the latest earlier one; a scan joined to these prunes the others."""
    dates = partitions.select(date).distinct()
    earlier = dates.filter(F.col(date) < today).agg(F.max(date).alias(date)).filter(F.col(date).isNotNull())
    return dates.filter(F.col(date) == today).unionByName(earlier)


def completed_dates(today: Column, *parts: DataFrame, date: str = "date") -> DataFrame:
    """Distinct dates before today of any of the tables."""
    out = parts[0].select(date)
    for p in parts[1:]:
        out = out.union(p.select(date))
    return out.filter(F.col(date).isNotNull() & (F.col(date) < today)).distinct()


def publication_row(fields: list[str]) -> Column:
    """A JSON array of the fields in order, nulls included."""
    cell = lambda c: F.coalesce(F.regexp_extract(F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}), r'^\{"v":(.*)\}$', 1), F.lit("null"))
    return F.concat(F.lit("["), F.concat_ws(",", *[cell(c) for c in fields]), F.lit("]"))


def publication_columns(row: Column, schema: dict[str, str]) -> list[Column]:
    """The inverse: the array's cells as typed columns; a row that is no array of that length gives nulls."""
    cells = F.from_json(row, "array<string>")
    ok = F.size(cells) == len(schema)
    return [F.when(ok, F.get(cells, i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(schema.items())]
