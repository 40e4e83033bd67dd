import datetime as dt

from pyspark.sql import functions as F

from feedspark.operators import selection, status, versions
from feedspark.storage import staged

D = dt.date


def test_collection_statistics(spark):
    rows = [
        (D(2024, 1, 2), "a", 10, 5, 3, 100.0, True, 12, 9), (D(2024, 1, 2), "b", None, 7, -1, 90.0, True, 12, None), (D(2024, 1, 3), "a", 4, 1, 1, 200.0, True, 12, 3), (D(2024, 1, 3), "b", 0, 2, 0, None, False, -5, 1),
        (D(2024, 1, 4), "a", 0, 50, 5, 1.0, True, 1, 0), (D(2024, 1, 9), "a", 70, 1, 1, 5.0, True, 1, 1),
    ]
    days = spark.createDataFrame(rows, "date date, feed string, attempted_polls long, parquet_rows long, raw_snapshots long, first_success double, quality_ok boolean, expected_polls long, successful_data_polls long")
    receipts = spark.createDataFrame([(D(2024, 1, 2), 2, True, D(2024, 1, 2)), (D(2024, 1, 3), 1, True, D(2024, 1, 3)), (D(2024, 1, 4), 2, True, D(2024, 1, 5)), (D(2024, 1, 9), 2, True, D(2024, 1, 9)), (None, 2, True, None)], "date date, version int, remote_verified boolean, file_date date")
    today = F.lit("2024-01-09").cast("date")
    r = status.collection_statistics(days, receipts, "date", "feed", today).first()
    assert (r.evidenced_since, r.evidenced_days, r.polls_recorded, r.event_rows, r.raw_snapshots, r.latest_date, r.latest_quality) == (90.0, 2, 14, 15, 4, D(2024, 1, 3), "flagged")
    assert (r.verified_days, r.last_verified_date) == (1, D(2024, 1, 2))
    assert {tuple(x) for x in status.latest_day_counts(days, "date", "feed", today).collect()} == {("a", 12, 4, 3), ("b", None, 0, 1)}
    r = status.collection_statistics(days.filter("1 = 0"), receipts.filter("1 = 0"), "date", "feed", today).first()
    assert (r.evidenced_days, r.polls_recorded, r.latest_date, r.verified_days) == (0, 0, None, 0)


def test_states(spark):
    ages = spark.createDataFrame([(None, True), (-31.0, True), (-30.0, True), (300.0, None), (301.0, True), (90.0, False), (91.0, True)], "age double, ok boolean")
    got = [tuple(r) for r in ages.select(status.maintenance_state(F.col("age"), F.col("ok")), status.viewed_state(F.lit("healthy"), F.col("age"))).collect()]
    assert got == [("unknown", "unknown"), ("unknown", "unknown"), ("healthy", "healthy"), ("degraded", "unknown"), ("unknown", "unknown"), ("degraded", "healthy"), ("healthy", "unknown")]


def test_maintenance(spark):
    at = dt.datetime(2024, 1, 10, 12)
    now = F.lit("2024-01-10 12:00:00").cast("timestamp")
    pending = lambda *d: spark.createDataFrame([(x,) for x in d], "date date")
    checks = lambda *c: spark.createDataFrame([(at - dt.timedelta(hours=h), ok) for h, ok in c], "checked_at timestamp, success boolean")
    legacy = spark.createDataFrame([(D(2020, 1, 1), True, False, True), (D(2020, 1, 2), False, None, None), (None, None, False, None)], "date date, handled boolean, confirmed boolean, complete boolean")
    none = legacy.filter("1 = 0")
    r = status.maintenance_report(pending(D(2024, 1, 9)), checks((47, True), (500, True), (1, False)), none, "date", now).first()
    assert (r.n_pending, r.oldest, list(r.reasons), list(r.warnings), r.healthy) == (1, D(2024, 1, 9), [], [], True)
    errors = spark.createDataFrame([("x",), ("a",), ("x",)], "error string")
    r = status.maintenance_report(pending(D(2024, 1, 8), D(2024, 1, 9)), checks((49, True)), legacy, "date", now, failed_compactions=errors).first()
    assert list(r.reasons) == ["static_gtfs_stale", "backup_backlog_stale", "compaction:a", "compaction:x"]
    assert list(r.warnings) == ["legacy_remote_copy_unconfirmed", "legacy_inventory_incomplete", "legacy_static_gtfs_remote_copy_unconfirmed"] and not r.healthy
    r = status.maintenance_report(pending(D(2023, 1, 8)), checks(), none, "date", now, enabled=False).first()
    assert (r.n_pending, list(r.reasons), list(r.warnings)) == (0, ["static_gtfs_stale"], ["offsite_backup_disabled"])
    r = status.maintenance_report(pending(), checks((150, True)), none, "date", now, check_interval=300_000.0).first()
    assert list(r.reasons) == []


def test_snapshot_counts(spark):
    vehicles = spark.createDataFrame([("a", i) for i in range(3)] + [("b", 1)], "snapshot string, v int")
    snapshots = spark.createDataFrame([("a", 5, 2), ("b", 5, 2), ("c", 0, 0), ("d", None, 0), ("e", -1, -1)], "snapshot string, records_in_source long, omitted_records long")
    got = {tuple(r) for r in status.snapshot_violations(snapshots, vehicles, ["snapshot"], 2).collect()}
    assert got == {("a", "too_many_vehicles"), ("b", "counts_do_not_add_up"), ("d", "records_in_source"), ("d", "counts_do_not_add_up"), ("e", "records_in_source"), ("e", "omitted_records")}


def test_poll_table(spark):
    a, b = spark.createDataFrame([("p", 1)], "poll_id string, x int"), spark.createDataFrame([("q", "z")], "poll_id string, y string")
    assert {tuple(r) for r in status.poll_table({"f": a, "g": b}).select("feed", "poll_id", "x", "y").collect()} == {("f", "p", 1, None), ("g", "q", None, "z")}


def test_selection_is_exact(spark):
    rows = [("a", float((i * 7919) % 1000) / 7) for i in range(3000)] + [("b", 5.0)] * 500 + [("c", 1e300 * (-1) ** i * i) for i in range(90)] + [(None, 2.0), ("d", None), ("e", float("nan")), ("e", 1.0), ("f", 1.0)] + [("g", 1.0 + i * 2.0**-52) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(4)
    for share in (0.0, 0.5, 0.95, 1.0):
        got = {r.k: (r.n, r.x) for r in selection.order_statistics(df, ["k"], "v", lambda n, s=share: F.floor((n - 1) * s), "x", staged, cells=8, at_most=10).collect()}
        want = {}
        for k in {k for k, _ in rows}:
            vs = sorted(v for q, v in rows if q == k and v is not None and v == v)
            if vs:
                want[k] = (len(vs), vs[int((len(vs) - 1) * share)])
        assert got == want


def test_a_day_of_observations_is_spread(spark):
    t0 = dt.datetime(2024, 1, 2)
    rows = [(i, t0 + dt.timedelta(seconds=(i * 37) % 86_400 if i % 3 else 40_000)) for i in range(6000)] + [(-1, None), (-2, t0 - dt.timedelta(days=9))]
    history = [(t0 - dt.timedelta(days=3), 0, "before")] + [(t0 + dt.timedelta(seconds=s), s, f"v{s}") for s in (10, 40_000, 80_000)] + [(t0 + dt.timedelta(seconds=10), 99_999, "later")]
    seen, checks = spark.createDataFrame(rows, "i int, t timestamp"), spark.createDataFrame(history, "c timestamp, line int, version string")
    got = versions.as_of(seen, checks, "t", "c", ["line"], ["version"], rows_of_a_task=200)

    def want(t):
        known = [v for c, n, v in sorted(history) if t and c <= t and n != 99_999]
        return known[-1] if known else None

    assert {r.i: r.version for r in got.collect()} == {i: want(t) for i, t in rows}
    sizes = [r.n for r in got.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r.n for r in got.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(sizes) < 2500
