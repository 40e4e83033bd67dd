"""Functions that only other code called: scalars, confirmations, probes, pruning, durable rows, polls delivered again, golden days."""

import datetime as dt

from pyspark.sql import functions as F

from feedspark.functions import scalars as fn
from feedspark.operators import archive, evidence, manifest
from feedspark.operators.compression import CompressionPolicy, compress
from feedspark.streaming.compression import compress_stream, once_per_poll

D = dt.date


def test_scalars(spark):
    df = spark.createDataFrame([(0.0, 0, "legacy_archive_migration"), (1704153600.9, -1, "x"), (None, 9_000_000_000_000_001, None)], "e double, n long, s string")
    got = df.select(fn.iso_seconds(F.col("e")), fn.bounded_count(F.col("n")), fn.source_confidence(F.col("s"))).collect()
    assert [tuple(r) for r in got] == [("1970-01-01T00:00:00Z", 0, "legacy_schedule_uncertain"), ("2024-01-02T00:00:00Z", None, "collector_observed"), (None, None, "collector_observed")]
    pairs = spark.createDataFrame([(None, None), (None, 1.0), (1.0, None), (1.0, 16.0), (1.0, 16.5), (1.0, 1.0)], "a double, b double")
    got = pairs.select(fn.beyond_tolerance(F.col("a"), F.col("b"), 15.0), fn.beyond_tolerance(F.col("a"), F.col("b"), 0)).collect()
    assert [tuple(r) for r in got] == [(False, False), (True, True), (True, True), (False, True), (True, True), (False, False)]


def test_confirmed_oldest_and_recent(spark):
    rows = [(D(2024, 1, 2), 2, True, "me", "2024-01-02", 3), (D(2024, 1, 3), 1, True, "me", "2024-01-03", 3), (D(2024, 1, 4), 2, True, "you", "2024-01-04", 3), (D(2024, 1, 5), 2, True, "me", "2024-01-06", 3), (D(2024, 1, 6), 2, True, "me", "2024-01-06", 0), (D(2024, 1, 7), 2, False, "me", "2024-01-07", 1)]
    receipts = spark.createDataFrame(rows, "date date, version int, remote_verified boolean, repo_id string, file_stem string, n_artifacts int")
    assert [r.date for r in evidence.confirmed(receipts, "date", "me").collect()] == [D(2024, 1, 2)]
    days = receipts.select("date")
    assert [r.date for r in archive.oldest(days, 2).collect()] == [D(2024, 1, 2), D(2024, 1, 3)]
    assert sorted(r.date for r in evidence.recent_partitions(days, "date", F.lit("2024-01-06").cast("date")).collect()) == [D(2024, 1, 5), D(2024, 1, 6)]
    assert evidence.recent_partitions(days, "date", F.lit("2023-01-06").cast("date")).isEmpty()


def test_extension_probe(spark):
    rows = spark.createDataFrame([("a", "M", None, "[]"), ("a", None, True, '["x"]'), ("b", "", False, None)], "g string, bkk_vehicle_model string, bkk_deviated boolean, bkk_route_details_json string")
    got = {r.g: r for r in evidence.extension_probe(rows, "vehiclepositions", ["g"]).collect()}
    assert (got["a"].n_rows, got["a"].n_bkk_vehicle_model, got["a"].n_bkk_deviated, got["a"].n_bkk_door_open) == (2, 1, 1, 0)
    assert got["b"].n_bkk_vehicle_model == 1
    alerts = evidence.extension_probe(rows, "alerts").first()
    assert (alerts.n_rows, alerts.n_bkk_route_details_json, alerts.n_bkk_start_text_json) == (3, 1, 0)


def test_rows_that_are_not_durable_are_no_reference(spark):
    rows = [("k", 1.0, 5, True), ("k", 2.0, 6, False), ("k", 3.0, 6, True), ("k", 4.0, 6, None), ("k", 5.0, 5, True)]
    df = spark.createDataFrame(rows, "k string, t double, v int, ok boolean")
    assert [r.t for r in compress(df, CompressionPolicy(("k",), ("v",)), "t", ["t"], durable="ok").orderBy("t").collect()] == [1.0, 3.0, 5.0]


def run(spark, tmp_path, batches, schema, build, name):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    build(live).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name).collect()


def test_a_poll_delivered_again_is_dropped(spark, tmp_path):
    at = lambda m: dt.datetime(2024, 1, 2, 0, m)
    got = run(spark, tmp_path, [[("a", at(0), 1), ("b", at(1), 2)], [("a", at(0), 1), ("c", at(2), 3)]], "poll_id string, at timestamp, v int", lambda d: once_per_poll(d, ["poll_id"], "at"), "once")
    assert sorted(r.poll_id for r in got) == ["a", "b", "c"]


def test_compression_state_times_out_at_the_heartbeat(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 2) + dt.timedelta(seconds=s)
    row = lambda k, s, v: (k, at(s), float(s), "d", v)
    batches = [[row("a", 0, 1), row("b", 0, 1)], [row("b", 50, 1), row("b", 120, 2)], [row("c", 900, 1)], [row("a", 901, 1), row("b", 902, 2)]]
    policy = CompressionPolicy(("k",), ("v",), heartbeat=100)
    schema = "k string, at timestamp, t double, day string, v int"
    got = run(spark, tmp_path, batches, schema, lambda d: compress_stream(d.withWatermark("at", "1 second"), policy, "t", ["t"], "day", "at"), "beats")
    assert sorted((r.k, r.t) for r in got) == [("a", 0.0), ("a", 901.0), ("b", 0.0), ("b", 120.0), ("b", 902.0), ("c", 900.0)]


def test_empty_and_missing_days_differ(spark):
    days = spark.createDataFrame([("a", D(2024, 1, 2), 5, 0), ("a", D(2024, 1, 3), 0, 0), ("a", D(2024, 1, 4), 5, 7)], "feed string, date date, successful_parse_polls long, event_rows_emitted long")
    derived = spark.createDataFrame([("a", D(2024, 1, 4)), ("b", D(2024, 1, 5))], "feed string, date date")
    got = {(r.feed, r.date.day): (r.state, r.n_rows) for r in manifest.observed_days(days, "feed", "date", derived).collect()}
    assert got == {("a", 2): ("observed_empty", 0), ("a", 3): ("missing", 0), ("a", 4): ("rows", 1), ("b", 5): ("rows", 1)}


def test_window_coverage_of_two_feeds(spark):
    start = 1_704_153_600.0
    rows = [("a", start + 10 * i, True, True, 10.0, float(i)) for i in range(60) if i not in (20, 21)] + [("b", start + 30 * i, i != 3, True, 30.0 if i < 10 else 60.0, None) for i in range(20)] + [("a", start + 9000, True, True, 10.0, 1e9)]
    journal = spark.createDataFrame(rows, "feed string, received double, success boolean, parse_ok boolean, poll_interval_seconds double, processing_latency_ms double")
    got = {r.feed: r for r in manifest.window_coverage(journal, "feed", start, start + 600, F.lit(30)).collect()}
    a, b = got["a"], got["b"]
    assert (a.journalled_polls, a.expected_polls, a.n_gaps, a.max_gap, a.start_without_success, a.end_without_success) == (58, 60.0, 1, 30.0, 0.0, 10.0)
    assert (a.processing_p95, a.processing_max) == (56.0, 59.0)
    assert (b.expected_polls, b.data_ratio, b.http_failures, list(b.cadences), b.n_gaps, b.max_gap, b.processing_p95) == (None, None, 1, [30.0, 60.0], 1, 60.0, None)
