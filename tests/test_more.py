"""Exact values, carried histories, retention, archives, alignment, the exactly-once sink."""

import datetime as dt
import io
import zipfile

from pyspark.sql import functions as F

from feedspark.operators import archive, manifest, public, versions
from feedspark.operators.compression import CompressionPolicy, compress
from feedspark.sources import partitions


def test_compression_keeps_values_exactly(spark):
    big = 2**53
    rows = [(1, big, 0.0, float("nan"), None), (2, big + 1, 1.0, None, big + 1), (3, big + 1, 2.0, float("nan"), big + 1), (4, None, 3.0, None, None), (5, big, 4.0, float("nan"), None)]
    df = spark.createDataFrame(rows, "id long, key long, t double, v double, n long")
    got = compress(df, CompressionPolicy(("key",), ("n",), {"v": 1.0}), "t", ["t"]).collect()
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, (r for r in rows if r[0] != 5)))


def test_retention_lists_every_reason(spark):
    day, sha = dt.date(2026, 1, 1), "a" * 64
    days = spark.createDataFrame([(day, 2, "me", True, sha, True, False), (dt.date(2026, 1, 9), 2, "me", False, sha, True, True)], "date date, version int, repo_id string, remote_verified boolean, manifest_sha256 string, manifest_complete boolean, pending_work boolean")
    schema = "date date, kind string, feed string, path string, size long, sha256 string"
    files = [(day, "raw", f, f"raw/{f}", 5, sha) for f in "ab"] + [(day, "manifest", None, "m", 1, sha), (day, "parquet", "a", "parquet/a", 3, sha)]
    receipts = spark.createDataFrame(files, schema)
    local = spark.createDataFrame([*files[:2], (day, "parquet", "a", "parquet/a", 4, sha), (day, "parquet", "b", "parquet/b", 1, sha)], schema)
    got = {(r.kind, r.date): r for r in archive.retention(days, receipts, local, F.lit(dt.date(2026, 1, 10)), "me", ["a", "b"]).collect()}
    assert got["raw", day].eligible and got["raw", day].reasons == []
    assert got["parquet", day].reasons == ["feeds_missing", "files_not_in_receipt", "files_changed"]
    late = got["raw", dt.date(2026, 1, 9)].reasons
    assert {"too_recent", "nothing_local", "receipt_not_verified", "receipt_artifacts_invalid", "pending_work"} <= set(late)


def test_archives_are_validated(spark, tmp_path):
    def make(name, members):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for m, text in members.items():
                z.writestr(m, text)

    full = {m: "x\n" for m in partitions.REQUIRED_MEMBERS}
    make("good.zip", full | {"feed_info.txt": "﻿feed_version,x\nv7,1\n"})
    make("less.zip", {k: v for k, v in full.items() if k != "trips.txt"})
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    got = {r.path.rsplit("/", 1)[-1]: r for r in partitions.validate_archives(spark, str(tmp_path)).collect()}
    assert (got["good.zip"].missing, got["good.zip"].corrupt, got["good.zip"].feed_version, got["good.zip"].file_count) == ([], None, "v7", 6)
    assert got["less.zip"].missing == ["trips.txt"] and got["bad.zip"].corrupt == "BadZipFile"
    assert partitions.archive_state(io.BytesIO(b"").getvalue())[2] == "BadZipFile"


def test_alignment_history_and_sink(spark, tmp_path):
    df = spark.createDataFrame([("7", "x", 1)], "a string, b string, extra int")
    got = partitions.align(df, "a long, b long, c double")
    assert got.dtypes == [("a", "bigint"), ("b", "bigint"), ("c", "double")] and tuple(got.first()) == (7, None, None)
    (tmp_path / "h.jsonl").write_text('{"checked_at": "2026-01-01T00:00:00+00:00", "sha256": "a"}\n{"checked_at": "2026-01-01", "sha256": "b"}\n{"sha256": "c"}\n')
    assert [r.sha256 for r in partitions.read_history(spark, str(tmp_path / "h.jsonl")).collect()] == ["a"]
    spark.range(6).select(F.col("id"), F.lit("2026-01-01").alias("date")).write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema("id long, date string").parquet(str(tmp_path / "in"))
    for _ in range(2):  # without a checkpoint of its own, the batch is run again: it replaces its folder
        partitions.write_each_poll_once(live, str(tmp_path / "out"), str(tmp_path / f"c{_}")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in partitions.read_each_poll_once(spark, str(tmp_path / "out"), "id long, date string").collect()) == list(range(6))
    documents = manifest.as_json(spark.createDataFrame([(2, None, "x")], "b int, a string, k string"), ["k"])
    partitions.write_documents(documents, str(tmp_path / "doc"))
    assert spark.read.text(str(tmp_path / "doc")).first()[0] == '{"a":null,"b":2,"k":"x"}'


def test_gap_edges_of_a_day_and_one_missing_poll(spark):
    start = 1_767_225_600.0
    rows = [("a", dt.date(2026, 1, 1), start + 10 * i, True, True, 10.0) for i in range(8640) if i != 4000] + [("b", dt.date(2026, 1, 1), start + 5, False, False, None)]
    journal = spark.createDataFrame(rows, "feed string, date date, received double, success boolean, parse_ok boolean, poll_interval_seconds double")
    got = {r.feed: r for r in manifest.feed_days(journal, "feed", "date", F.lit(30)).collect()}
    a, b = got["a"], got["b"]
    assert (a.expected_polls, a.attempted_polls, a.n_gaps, a.max_gap, a.start_without_success, a.end_without_success, a.poll_count_shortfall) == (8640, 8639, 1, 20.0, 0.0, 10.0, 1)
    assert (b.cadence, b.expected_polls, b.start_without_success, b.end_without_success, b.max_gap) == (30.0, 2880, 86_400.0, 86_400.0, None)


def test_timeline_is_clipped_and_choices(spark):
    at = lambda d, h=0: dt.datetime(2026, 1, d, h)
    history = spark.createDataFrame([(at(1), 1, "x"), (at(2), 2, "x"), (at(4), 3, "y"), (at(4), 4, "z"), (at(6), 5, "x"), (None, 6, "q")], "checked timestamp, n int, v string")
    got = versions.timeline(history, "checked", ["n"], ["v"], F.lit(at(2, 12)).cast("timestamp"), F.lit(at(5)).cast("timestamp")).orderBy("valid_from").collect()
    assert [(r.v, r.valid_from, r.valid_to) for r in got] == [("x", at(2, 12), at(4)), ("y", at(4), at(5))]
    assert archive.newest(history.select("n"), 2, "n").collect()[0].n == 6
    rows = spark.createDataFrame([(h, at(1, h)) for h in range(24)], "h int, t timestamp")
    assert sorted(r.h for r in public.in_hours(rows, F.col("t"), 22, 24).collect()) == [22, 23]
