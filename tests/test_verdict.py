import datetime as dt
import json

from feedspark.operators import manifest, verdict, versions

D = dt.date


def test_presence_runs_and_documents(spark):
    statistics = spark.createDataFrame([(D(2024, 1, 2), 10, 3, 2), (D(2024, 1, 3), 5, 0, 0)], "date date, expected long, unavailable long, legacy long")
    logs = spark.createDataFrame([(D(2024, 1, 2), "sequence_gap", 7), (D(2024, 1, 3), None, None)], "date date, rule string, at long")
    unmet = spark.createDataFrame([(D(2024, 1, 2), "p"), (D(2024, 1, 2), "q"), (D(2024, 1, 5), "r")], "date date, poll_id string")
    tails = spark.createDataFrame([(D(2024, 1, 3),)], "date date")
    presence = verdict.presence_evidence(statistics, logs, unmet, "date", tails)
    got = {(r.date.day, r.kind, r.rule, r.detail) for r in presence.collect()}
    assert got == {(2, "error", "log_fault", "sequence_gap at 7"), (2, "error", "promised_evidence_missing", "2"), (2, "flag", "unconfirmed_polls", "3"), (2, "flag", "mixed_versions", "2"), (3, "flag", "recovered_tail", None), (5, "error", "promised_evidence_missing", "1")}
    known, lost = "a" * 32, "b" * 32
    runs = spark.createDataFrame([(D(2024, 1, 2), x) for x in (known, lost, lost, "bad", None)], "date date, run_id string")
    evidence = presence.unionByName(verdict.run_evidence(runs, spark.createDataFrame([(known,)], "run_id string"), "date", "run_id"))
    feeds = spark.createDataFrame([(D(2024, 1, 2), "b", ["x", "y"], [], 4), (D(2024, 1, 2), "a", ["z"], ["w"], None), (D(2024, 1, 4), "a", [], [], 1)], "date date, feed string, errors array<string>, flags array<string>, polls long")
    evidence = evidence.unionByName(verdict.feed_evidence(feeds, "feed", "date"))
    days = spark.createDataFrame([(D(2024, 1, d),) for d in (2, 3, 4)], "date date")
    got = {r.date.day: r for r in verdict.day_verdicts(days, evidence, "date", ["b", "a"]).collect()}
    assert [(e.source, e.rule, e.detail) for e in got[2].errors] == [
        ("b", "x", None), ("b", "y", None), ("a", "z", None), ("presence", "log_fault", "sequence_gap at 7"), ("presence", "promised_evidence_missing", "2"), ("runs", "invalid_run_id", "bad"), ("runs", "missing_run_record", lost),
    ]
    assert [(f.source, f.rule) for f in got[2].flags] == [("a", "w"), ("presence", "unconfirmed_polls"), ("presence", "mixed_versions")]
    assert (got[3].complete, got[3].quality_ok, got[4].complete, got[4].quality_ok) == (True, False, True, True)
    documents = {r.date.day: json.loads(r.document) for r in verdict.day_documents(verdict.day_verdicts(days, evidence, "date", ["b", "a"]), feeds.drop("errors", "flags"), "feed", "date").collect()}
    assert documents[2]["feeds"] == [{"feed": "a", "polls": None}, {"feed": "b", "polls": 4}] and list(documents[2]) == sorted(documents[2])
    assert documents[3]["feeds"] is None and documents[4]["complete"] is True and documents[2]["errors"][0] == {"source": "b", "rule": "x", "detail": None}


def test_static_days(spark):
    at = lambda d, h: dt.datetime(2024, 1, d, h)
    history = spark.createDataFrame([(at(3, 12), 1, "s1", "p1", verdict.LEGACY_SOURCE), (at(5, 0), 2, "s2", "p2", "daily"), (at(6, 9), 3, "s3", "p3", "daily")], "checked_at timestamp, n int, sha256 string, version_path string, source string")
    archives = spark.createDataFrame([("p1", "s1"), ("p2", "other")], "path string, sha256 string")
    days = spark.createDataFrame([(D(2024, 1, d),) for d in (2, 3, 4, 5, 6)], "date date")
    got = {(r.date.day, r.kind, r.rule) for r in verdict.static_evidence(days, history, archives, "date", "checked_at", ["n"]).collect()}
    assert got == {(2, "error", "no_version"), (2, "flag", "no_version_seen"), (3, "flag", "start_not_covered"), (3, "flag", verdict.LEGACY), (4, "flag", verdict.LEGACY), (5, "error", "archive_digest"), (6, "error", "archive_missing")}


def test_static_join_report_as_one_document(spark):
    rows = [("d", "v1", 9, True, True, "bus", "1")] + [("d", "v1", 1, False, False, versions.UNMATCHED, None), ("d", "v2", 2, True, False, "tram", "2"), ("d", None, 3, False, False, versions.UNMATCHED, "7")]
    matches = spark.createDataFrame(rows, "date string, version string, n long, trip_matched boolean, exact boolean, mode string, route string")
    usage = spark.createDataFrame([("d", "v1", "collector_observed"), ("d", "v1", "legacy_schedule_uncertain"), ("d", "v2", "collector_observed"), ("d", None, None)], "date string, version string, confidence string")
    document = manifest.as_json(versions.static_join_report(matches, usage, ["date"], "version", "route", "confidence"), ["date"]).first().document
    got = json.loads(document)
    assert (got["snapshots"], got["unresolved"], got["updates"], got["trip_matches"], got["exact_matches"]) == (4, 3, 15, 11, 9)
    assert [(v["version"], v["confidence"], v["snapshots"]) for v in got["versions"]] == [("v1", "mixed", 2), ("v2", "collector_observed", 1)]
    assert [m["mode"] for m in got["modes"]] == ["bus", versions.UNMATCHED, "tram"] and got["unmatched_routes"] == [{"route": "(missing_route_id)", "n": 1}]
    assert got["warnings"] == ["unresolved_updates", "legacy_schedule_uncertain", "low_trip_rate", "low_exact_rate", "low_exact_rate:tram"] and list(got) == sorted(got)
