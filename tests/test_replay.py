import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedspark.operators import replay

CHANGE = "struct<trip:array<string>,trip_entered:boolean,trip_withdrawn:boolean,entered_stops:array<array<string>>,withdrawn_stops:array<array<string>>>"
SCHEMA = (
    "date string, order long, poll_id string, stream_id string, sequence long, kind string, version int, trip_count long, stop_count long, "
    f"changes array<{CHANGE}>, source_timestamps_version int, source_timestamp_updates array<struct<trip:array<string>,timestamp:long>>"
)
A, B = ["a", None, "1", "x"], ["b", None, "1", "x"]
S1, S2, S3 = ["1", "s", None], ["2", "s", None], ["3", "s", None]


def change(trip, entered=(), withdrawn=(), enters=False, leaves=False):
    return trip, enters, leaves, list(entered), list(withdrawn)


def record(order, kind, sequence, trips, stops, changes, source=1, updates=(), stream="s1", version=1, poll=None, date="d"):
    return date, order, poll or f"p{order}", stream, sequence, kind, version, trips, stops, list(changes), source, [(t, v) for t, v in updates]


BASE = record(0, "baseline", 1, 2, 3, [change(A, [S1, S2], enters=True), change(B, [S1], enters=True)], updates=[(A, 5), (B, None)])
NEXT = record(1, "delta", 2, 1, 2, [change(A, [S3], [S1]), change(B, [], [S1], leaves=True)], updates=[(A, 6)])
EMPTY = record(2, "delta", 3, 1, 2, [])
CASES = {
    "fine": ([BASE, NEXT, EMPTY], None),
    "a baseline resets knowledge": ([BASE, record(1, "baseline", 1, 1, 0, [change(B, enters=True)], updates=[(B, 1)], stream="s2")], None),
    "a baseline begins at 1": ([record(0, "baseline", 2, 0, 0, [])], (0, "baseline_sequence")),
    "a log begins with a baseline": ([record(0, "delta", 2, 0, 0, [], source=None)], (0, "sequence_gap")),
    "sequence gap": ([BASE, record(1, "delta", 3, 2, 3, [])], (1, "sequence_gap")),
    "another stream": ([BASE, record(1, "delta", 2, 2, 3, [], stream="s2")], (1, "sequence_gap")),
    "kind": ([BASE, record(1, "other", 2, 2, 3, [])], (1, "unsupported_record")),
    "version": ([record(0, "baseline", 1, 0, 0, [], version=2)], (0, "unsupported_record")),
    "trip identity": ([record(0, "baseline", 1, 1, 0, [change(["a"], enters=True)], updates=[(["a"], 1)])], (0, "trip_identity")),
    "repeated trip": ([record(0, "baseline", 1, 1, 0, [change(A, enters=True), change(A, enters=True)], updates=[(A, 1)])], (0, "trip_identity")),
    "stop identity": ([record(0, "baseline", 1, 1, 1, [change(A, [["1"]], enters=True)], updates=[(A, 1)])], (0, "stop_identity")),
    "enters twice": ([BASE, record(1, "delta", 2, 2, 4, [change(A, [S3], enters=True)], updates=[(A, 6)])], (1, "trip_enters_twice")),
    "unknown trip": ([BASE, record(1, "delta", 2, 2, 3, [change(["z", None, "1", "x"], [S1])])], (1, "not_preceding_membership")),
    "stop entered already": ([BASE, record(1, "delta", 2, 2, 3, [change(A, [S1])])], (1, "not_preceding_membership")),
    "stop withdrawn that was absent": ([BASE, record(1, "delta", 2, 2, 2, [change(A, [], [S3])])], (1, "not_preceding_membership")),
    "stop in both lists": ([BASE, record(1, "delta", 2, 2, 3, [change(A, [S1], [S1])])], (1, "not_preceding_membership")),
    "keeps stops": ([BASE, record(1, "delta", 2, 1, 2, [change(A, [], [S1], leaves=True)])], (1, "withdrawn_trip_keeps_stops")),
    "trip count": ([BASE, record(1, "delta", 2, 3, 3, [])], (1, "membership_counts")),
    "stop count": ([BASE, NEXT, record(2, "delta", 3, 1, 1, [])], (2, "membership_counts")),
    "source version": ([record(0, "baseline", 1, 0, 0, [], source=2)], (0, "unsupported_source_timestamps")),
    "no source baseline": ([record(0, "baseline", 1, 0, 0, [], source=None), record(1, "delta", 2, 0, 0, [])], (1, "source_timestamps_without_baseline")),
    "older records have none": ([record(0, "baseline", 1, 1, 0, [change(A, enters=True)], source=None), record(1, "delta", 2, 1, 0, [], source=None)], None),
    "negative timestamp": ([BASE, record(1, "delta", 2, 2, 3, [], updates=[(A, -1)])], (1, "invalid_source_timestamp")),
    "timestamp of an absent trip": ([BASE, NEXT, record(2, "delta", 3, 1, 2, [], updates=[(B, 7)])], (2, "invalid_source_timestamp")),
    "repeated timestamp": ([BASE, record(1, "delta", 2, 2, 3, [], updates=[(A, 1), (A, 2)])], (1, "invalid_source_timestamp")),
    "no timestamp": ([record(0, "baseline", 1, 1, 0, [change(A, enters=True)])], (0, "source_timestamps_do_not_cover")),
    "repeated poll": ([BASE, record(1, "delta", 2, 2, 3, [], poll="p0")], (1, "duplicate_poll")),
    "the first fault counts": ([BASE, record(1, "delta", 2, 9, 3, []), record(2, "delta", 4, 2, 3, [], poll="p0")], (1, "membership_counts")),
}


def test_golden_faults(spark):
    rows = [(name, *r[1:]) for name, (records, _) in CASES.items() for r in records]
    log = spark.createDataFrame(rows, SCHEMA)
    found = replay.faults(log, ["date"])
    assert {r.date: (r.order, r.rule) for r in found.collect()} == {name: want for name, (_, want) in CASES.items() if want}
    errors = {r.date: (r.records, r.rule, r.at) for r in replay.log_errors(log, ["date"], found).collect()}
    for name, (records, want) in CASES.items():
        assert errors[name] == ((want[0], want[1], want[0]) if want else (len(records), None, None)), name
    left = replay.trusted(log, ["date"], found).groupBy("date").count().collect()
    assert {r.date: r["count"] for r in left} == {name: (want[0] if want else len(records)) for name, (records, want) in CASES.items() if not want or want[0]}


def test_a_later_segment_is_read_for_itself(spark):
    again = record(3, "baseline", 1, 0, 0, [], stream="s3")
    log = spark.createDataFrame([BASE, record(1, "delta", 2, 9, 9, []), record(2, "delta", 3, 2, 3, []), again, record(4, "delta", 3, 0, 0, [], stream="s3")], SCHEMA)
    found = replay.faults(log, ["date"])
    assert {(r.segment, r.order, r.rule, r.poll_id) for r in found.collect()} == {(1, 1, "membership_counts", "p1"), (2, 4, "sequence_gap", "p4")}
    assert sorted(r.order for r in replay.trusted(log, ["date"], found).collect()) == [0, 3]
    promised = spark.createDataFrame([("p0", 1), ("p3", 2), ("p9", 1), ("p1", None)], "poll_id string, presence_source_timestamps_version int")
    more = replay.faults(log, ["date"], promised=promised)
    assert {(r.segment, r.order, r.rule) for r in more.collect()} == {(1, 1, "membership_counts"), (2, 3, "promised_evidence")}
    assert replay.faults(log.filter("1 = 0"), ["date"]).isEmpty()


def fold(records):
    """Replay in order, stopping at the first fault."""
    members, at = {}, None
    for r in records:
        if r[5] == "baseline":
            members = {}
        for trip, enters, leaves, entered, withdrawn in r[9]:
            k, entered, withdrawn = json.dumps(trip), {json.dumps(s) for s in entered}, {json.dumps(s) for s in withdrawn}
            old = members.get(k)
            if enters:
                if old is not None:
                    return r[1]
                old = set()
            if old is None or entered & old or not withdrawn <= old:
                return r[1]
            new = (old - withdrawn) | entered
            if leaves and new:
                return r[1]
            members[k] = new
            if leaves:
                del members[k]
        if len(members) != r[7] or sum(map(len, members.values())) != r[8]:
            return r[1]
    return at


@pytest.mark.parametrize("seed", [1, 2])
def test_random_logs_equal_a_fold(spark, seed):
    r, rows, want = np.random.default_rng(seed), [], {}
    for log in range(40):
        state, records = {}, []
        for order in range(12):
            base = order == 0 or r.random() < 0.1
            before = {} if base else state
            state = {t: {s for s in range(3) if r.random() < 0.6} for t in range(4) if r.random() < 0.7}
            changes = []
            for t in sorted(before.keys() | state.keys()):
                old, new = before.get(t, set()), state.get(t, set())
                if old != new or (t in before) != (t in state):
                    changes.append(change([str(t), None, "", "y"], [[str(s), "", ""] for s in new - old], [[str(s), "", ""] for s in old - new], t not in before, t not in state))
            if changes and r.random() < 0.04:
                changes.pop()
            sequence = 1 if base else records[-1][4] + 1
            records.append(record(order, "baseline" if base else "delta", sequence, len(state), sum(map(len, state.values())), changes, source=None, date=f"{log:02}", poll=f"{log}-{order}", stream="s"))
        segments, at = [], -1
        for x in records:
            at += x[5] == "baseline"
            segments.append(at)
        for s in set(segments):
            got = fold([x for x, k in zip(records, segments, strict=True) if k == s])
            if got is not None:
                want[f"{log:02}", got] = True
        rows += records
    got = replay.faults(spark.createDataFrame(rows, SCHEMA), ["date"]).collect()
    assert want and {(x.date, x.order): True for x in got} == want


def test_interval_coverage(spark):
    schema = "trip string, part int, a long, b long"
    members = spark.createDataFrame([("t", 1, 0, 10), ("t", 1, 20, 30), (None, 1, 0, 5), ("u", 1, 0, 5), ("u", 1, 3, 8), ("v", 1, 5, 5), ("w", 1, 0, 4)], schema)
    spans = spark.createDataFrame([("t", 1, 0, 4), ("t", 1, 4, 10), ("t", 1, 22, 33), ("t", 1, 25, 26), ("u", 1, 0, 8), ("x", 1, 1, 2), ("w", 1, None, 4)], schema)
    got = {(r.trip, r.reason, r.a, r.b) for r in replay.coverage(members, spans, ["trip", "part"], "a", "b").collect()}
    assert got == {("t", "uncovered", 20, 22), ("t", "unowned", 30, 33), ("t", "ambiguous", 25, 26), (None, "uncovered", 0, 5), ("u", "repeated_member", 3, 5), ("x", "unowned", 1, 2), ("w", "uncovered", 0, 4)}
    assert replay.coverage(members.filter("1 = 0"), spans.filter("1 = 0"), ["trip"], "a", "b").isEmpty()
    line = spark.range(50).select(F.lit("k").alias("trip"), F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    whole = replay.coverage(line, line.filter("a <> 7"), ["trip"], "a", "b").collect()
    assert [(r.reason, r.a, r.b) for r in whole] == [("uncovered", 7, 8)]


def test_a_long_day_is_dealt_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(replay, "ROWS", 5)
    rest = [record(i, "delta", i + 1, 1 + (i == 30), 2, []) for i in range(2, 40)]
    again = [record(40, "baseline", 1, 1, 0, [change(B, enters=True)], updates=[(B, 1)], stream="s2")]
    again += [record(i, "delta", i - 39, 1, 0, [], stream="s2", poll="p0" if i == 50 else None) for i in range(41, 60)]
    log = spark.createDataFrame([BASE, NEXT, *rest, *again], SCHEMA)
    most = max(r["count"] for r in replay._dealt(log, ["date"]).groupBy("_chunk").count().collect())
    assert most <= 15
    found = replay.faults(log, ["date"])
    assert {(r.segment, r.order, r.rule, r.poll_id) for r in found.collect()} == {(1, 30, "membership_counts", "p30"), (2, 50, "duplicate_poll", "p0")}
