import gzip
import random
import struct

import pytest
from pyspark.sql import functions as F

from feedspark.functions import scalars as fn
from feedspark.operators import coverage, health, presence, versions
from feedspark.operators.compression import CompressionPolicy, compress, null_guard, thin
from feedspark.operators.revisions import consecutive_delta, lower_quantiles, revision_histogram
from feedspark.sources import rawlog
from feedspark.streaming.compression import compress_stream

ROWS = "id long, k string, day string, t double, x string, v double"


def naive(rows, tolerance, heartbeat):
    last, out = {}, []
    for i, k, day, t, x, v in rows:
        old = last.get((k, day))
        if old is None or old[1] != x or (old[2] is None) != (v is None) or v is not None and abs(v - old[2]) > tolerance or t - old[0] >= heartbeat:
            last[k, day] = (t, x, v)
            out.append(i)
    return out


def make(seed, n=400):
    r, out, t = random.Random(seed), [], 0.0
    for i in range(n):
        t += r.choice([0, 1, 5, 30])
        out.append((i, r.choice(["a", "b", None]), f"d{int(t) // 2000}", t, r.choice("pq") if r.random() < 0.1 else "p", None if r.random() < 0.1 else float(r.randrange(9))))
    return out


def test_jitter_and_heartbeat(spark):
    p = CompressionPolicy(("k",), (), {"v": 2.0}, 1800)
    rows = [(i, "a", "d", float(t), "", float(v)) for i, (t, v) in enumerate([(0, 0), (10, 1), (20, 2), (30, 3), (1829, 3), (1830, 3)])]
    got = compress(spark.createDataFrame(rows, ROWS), p, "t", ["t", "id"], ["day"])
    assert sorted(r.t for r in got.collect()) == [0, 30, 1830]


@pytest.mark.parametrize("seed", [23, 17])
def test_compression_equals_naive_and_stream(spark, tmp_path, seed):
    rows, p = make(seed), CompressionPolicy(("k",), ("x",), {"v": 2.0}, 60)
    df = spark.createDataFrame(rows, ROWS)
    want = sorted(naive(rows, 2.0, 60))
    assert sorted(r.id for r in compress(df, p, "t", ["t", "id"], ["day"]).collect()) == want
    for i in range(3):
        df.filter((F.col("id") >= i * 140) & (F.col("id") < (i + 1) * 140)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = compress_stream(live, p, "t", ["t", "id"], "day").writeStream.format("memory").queryName(f"s{seed}").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.id for r in spark.table(f"s{seed}").collect()) == want


def test_policy_is_checked():
    for bad in ({}, {"tolerant": {"v": -1.0}}, {"tolerant": {"v": float("nan")}}, {"exact": ("k",)}, {"exact": ("x",), "heartbeat": 0}):
        with pytest.raises(ValueError):
            CompressionPolicy(("k",), **bad)
    assert CompressionPolicy(("k",), ("x",), {"v": 1.0}, ignored=("t",)).covers(["k", "x", "v", "t"])


def test_thin_keeps_by_last_kept(spark):
    df = spark.createDataFrame([(i, "a", "d", float(t), "", None) for i, t in enumerate([0, 5, 9, 12, 13, 21, 40])], ROWS)
    got = thin(df.withColumn("b", F.floor(F.col("t") / 15)), ["k"], "t", ["t", "id"], 10.0, F.col("t") == 13, "b")
    assert sorted(r.t for r in got.collect()) == [0, 12, 13, 40]


def test_null_guard(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1), (3, None)], "p int, s int")
    got = {r.p: (r.silent_rows, r.tripped) for r in null_guard(df, ["p"], F.col("s"), 2).collect()}
    assert got == {1: (2, True), 2: (0, False), 3: (1, False)}


def test_presence(spark):
    df = spark.createDataFrame([(1, "t", 1), (1, "t", 2), (2, "t", 1), (2, "t", 2), (3, "t", 1), (4, "t", 1), (4, "t", 2)], "p int, trip string, stop int")
    grid = presence.poll_grid(spark.createDataFrame([(p,) for p in range(1, 6)], "p int"), "p", F.lit(False))
    ch = presence.membership_changes(df, grid, "p", ["trip", "stop"])
    assert sorted((r.p, r.stop, r.change) for r in ch.collect()) == [(1, 1, "baseline"), (1, 2, "baseline"), (3, 2, "withdrawn"), (4, 2, "entered"), (5, 1, "withdrawn"), (5, 2, "withdrawn")]
    assert [r.members for r in presence.replay(ch, grid, "p").orderBy("p").collect()] == [2, 2, 1, 2, 0]
    assert presence.replay_violations(ch, grid, "p", ["trip", "stop"]).isEmpty()
    assert not presence.replay_violations(ch.union(ch.filter("p = 4")), grid, "p", ["trip", "stop"]).isEmpty()


def test_quantile_rules_differ(spark):
    h = spark.createDataFrame([(i, 1) for i in range(1, 11)], "revision long, n long")
    assert lower_quantiles(h).first().p95 == 9
    v = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    assert v.agg(coverage.upper_median(F.col("v"))).first()[0] == 3.0
    d = spark.createDataFrame([(1, 1, 100), (1, 2, None), (1, 3, 104)], "k int, t int, v int")
    assert [(r.revision, r.n) for r in revision_histogram(consecutive_delta(d, ["k"], ["t"], "v")).collect()] == [(4, 1)]


@pytest.mark.parametrize(("cadence", "expected"), [(10, 8640), (15, 5760), (30, 2880)])
def test_expected_polls(spark, cadence, expected):
    assert spark.range(1).select(coverage.expected_polls(F.lit(float(cadence)))).first()[0] == expected


def test_versions(spark):
    h = spark.createDataFrame([("2024-01-01 00:00:00", 1, "old"), ("2024-01-01 12:00:00", 2, "new"), ("2024-01-01 12:00:00", 3, "late"), (None, 4, "x")], "c string, n int, v string").withColumn("c", F.col("c").cast("timestamp"))
    o = spark.createDataFrame([("2023-12-31 23:00:00",), ("2024-01-01 08:00:00",), ("2024-01-01 12:00:00",), ("2024-01-03 13:00:00",)], "t string").withColumn("t", F.col("t").cast("timestamp"))
    assert [r.v for r in versions.as_of(o, h, "t", "c", ["n"], ["v"]).orderBy("t").collect()] == [None, "old", "new", "new"]


def test_health(spark):
    p = spark.createDataFrame([("a", 100.0, True, ["x"]), ("a", 130.0, False, ["y_warning"]), ("b", 1.0, True, [])], "f string, t double, ok boolean, fl array<string>")
    got = {r.f: (r.reasons, r.warnings, r.healthy) for r in health.health_as_of(p, ["f"], "t", 150.0, F.col("ok"), F.col("fl"), 30, 30).collect()}
    assert got == {"a": (["request_failed"], ["y_warning"], False), "b": (["absent"], [], False)}


def test_modes(spark):
    df = spark.createDataFrame([("109",), ("800",), ("11",), ("1000",), ("3",), ("1",), ("1001",), (None,)], "t string")
    got = [tuple(r) for r in df.select(fn.public_mode(F.col("t")), fn.analytic_mode(F.col("t"))).collect()]
    assert [g[0] for g in got] == ["rail", "trolleybus", "trolleybus", "ferry", "bus", "metro", "rail", "other"]
    assert [g[1] for g in got] == ["hev", "trolleybus", "trolleybus", "ferry", "bus", "metro", "ferry", "static_route_type_unknown"]


def test_scalars(spark):
    row = spark.range(1).select(
        fn.strict_date(F.lit("2024-02-30")).alias("d"), fn.aware_timestamp(F.lit("2024-01-01T00:00:00")).alias("n"), fn.aware_timestamp(F.lit("2024-01-01T00:00:00Z")).alias("a"),
        fn.printable_label(F.lit("a b\tc d")).alias("l"), fn.age_label(F.lit(-3)).alias("g"), fn.route_color(F.lit("AB12cd"), F.lit("#000000")).alias("c"), fn.plottable(F.lit(0.0), F.lit(0.0)).alias("p"),
    ).first()
    assert row.d is None and row.n is None and row.a is not None and (row.l, row.g, row.c, row.p) == ("abc d", "0s", "#ab12cd", False)


def test_raw_log(spark, tmp_path):
    frame = lambda t, b: struct.pack(">dI", t, len(b)) + b
    folder = tmp_path / "vp" / "date=2024-01-02"
    folder.mkdir(parents=True)
    (folder / "x.log").write_bytes(frame(1.0, gzip.compress(b"one")) + frame(2.0, b"bad") + frame(3.0, gzip.compress(b"three")) + b"\0\0")
    got = rawlog.read_rawlog(spark, str(tmp_path)).orderBy("record_index").collect()
    assert [(r.feed, str(r.date), r.record_index, r.ts, bytes(r.payload)) for r in got] == [("vp", "2024-01-02", 0, 1.0, b"one"), ("vp", "2024-01-02", 2, 3.0, b"three")]
    s = rawlog.integrity(spark, str(tmp_path)).first()
    assert (s.records, s.clean) == (1, False)
