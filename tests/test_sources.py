import gzip
import io
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from feedspark.operators import feeds, health, presence
from feedspark.operators.compression import CompressionPolicy
from feedspark.sources import gtfs_rt, partitions, rawlog
from feedspark.streaming.state import presence_stream, unchanged_since_stream

pytest.importorskip("google.protobuf")


def message(t, vehicles):
    m = gtfs_rt.message_class()()
    m.header.gtfs_realtime_version, m.header.timestamp = "2.0", t
    for name, lat, model in vehicles:
        e = m.entity.add(id=name)
        e.vehicle.position.latitude, e.vehicle.position.longitude = lat, 19.0
        e.vehicle.vehicle.id = name
        if model:
            e.vehicle.vehicle.bkk.vehicle_model = model
        e.vehicle.congestion_level = 77
    return m.SerializeToString()


def log(folder, date, payloads, tail=b""):
    day = folder / "vp" / f"date={date}"
    day.mkdir(parents=True)
    at = {"2024-01-02": 1704153600.0, "2024-01-03": 1704240000.0}[date]
    data = b"".join(struct.pack(">dI", at + 10 * i, len(z)) + z for i, z in enumerate(map(gzip.compress, payloads)))
    (day / "vp.log").write_bytes(data + tail)


def test_decode(spark):
    broken = b"\x0a\x02\x18\x07"  # a header without its required version
    df = spark.createDataFrame([(1, message(7, [("a", 47.5, "X"), ("b", 1.0, None)])), (2, b"\xff"), (3, broken), (4, None), (5, message(8, []))], "i int, payload binary")
    got = {r.i: r for r in gtfs_rt.decode(df).collect()}
    assert [got[i].parse_error is None for i in range(1, 6)] == [True, False, False, False, True]
    assert got[1].header.timestamp == 7 and got[1].entities[0].vehicle.vehicle.bkk.vehicle_model == "X" and got[1].entities[1].vehicle.vehicle.bkk is None
    assert got[5].entities == [] and got[3].parse_error == "missing required fields"


def test_decoded_polls_flatten(spark):
    df = spark.createDataFrame([("p", None, "2024-01-01T00:00:00+00:00", message(7, [("a", 47.5, "X")]))], "poll_id string, request_started_at string, response_received_at string, payload binary")
    polls = gtfs_rt.decode(df)
    row = feeds.vehicle_positions(polls).first()
    assert (row.vehicle_id, row.latitude, row.congestion_level_name, row.bkk_vehicle_model, row.bkk_deviated) == ("a", 47.5, "77", "X", False)
    assert feeds.trip_updates(polls).count() == feeds.alerts(polls).count() == 0
    assert polls.select(feeds.valid_poll("entities", "vehicle", ("shape", "stop", "trip_modifications"))).first()[0]


def test_decoded_alert(spark):
    m = gtfs_rt.message_class()()
    m.header.gtfs_realtime_version = "2.0"
    a = m.entity.add(id="x").alert
    a.header_text.translation.add(text="hi", language="")
    a.informed_entity.add(route_id="r").trip.trip_id = "t"
    a.bkk.modifiedTime = 5
    a.bkk.route.add(route_id="r", effect_type=2).header_text.translation.add(text="é")
    df = spark.createDataFrame([("p", None, "z", m.SerializeToString())], "poll_id string, request_started_at string, response_received_at string, payload binary")
    row = feeds.alerts(gtfs_rt.decode(df)).first()
    assert (row.affected_route_id, row.affected_trip_id, row.header_text_json, row.bkk_modified_time) == ("r", "t", '[{"language":null,"text":"hi"}]', 5)
    assert row.bkk_route_details_json == '[{"cause":null,"cause_name":null,"effect":null,"effect_name":null,"effect_type":2,"effect_type_name":"WARNING","header_text":[{"language":null,"text":"é"}],"route_id":"r"}]'


@pytest.mark.parametrize("allow", [False, True])
def test_rebuild(spark, tmp_path, allow):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    log(raw, "2024-01-02", [message(1, [("a", 1.0, None)]), message(2, [("a", 1.0, None)]), message(3, [("a", 9.0, None)])])
    log(raw, "2024-01-03", [message(1, [("a", 9.0, None)]), b"\xff"])
    p = CompressionPolicy(("entity_id",), ("latitude",), heartbeat=1800)
    got = {str(r.date): r for r in partitions.rebuild(spark, str(raw), out, feeds.vehicle_positions, p, ("entity_id",), allow).collect()}
    assert (got["2024-01-02"].rows, got["2024-01-02"].raw_records, got["2024-01-03"].parse_failures, got["2024-01-03"].rebuilt, got["2024-01-03"].rows) == (2, 3, 1, allow, int(allow))
    rows = rawlog.read_derived(spark, out)
    assert rows.count() == 2 + allow and rows.orderBy("date", "poll_id").first().poll_id == "rebuild-vp-2024-01-02-00000000"
    assert rows.orderBy("date", "poll_id").first().response_received_at == "2024-01-02T00:00:00+00:00"


def test_compaction(spark, tmp_path):
    out = str(tmp_path / "t")
    for i in range(4):
        df = spark.range(i * 5, i * 5 + 5).withColumn("date", F.lit("2024-01-02").cast("date"))
        (df.withColumn("late", F.lit("x")) if i == 3 else df).coalesce(1).write.mode("append").partitionBy("date").parquet(out)
    spark.range(3).withColumn("date", F.lit("2024-01-03").cast("date")).coalesce(1).write.mode("append").partitionBy("date").parquet(out)
    got = partitions.compact(spark, out, order=("id",), min_files=3).collect()
    assert [(str(r.date), r.files, r.rows) for r in got] == [("2024-01-02", 4, 20)]
    assert len(list((tmp_path / "t" / "date=2024-01-02").glob("*.parquet"))) == 1
    back = rawlog.read_derived(spark, out)
    assert back.count() == 23 and back.filter("late = 'x'").count() == 5
    assert partitions.compact(spark, out, order=("id",), min_files=3).isEmpty()


def test_zipped_tables(spark, tmp_path):
    def archive(name, members):
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as z:
            for n, text in members:
                z.writestr(n, text)
        (tmp_path / name).write_bytes(held.getvalue())

    archive("a.zip", [("x/routes.txt", "﻿route_id,route_type\nr,3\ns,\nr,0\n")])
    df = partitions.read_zipped_table(spark, str(tmp_path), "routes.txt", ["route_id", "route_type", "color"])
    kept = {r.route_id: (r.route_type, r.color) for r in partitions.unique_rows(df, ["path", "route_id"], "line").collect()}
    assert kept == {"r": ("0", None), "s": ("", None)}
    assert partitions.unique_rows(df.filter("route_id = 'r'"), ["route_id"], "line", last=False).first().route_type == "3"
    archive("b.zip", [("x/routes.txt", "a\n"), ("routes.txt", "a\n")])
    with pytest.raises(Exception, match="exactly one"):
        partitions.read_zipped_table(spark, str(tmp_path), "routes.txt", ["a"]).collect()


def test_records(spark, tmp_path):
    log(tmp_path, "2024-01-02", [b'{"kind":"baseline","sequence":1}', b"["])
    got = partitions.read_presence(spark, str(tmp_path), "kind string, sequence long", "*.log").orderBy("record_index").collect()
    assert got[0].record.kind == "baseline" and (got[1].record is None or got[1].record.kind is None)
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "2024-01-02.json").write_text('{"date":\n"2024-01-02"}')
    (tmp_path / "r" / "2024-01-03.json").write_text("{")
    assert {(r.file_stem, r.date) for r in partitions.read_objects(spark, str(tmp_path / "r"), "date string").collect()} == {("2024-01-02", "2024-01-02"), ("2024-01-03", None)}


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def stream(spark, tmp_path, rows, schema, build, name):
    for i, batch in enumerate(rows):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = build(live).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)


def test_presence_stream(spark, tmp_path, rocks):
    polls = [[("f", 1.0, "d", True, ["a", "b"]), ("f", 2.0, "d", True, ["b", "c"])], [("f", 3.0, "d", False, None), ("f", 4.0, "d", True, ["c"])], [("f", 5.0, "d", True, []), ("f", 6.0, "e", True, ["z"])]]
    got = stream(spark, tmp_path, polls, "feed string, time double, day string, ok boolean, members array<string>", lambda d: presence_stream(d, 3), "presence")
    assert got.filter("size(entered) + size(withdrawn) = 0").count() + got.filter("size(entered) + size(withdrawn) > 0").count() == 15
    by = lambda c: {r.time: r.x for r in got.groupBy("time").agg(F.array_sort(F.flatten(F.collect_list(c))).alias("x")).collect()}
    assert by("entered") == {1.0: ["a", "b"], 2.0: ["c"], 4.0: ["c"], 5.0: [], 6.0: ["z"]}
    assert by("withdrawn") == {1.0: [], 2.0: ["a"], 4.0: [], 5.0: ["c"], 6.0: []}
    assert {(r.time, r.kind, r.sequence) for r in got.collect()} == {(1.0, "baseline", 1), (2.0, "delta", 2), (4.0, "baseline", 1), (5.0, "delta", 2), (6.0, "baseline", 1)}


def test_presence_state_grows_with_changes(spark, tmp_path, rocks):
    """Two hundred members, of which a poll replaces three: entries written are the changed ones, and the result is the batch operator's."""
    schema = "feed string, time double, day string, ok boolean, members array<string>"
    polls, held = [], [f"m{i}" for i in range(200)]
    for t in range(5):
        polls.append(("f", float(t), "d", True, list(held)))
        held = [*held[3:], *[f"n{t}-{i}" for i in range(3)]]
    for p in polls:
        spark.createDataFrame([p], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = presence_stream(live, 2).writeStream.format("memory").queryName("grown").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    written = [p["stateOperators"][0]["customMetrics"]["rocksdbPutCount"] for p in q.recentProgress if p["numInputRows"]]
    assert written[0] > 200 and all(w < 40 for w in written[1:])
    got = {(r.time, m, "withdrawn") for r in spark.table("grown").collect() for m in r.withdrawn} | {(r.time, m, "baseline" if r.kind == "baseline" else "entered") for r in spark.table("grown").collect() for m in r.entered}
    seen = spark.createDataFrame([(p[1], m) for p in polls for m in p[4]], "time double, member string")
    grid = presence.poll_grid(seen.select("time").distinct(), "time", F.lit(False), day=F.lit("d"))
    assert got == {tuple(r) for r in presence.membership_changes(seen, grid, "time", ["member"]).collect()}


def test_freshness_stream(spark, tmp_path):
    polls = [[("f", 0.0, 10, "x"), ("f", 200.0, 10, "x")], [("f", 400.0, 350, "x"), ("f", 500.0, 350, None)]]
    got = stream(spark, tmp_path, polls, "feed string, time double, header long, content string", unchanged_since_stream, "fresh")
    flags = health.freshness(got, F.col("time"), F.col("header"), F.col("content_since"), F.col("header_since"), F.lit(False), F.lit(False))
    assert [(r.content_since, r.header_since, r.flags) for r in flags.orderBy("time").collect()] == [(0.0, 0.0, []), (0.0, 0.0, ["source_timestamp_stale"]), (0.0, 400.0, ["payload_frozen"]), (500.0, 400.0, [])]
