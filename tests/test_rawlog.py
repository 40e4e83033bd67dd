import gzip
import hashlib
import struct

import numpy as np
import pytest

from feedspark.sources import rawlog

PAYLOADS = [bytes([i]) * (50 + 400 * i) for i in range(40)]


def packed(payloads, at=1000.0):
    return b"".join(struct.pack(">dI", at + i, len(z)) + z for i, z in enumerate(gzip.compress(p, mtime=0) for p in payloads))


@pytest.fixture
def logs(tmp_path):
    """Logs that end well, in a torn head, in a torn payload, in an impossible length, and one with a damaged payload inside."""
    r = np.random.default_rng(0)
    noise = [r.integers(0, 256, 3000).astype(np.uint8).tobytes() for _ in range(12)]
    damaged = bytearray(packed(noise))
    damaged[3100] ^= 0xFF
    whole = packed([*PAYLOADS, *noise])
    for name, data in {"a": whole, "b": whole + b"\0\0\0", "c": whole[:-5], "d": whole + struct.pack(">dI", 7.0, 1 << 31) + b"x" * 9000, "e": bytes(damaged), "empty": b""}.items():
        day = tmp_path / "vp" / "date=2024-01-02"
        day.mkdir(parents=True, exist_ok=True)
        (day / f"{name}.log").write_bytes(data)
    return tmp_path


def rows(df):
    return sorted((r.path, r.record_index, r.ts, r.payload and bytes(r.payload), r.error, r.end_offset, r.feed, str(r.date)) for r in df.collect())


def test_ranges_equal_whole_files(spark, logs):
    want = rows(rawlog.read_frames(spark, str(logs)))
    assert {(r[0][-5:], r[4]) for r in want if r[4]} == {("b.log", "truncated"), ("c.log", "truncated"), ("d.log", "oversized"), ("e.log", "gzip")}
    for size in (6000, 20_000):
        assert rows(rawlog.read_frames(spark, str(logs), size=size)) == want
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(logs)).filter("length > 0").select("path", "length")
    ranges = rawlog.frame_ranges(files, 7000).collect()
    assert len(ranges) > 20 and max(r.stop - r.begin for r in ranges if not r.path.endswith("d.log")) < 7000 + 3100
    assert [tuple(r) for r in rawlog.integrity(spark, str(logs)).select("records", "clean").collect()].count((52, True)) == 1


def test_range_reading_holds_a_frame_only(spark, logs):
    most, path = 0, str(logs / "vp" / "date=2024-01-02" / "d.log")
    with rawlog.opened(path) as file:

        def read(at, n):
            nonlocal most
            most = max(most, n)
            return file.read_at(n, at)

        got = list(rawlog.frames_of(read, (logs / "vp" / "date=2024-01-02" / "d.log").stat().st_size))
    assert got[-1][3] == "oversized" and most < 3200


def test_stream_of_logs(spark, logs):
    q = rawlog.stream_frames(spark, str(logs), size=5000, files_per_trigger=2).writeStream.format("memory").queryName("frames").option("checkpointLocation", str(logs / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("frames")) == rows(rawlog.read_frames(spark, str(logs / "vp")))


def test_inventory(spark, logs):
    for size in (1 << 30, 100):
        got = {r.path.rsplit("/", 1)[-1]: (r.size, r.sha256) for r in rawlog.file_inventory(spark, str(logs), size=size).collect()}
        assert got == {p.name: (p.stat().st_size, hashlib.sha256(p.read_bytes()).hexdigest()) for p in (logs / "vp" / "date=2024-01-02").iterdir() if p.stat().st_size}


def test_journal_keeps_damaged_lines(spark, tmp_path):
    (tmp_path / "polls.jsonl").write_text('{"poll_id":"a","success":true}\n{"poll_id":\n')
    got = rawlog.read_journal(spark, str(tmp_path), "poll_id string, success boolean").collect()
    assert [(r.poll_id, r.success, r._corrupt) for r in got] == [("a", True, None), (None, None, '{"poll_id":')]
