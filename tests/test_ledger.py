import shutil

import pytest
from pyspark.sql import functions as F

from feedspark.sources import ledger, partitions

SCHEMA = "poll_id long, place int, date string"


def rows(spark, polls, day="2024-01-02"):
    return spark.createDataFrame([(p, i, day) for p in polls for i in range(2)], SCHEMA)


def held(spark, path):
    return sorted((r.poll_id, r.place) for r in ledger.read(spark, path, SCHEMA).collect())


def whole(polls):
    return sorted((p, i) for p in polls for i in range(2))


def test_a_lost_checkpoint_and_other_batch_limits_add_nothing_twice(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run(checkpoint, files):
        live = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(source)
        partitions.write_each_poll_once(live, out, str(tmp_path / checkpoint), key=["poll_id", "place"]).trigger(availableNow=True).start().awaitTermination()

    for p in ([1, 2], [3]):
        rows(spark, p).coalesce(1).write.mode("append").parquet(source)
    run("a", 1)
    assert held(spark, out) == whole([1, 2, 3]) and ledger.versions(spark, out) == (2, 3)
    shutil.rmtree(tmp_path / "a")
    rows(spark, [4, 5]).coalesce(1).write.mode("append").parquet(source)
    run("b", 2)
    run("b", 2)
    assert held(spark, out) == whole([1, 2, 3, 4, 5])
    rows(spark, [5, 6, 6]).coalesce(1).write.mode("append").parquet(source)
    run("b", 2)
    assert held(spark, out) == whole([1, 2, 3, 4, 5, 6])


def test_what_is_not_listed_is_not_read(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "t")
    assert ledger.append_once(rows(spark, [1]), out, ["poll_id", "place"]) > 0

    def crash(*_):
        raise RuntimeError("lost between files and list")

    with monkeypatch.context() as m:
        m.setattr(ledger, "_commit", crash)
        with pytest.raises(RuntimeError):
            ledger.append_once(rows(spark, [2]), out, ["poll_id", "place"])
    assert held(spark, out) == whole([1])
    (tmp_path / "t" / "_ledger" / "0000000002").mkdir()  # a list that was not finished
    assert held(spark, out) == whole([1])
    ledger.append_once(rows(spark, [2, 1]), out, ["poll_id", "place"])
    assert held(spark, out) == whole([1, 2]) and ledger.versions(spark, out) == (3, 4)
    assert sorted({r.poll_id for r in ledger.read(spark, out, SCHEMA, version=1).collect()}) == [1]


def test_null_keys_days_and_empty_batches(spark, tmp_path):
    out = str(tmp_path / "t")
    some = spark.createDataFrame([(None, 1, "2024-01-02"), (7, None, None)], SCHEMA)
    for _ in range(2):
        ledger.append_once(some, out)
    assert ledger.append_once(some.filter("1 = 0"), out) == 0
    assert sorted(map(str, ledger.read(spark, out, SCHEMA).collect())) == sorted(map(str, some.collect()))
    assert ledger.read(spark, str(tmp_path / "none"), SCHEMA).isEmpty()


def test_compaction_packs_small_files_only(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "t")
    large = spark.range(20_000).select((F.col("id") + 1000).alias("poll_id"), F.lit(0).alias("place"), F.lit("2024-01-02").alias("date"))
    ledger.append_once(large.coalesce(1), out)
    for p in range(5):
        ledger.append_once(rows(spark, [p]).coalesce(1), out)
    ledger.append_once(rows(spark, [9], "2024-01-03").coalesce(1), out)
    big = max(ledger.files(spark, out).collect(), key=lambda r: r.bytes)
    want = sorted(map(tuple, ledger.read(spark, out, SCHEMA).collect()))
    old = ledger._put

    def lossy(df, *a):
        return old(df.filter("poll_id <> 3"), *a)

    with monkeypatch.context() as m:
        m.setattr(ledger, "_put", lossy)
        with pytest.raises(OSError, match="other numbers"):
            ledger.compact(spark, out, SCHEMA, target_bytes=big.bytes)
    assert ledger.files(spark, out).count() == 7
    got = ledger.compact(spark, out, SCHEMA, order=("poll_id",), target_bytes=big.bytes).collect()
    assert [(r.day, r.files_before, r.files_after, r.rows) for r in got] == [("2024-01-02", 5, 1, 10)]
    left = {r.file for r in ledger.files(spark, out).collect()}
    assert len(left) == 3 and big.file in left
    assert sorted(map(tuple, ledger.read(spark, out, SCHEMA).collect())) == want
    assert ledger.compact(spark, out, SCHEMA, target_bytes=big.bytes).isEmpty()
    assert ledger.append_once(rows(spark, [2]), out) == 0
