"""Append-only raw logs of snapshots: frames of an 8-byte time, a 4-byte length and a gzip payload.

A log of up to RANGE bytes is a row of Spark's own file reader. A longer one is never in memory
whole: its frames' heads are followed once, which gives ranges of whole frames of about RANGE
bytes, and each range is read by a task, frame by frame. Ranges are read through pyarrow's file
systems (local, HDFS, S3, GCS, Azure by their URIs)."""

from __future__ import annotations

import gzip
import hashlib
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HEAD = struct.Struct(">dI")
MAX_PAYLOAD = 256 * 1024 * 1024
#: Bytes of a range, and the size up to which a file is read whole.
RANGE = 64 * 1024 * 1024
#: Tasks that read ranges, at most; each reads several if there are more.
MOST_TASKS = 20_000
FRAMES = "path string, record_index long, ts double, payload binary, error string, end_offset long"
_FILE = "path string, modificationTime timestamp, length long, content binary"


def opened(path: str) -> pa.NativeFile:
    """Random access to a file by the path that Spark's file reader names."""
    if path.startswith(("file:", "/")):
        return pafs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    system, name = pafs.FileSystem.from_uri(path)
    return system.open_input_file(name)


def heads(read: Callable[[int, int], bytes], length: int, at: int = 0, index: int = 0, most: int = MAX_PAYLOAD) -> Iterator[tuple[int, float | None, int, int | None, str | None]]:
    """(index, time, begin, end of the frame, error) from a frame's begin on. A torn or oversized frame has no end and is the last."""
    while at < length:
        head = read(at, HEAD.size)
        if len(head) < HEAD.size:
            yield index, None, at, None, "truncated"
            return
        ts, size = HEAD.unpack(head)
        end = at + HEAD.size + size
        if size > most or end > length:
            yield index, ts, at, None, "truncated" if size <= most else "oversized"
            return
        yield index, ts, at, end, None
        at, index = end, index + 1


def frames_of(read: Callable[[int, int], bytes], length: int, at: int = 0, index: int = 0, stop: int | None = None, most: int = MAX_PAYLOAD) -> Iterator[tuple[int, float | None, bytes | None, str | None, int]]:
    """(index, time, payload, error, offset after it) of the frames that begin before ``stop``; a damaged payload is an error row. One frame is in memory."""
    for index, ts, begin, end, error in heads(read, length, at, index, most):
        if stop is not None and begin >= stop:
            return
        payload = None
        if end is not None:
            try:
                payload = gzip.decompress(read(begin + HEAD.size, end - begin - HEAD.size))
            except (OSError, EOFError, zlib.error):
                error = "gzip"
        yield index, ts, payload, error, begin if end is None else end


def frames(data: bytes, most: int = MAX_PAYLOAD) -> Iterator[tuple[int, float | None, bytes | None, str | None, int]]:
    """``frames_of`` of a log in memory."""
    return frames_of(lambda at, n: data[at : at + n], len(data), most=most)


def _from_file(file: pa.NativeFile) -> Callable[[int, int], bytes]:
    return lambda at, n: file.read_at(n, at)


def _batches(rows: Iterable[tuple], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of rows of frames, by the bytes of their payloads."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[3] or b"") + 256
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), _KINDS, strict=True)], names=_NAMES)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), _KINDS, strict=True)], names=_NAMES)


def _whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield from _batches((name, *f) for f in frames(data.as_py()))


def frame_ranges(files: DataFrame, size: int = RANGE) -> DataFrame:
    """Ranges of whole frames of about ``size`` bytes: path, length, record_index, begin, stop. ``files``: path, length. Only heads of frames are read."""

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                with opened(path) as file:
                    found, first = [], None
                    for index, _, begin, end, _ in heads(_from_file(file), length):
                        first = (index, begin) if first is None else first
                        if end is None or end - first[1] >= size or end == length:
                            found.append((path, length, *first, length if end is None else end))
                            first = None
                yield pa.RecordBatch.from_pylist([dict(zip(("path", "length", "record_index", "begin", "stop"), r, strict=True)) for r in found], pa.schema([("path", pa.string()), *((n, pa.int64()) for n in ("length", "record_index", "begin", "stop"))]))

    return files.select("path", "length").mapInArrow(find, "path string, length long, record_index long, begin long, stop long")


def read_ranges(ranges: DataFrame) -> DataFrame:
    """The frames of ``frame_ranges``, a range a task's step."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                with opened(r["path"]) as file:
                    yield from _batches((r["path"], *f) for f in frames_of(_from_file(file), r["length"], r["begin"], r["record_index"], r["stop"]))

    return ranges.mapInArrow(decode, FRAMES)


def _placed(frames: DataFrame) -> DataFrame:
    return frames.withColumns({"feed": F.regexp_extract("path", r"([^/]+)/date=", 1), "date": F.try_to_date(F.regexp_extract("path", r"date=(\d{4}-\d{2}-\d{2})", 1))})


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)


def read_frames(spark: SparkSession, path: str, glob: str = "*.log", size: int = RANGE) -> DataFrame:
    """Every frame, with feed and date from the path ``feed/date=YYYY-MM-DD/``; error rows included.

    Files of more than ``size`` bytes are read by ranges of about that size."""
    files = _files(spark, path, glob)
    small = files.filter(F.col("length") <= size).select("path", "content").mapInArrow(_whole, FRAMES)
    large = files.filter(F.col("length") > size).select("path", "length")
    total = large.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")).first()
    if not total.n:
        return _placed(small)
    ranges = frame_ranges(large.repartition(total.n), size).repartition(min(int(total.bytes // size) + 1, MOST_TASKS))
    return _placed(small.unionByName(read_ranges(ranges)))


def stream_frames(spark: SparkSession, path: str, glob: str = "*.log", size: int = RANGE, files_per_trigger: int = 64) -> DataFrame:
    """``read_frames`` of files as they arrive, each once: logs that are complete when they appear, of any length, by ranges."""
    files = spark.readStream.format("binaryFile").schema(_FILE).option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("maxFilesPerTrigger", files_per_trigger).load(path)
    ranges = frame_ranges(files.select("path", "length"), size).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _placed(read_ranges(ranges))


_KINDS = (pa.string(), pa.int64(), pa.float64(), pa.binary(), pa.string(), pa.int64())
_NAMES = ["path", "record_index", "ts", "payload", "error", "end_offset"]


def read_rawlog(spark: SparkSession, path: str, glob: str = "*.log") -> DataFrame:
    """Readable snapshots only: feed, date, record_index, ts, payload."""
    return read_frames(spark, path, glob).filter("error is null").select("feed", "date", "record_index", "ts", "payload")


def integrity(spark: SparkSession, path: str, glob: str = "*.log") -> DataFrame:
    """By file: complete records before the first error of any kind, valid bytes, clean."""
    f = read_frames(spark, path, glob)
    first = f.filter("error is not null").groupBy("path").agg(F.min("record_index").alias("_bad"))
    got = f.join(first, "path", "left")
    fine = F.col("_bad").isNull() | (F.col("record_index") < F.col("_bad"))
    return got.groupBy("path").agg(F.count_if(fine).alias("records"), F.coalesce(F.max(F.when(fine, F.col("end_offset"))), F.lit(0)).alias("valid_bytes"), F.max("_bad").isNull().alias("clean"))


def read_journal(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; a malformed line is kept in ``_corrupt``."""
    return spark.read.schema(f"{schema}, _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_derived(spark: SparkSession, path: str) -> DataFrame:
    """Parquet partitions of mixed schema versions, by column name."""
    return spark.read.option("mergeSchema", True).parquet(path)


def write_partitioned(df: DataFrame, path: str, date: str = "date") -> None:
    """zstd Parquet by date; replaces the dates that ``df`` holds and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(date).parquet(path)


def file_inventory(spark: SparkSession, path: str, glob: str = "*", size: int = RANGE) -> DataFrame:
    """path, size, mtime, sha256 of each file that is not empty (Spark lists no others); files of more than ``size`` bytes are hashed piece by piece."""

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for path in batch.column(0).to_pylist():
                digest = hashlib.sha256()
                with opened(path) as file:
                    while piece := file.read(1 << 20):
                        digest.update(piece)
                made.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], names=["path", "size", "mtime", "sha256"])

    files = _files(spark, path, glob)
    small = files.filter(F.col("length") <= size).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"), F.sha2("content", 256).alias("sha256"))
    large = files.filter(F.col("length") > size).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))
    return small.unionByName(large.mapInArrow(digests, "path string, size long, mtime timestamp, sha256 string"))
