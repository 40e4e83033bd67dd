"""A Parquet table whose ledger names the files in force; each version of the ledger is one list.

A writer puts its files into a folder of its own, which no reader sees, and then writes the next
version of the list. A version counts from its _SUCCESS file on. So a crash at any place leaves
the version before readable, a batch that is written again finds its rows there already, and
files are replaced by naming others. One writer at a time; a second one that started from the
same version fails as the next list exists.

Below the table's path: ``_ledger/<number>/`` (JSON lines: file, day, rows, bytes) and
``data/commit=<id>/<date column>=<day>/``. Days are dates or plain words."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILES = "file string, day string, rows long, bytes long"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def versions(spark: SparkSession, path: str) -> tuple[int, int]:
    """Numbers of the newest complete version (0: none yet) and of the next one to write."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_ledger")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return 0, 1
    found = [s.getPath() for s in fs.listStatus(at) if s.getPath().getName().isdigit()]
    whole = [int(p.getName()) for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max(whole, default=0), max((int(p.getName()) for p in found), default=0) + 1


def files(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The files in force (of an earlier version where it is given): file, day, rows, bytes."""
    number = versions(spark, path)[0] if version is None else version
    if not number:
        return spark.createDataFrame([], FILES)
    return spark.read.schema(FILES).json(f"{path}/_ledger/{number:010d}")


def _named(spark: SparkSession, path: str, schema: T.StructType, chosen: Iterable[str]) -> DataFrame:
    paths = [f"{path}/{f}" for f in chosen]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*paths).select(*schema.names)


def read(spark: SparkSession, path: str, schema: str | T.StructType, days: list[str] | None = None, version: int | None = None) -> DataFrame:
    """Rows of the files in force; only those of ``days``, where these are given, are opened."""
    kinds = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    wanted = files(spark, path, version)
    wanted = wanted if days is None else wanted.filter(F.col("day").isin(days))
    return _named(spark, path, kinds, [r.file for r in wanted.select("file").collect()])


def _put(rows: DataFrame, path: str, date: str) -> DataFrame:
    """Writes a folder that no version names yet; its files: file, day, rows, bytes."""
    folder = f"{path}/data/commit={uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").partitionBy(date).parquet(folder)
    made = rows.sparkSession.read.schema(rows.schema).parquet(folder)
    name = F.regexp_extract("_metadata.file_path", r"/(data/commit=[0-9a-f]{32}/.*)$", 1)
    day = F.regexp_extract("_metadata.file_path", rf"/{date}=([^/]*)/[^/]*$", 1)
    return made.groupBy(name.alias("file"), day.alias("day"), F.col("_metadata.file_size").alias("bytes")).agg(F.count(F.lit(1)).alias("rows")).select("file", "day", "rows", "bytes")


def _commit(spark: SparkSession, path: str, in_force: DataFrame, number: int) -> None:
    in_force.coalesce(1).write.mode("errorifexists").json(f"{path}/_ledger/{number:010d}")


def append_once(rows: DataFrame, path: str, key: list[str] | None = None, date: str = "date") -> int:
    """Adds the rows whose key (default: all columns) the table does not hold yet, each once; the number of files added.

    Only keys of the rows' own days are read, and only the key columns of them. So a batch that is
    run again, also from an earlier place in the stream and with other limits, adds nothing twice.
    Null is a value of a key."""
    spark = rows.sparkSession
    newest, following = versions(spark, path)
    before = files(spark, path, newest)
    key = list(dict.fromkeys([*(key or rows.columns), date]))
    new = rows.dropDuplicates(key)
    if newest:
        days = [r[0] for r in rows.select(F.coalesce(F.col(date).cast("string"), F.lit(NO_DAY))).distinct().collect()]
        seen = read(spark, path, rows.schema, days, newest).select(*[F.col(c).alias(f"_seen_{c}") for c in key])
        same = F.lit(True)
        for c in key:
            same = same & F.col(c).eqNullSafe(F.col(f"_seen_{c}"))
        new = new.join(seen, same, "left_anti")
    added = _put(new, path, date)
    n = added.count()
    if n:
        _commit(spark, path, before.unionByName(added), following)
    return n


def compact(spark: SparkSession, path: str, schema: str | T.StructType, date: str = "date", order: tuple[str, ...] = (), target_bytes: int = 256 * 2**20) -> DataFrame:
    """Packs the small files of each day into files of about ``target_bytes``; day, files_before, files_after, rows.

    Files of at least half the target stay as they are and are not read. The others are filled
    into bins in order of size; a bin of one file stays too. The list is switched after the new
    files' rows were counted; different counts stop the work with the old version in force."""
    kinds = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    newest, following = versions(spark, path)
    before = files(spark, path, newest)
    upto = Window.partitionBy("day").orderBy("bytes", "file").rowsBetween(Window.unboundedPreceding, -1)
    small = before.filter(F.col("bytes") * 2 < target_bytes)
    bins = small.withColumn("bin", F.floor(F.coalesce(F.sum("bytes").over(upto), F.lit(0)) / target_bytes))
    several = bins.groupBy("day", "bin").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    chosen = bins.join(several.drop("n"), ["day", "bin"], "left_semi").collect()
    held = spark.createDataFrame([(r.day, r.file, r.bin, r.rows) for r in chosen], "day string, file string, bin long, rows long")
    if chosen:
        one = spark.read.schema(kinds).option("basePath", f"{path}/data").parquet(*[f"{path}/{r.file}" for r in chosen])
        name = F.regexp_extract("_metadata.file_path", r"/(data/commit=[0-9a-f]{32}/.*)$", 1)
        dealt = one.withColumn("_file", name).join(F.broadcast(held.select(F.col("file").alias("_file"), F.col("bin").alias("_bin"))), "_file")
        parts = len({(r.day, r.bin) for r in chosen})
        packed = dealt.repartition(parts, date, "_bin").sortWithinPartitions(date, "_bin", *order).select(*kinds.names)
        added = spark.createDataFrame(_put(packed, path, date).collect(), FILES)
        counted = added.groupBy("day").agg(F.sum("rows").alias("now"))
        if not held.groupBy("day").agg(F.sum("rows").alias("rows")).join(counted, "day", "full_outer").filter(~F.col("rows").eqNullSafe(F.col("now"))).isEmpty():
            raise OSError("packed files hold other numbers of rows than those they would replace")
        _commit(spark, path, before.join(F.broadcast(held.select("file")), "file", "left_anti").select("file", "day", "rows", "bytes").unionByName(added), following)
    else:
        added = spark.createDataFrame([], FILES)
    after = added.groupBy("day").agg(F.count(F.lit(1)).alias("files_after"))
    return held.groupBy("day").agg(F.count(F.lit(1)).alias("files_before"), F.sum("rows").alias("rows")).join(after, "day", "left").select("day", "files_before", "files_after", "rows")
