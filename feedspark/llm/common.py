"""What the operators of this subpackage share: shared storage, row identity, removal of rows, sources."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null identifier wherever rows are ordered by it: nulls come last.
NULL_ID = 2**63 - 1
#: Narrow keys (two numbers each) are broadcast up to this many, about 100 MB; more of them are joined by a shuffle.
BROADCAST_KEYS = 1_000_000
#: Bytes of a Parquet row group, and of one batch that goes to a Python worker.
ROW_GROUP, BATCH_BYTES = 16 << 20, 8 << 20
_CLEANUP, _BATCH = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in ``spark.checkpoint.dir``; it is deleted when the application ends.

    Only where that setting is absent on one machine (tests) a temporary folder is taken."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    out = f"{base.rstrip('/')}/feedspark-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(out)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return out


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to shared storage and read it again.

    The result no longer depends on the executors that computed it, later steps read only the
    columns that they need, and the shuffle files of this step are removed at its end."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes what ``materialize`` wrote of these tables, once nothing reads them any more."""
    for x in tables:
        path = x.sparkSession._jvm.org.apache.hadoop.fs.Path(x._written_at)
        path.getFileSystem(x.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release() -> None:
    """Gives the memory that this process has freed back to the system; workers live on, from one stage to the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim:
        trim(0)


def releasing(run: Callable) -> Callable:
    """``run`` of one group, and ``release`` after a large one."""

    @functools.wraps(run)
    def wrapped(group: pa.Table) -> pa.Table:
        try:
            return run(group)
        finally:
            if group.nbytes > BATCH_BYTES // 8:
                release()

    return wrapped


def in_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with batches of BATCH_BYTES at most (and one row more); at a task's end its worker releases what it freed."""
    df.sparkSession.conf.set(_BATCH, str(BATCH_BYTES))

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return df.mapInArrow(whole, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(text_col: str) -> Column:
    """The text, an empty one for null."""
    return F.coalesce(F.col(text_col), F.lit(""))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_array(text: Column) -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    flat = F.translate(F.regexp_replace(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "), UPPER, LOWER)
    return F.filter(F.split(flat, " "), lambda w: w != "")


def order_id(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))


def tie_of(text_col: str) -> Column:
    """64 bits of the text's hash; tells apart rows that share an identifier."""
    return F.xxhash64(text_of(text_col))


#: Samples are drawn by a hash modulo this, so that small shares of very large tables are not rounded to none.
SHARES = 1 << 40


def sampled(key: Column, share: Column) -> Column:
    """True for about ``share`` of the keys, always the same ones; equal keys are all in or all out."""
    return F.pmod(F.xxhash64(key), F.lit(SHARES)) < F.ceil(share * F.lit(float(SHARES)))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def filter_rows(docs: DataFrame, keys: DataFrame, how: str, id_col: str = "doc_id", text_col: str = "text", most: int = BROADCAST_KEYS) -> DataFrame:
    """Rows of ``docs`` that ``keys`` (doc_id, text_key) names: 'left_semi' keeps them, 'left_anti' drops them.

    The keys are written and counted first. Up to ``most`` of them are broadcast, and no text
    is shuffled: so name the rows that go, which are few, and not those that stay. More of
    them are joined by a shuffle of both sides. Other columns stay as they are, whatever
    their names."""
    o, k = fresh(docs, "_order_id", "_text_key")
    own = materialize(keys.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias(o), F.col("text_key").alias(k)).distinct())
    n = own.count()
    rows = docs.withColumns({o: order_id(id_col), k: F.xxhash64(text_of(text_col))})
    return rows.join(F.broadcast(own) if n <= most else own, [o, k], how).drop(o, k)
