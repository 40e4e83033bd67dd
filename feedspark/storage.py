"""Intermediate tables on storage that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def staged(df: DataFrame) -> DataFrame:
    """Written below spark.checkpoint.dir (a temporary folder only where that is unset, on one machine) and read again; deleted when the application ends."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{(base or 'file://' + tempfile.mkdtemp(prefix='spark-', dir='/tmp')).rstrip('/')}/feedspark-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
