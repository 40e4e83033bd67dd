"""Order along a feed's whole history in two levels: inside buckets (days), and over one row for each bucket.

A window over a feed alone is one task for each feed, however long its history is. Here rows
are only ordered inside (key, bucket); what a bucket hands on is a row, and only these rows are
ordered along the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def inside(key: list[str], bucket: str, order: list[str]):
    return Window.partitionBy(*key, bucket).orderBy(*order)


def joined(rows: DataFrame, summary: DataFrame, key: list[str], bucket: str) -> DataFrame:
    """``rows`` with their bucket's row of ``summary``; null keys are keys."""
    names = [*key, bucket]
    other = summary.withColumnsRenamed({c: f"_j_{c}" for c in names})
    on = F.lit(True)
    for c in names:
        on = on & rows[c].eqNullSafe(other[f"_j_{c}"])
    return rows.join(other, on, "left").drop(*[f"_j_{c}" for c in names])


def with_carry(rows: DataFrame, key: list[str], bucket: str, values: dict[str, Column]) -> DataFrame:
    """Adds for each name what its aggregate was in the latest earlier bucket of the key in which it is not null."""
    daily = rows.groupBy(*key, bucket).agg(*[v.alias(name) for name, v in values.items()])
    before = Window.partitionBy(*key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return joined(rows, daily.select(*key, bucket, *[F.last(n, ignorenulls=True).over(before).alias(n) for n in values]), key, bucket)


def latest(value: Column, order: list[str]) -> Column:
    """Aggregate: struct(v) of the bucket's last row, so that a null value is a value."""
    return F.max_by(F.struct(value.alias("v")), F.struct(*order))


def with_previous(rows: DataFrame, key: list[str], bucket: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Adds struct(v) of the key's row before (null for its first row), across buckets."""
    carried = with_carry(rows.withColumn("_value", value), key, bucket, {"_carried": latest(F.col("_value"), order)})
    own = F.lag(F.struct(F.col("_value").alias("v"))).over(inside(key, bucket, order))
    return carried.withColumn(name, F.coalesce(own, "_carried")).drop("_value", "_carried")
