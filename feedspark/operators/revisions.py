"""How predictions are revised: deltas between consecutive observations, and their exact distribution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedspark.operators.carry import with_previous

QUANTILES = (0.5, 0.75, 0.9, 0.95, 0.99)
THRESHOLDS = (0, 1, 2, 5, 10, 15, 20, 30, 60)


def consecutive_delta(df: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """Adds ``delta`` = value - previous non-null value of the key; rows with a null value are left out."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.filter(F.col(value).isNotNull()).withColumn("delta", F.col(value) - F.lag(value).over(w))


def revision_histogram(deltas: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows by absolute delta (whole number); exact. Rows without a delta are left out."""
    size = F.abs(F.col("delta").cast("long")).alias("revision")
    return deltas.filter(F.col("delta").isNotNull()).groupBy(*(by or []), size).agg(F.count(F.lit(1)).alias("n"))


def lower_quantiles(histogram: DataFrame, by: list[str] | None = None, quantiles=QUANTILES) -> DataFrame:
    """Smallest value whose cumulative count exceeds floor((n - 1) * f); one column a quantile.

    The histogram has a row for each distinct value, so the running sum is over few rows."""
    by = by or []
    w = Window.partitionBy(*by).orderBy("revision")
    cumulated = histogram.withColumns({"upto": F.sum("n").over(w), "total": F.sum("n").over(Window.partitionBy(*by))})
    parts = [F.min(F.when(F.col("upto") > F.floor((F.col("total") - 1) * F.lit(q)), F.col("revision"))).alias(f"p{round(q * 100)}") for q in quantiles]
    return cumulated.groupBy(*by).agg(F.sum("n").alias("n"), *parts, F.max("revision").alias("largest"))


def threshold_shares(histogram: DataFrame, thresholds=THRESHOLDS, above: bool = True) -> DataFrame:
    """For each threshold: rows above it (or at most it) and their percentage; null without rows."""
    t = F.explode(F.array(*map(F.lit, thresholds))).alias("threshold")
    totals = histogram.groupBy().agg(F.sum("n").alias("total"), *[F.sum(F.when((F.col("revision") > x) if above else (F.col("revision") <= x), F.col("n")).otherwise(0)).alias(f"_{x}") for x in thresholds])
    own: Column = F.lit(None).cast("long")
    for x in thresholds:
        own = F.when(F.col("threshold") == x, F.coalesce(f"_{x}", F.lit(0))).otherwise(own)
    return totals.select("*", t).select("threshold", own.alias("n"), F.when(F.col("total") > 0, 100.0 * own / F.col("total")).alias("percent"))


def most_common(histogram: DataFrame, n: int = 20) -> DataFrame:
    """The n most frequent values; ties by value."""
    return histogram.orderBy(F.desc("n"), "revision").limit(n)


def sampling_intervals(df: DataFrame, key: list[str], order: list[str], seconds: str, target: float, bucket: str, factor: float = 1.5) -> DataFrame:
    """Median of the non-negative intervals of each key, and whether it is at most factor * target; without any: infinite.

    Rows are ordered inside (key, bucket); the median comes from counts of distinct intervals."""
    gaps = with_previous(df, key, bucket, order, F.col(seconds), "_before").select(*key, (F.col(seconds) - F.col("_before.v")).alias("_gap"))
    counts = gaps.groupBy(*key, F.when(F.col("_gap") >= 0, F.col("_gap")).alias("_gap")).agg(F.count("_gap").alias("_n"))
    w = Window.partitionBy(*key).orderBy("_gap")
    at = counts.withColumns({"_upto": F.sum("_n").over(w), "_total": F.sum("_n").over(Window.partitionBy(*key))})
    place = lambda rank: F.min(F.when((F.col("_n") > 0) & (F.col("_upto") > rank), F.col("_gap")))
    low, high = place(F.floor((F.col("_total") - 1) / 2)), place(F.floor(F.col("_total") / 2))
    got = at.groupBy(*key).agg(((low + high) / 2).alias("median_interval"))
    return got.withColumn("median_interval", F.coalesce("median_interval", F.lit(float("inf")))).withColumn("comparable", F.col("median_interval") <= factor * target)
