"""Coverage of polls: cadence, gaps, daily statistics, windows, and verdicts on completeness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def data_poll_success(success: Column, parse_ok: Column, stored: list[Column] | None = None, presence_required: Column | None = None, presence_ok: Column | None = None) -> Column:
    """Success and parsed, no storage step that failed (null passes), presence confirmed where required."""
    out = F.coalesce(success, F.lit(False)) & F.coalesce(parse_ok, F.lit(False))
    for c in stored or []:
        out = out & F.coalesce(c, F.lit(True))
    if presence_required is not None:
        out = out & (~F.coalesce(presence_required, F.lit(False)) | F.coalesce(presence_ok, F.lit(False)))
    return out


def upper_median(value: Column) -> Column:
    """sorted[n div 2]: an exact percentile of the values, never between two of them."""
    v = F.array_sort(F.collect_list(value))
    return F.get(v, F.floor(F.size(v) / 2).cast("int"))


def intervals(polls: DataFrame, stream: list[str], time: str, order: list[str], least: float = 5.0) -> DataFrame:
    """Adds ``gap``: seconds since the stream's previous poll; and ``valid_gap``: the same if at least ``least``."""
    w = Window.partitionBy(*stream).orderBy(*order)
    gap = F.col(time) - F.lag(time).over(w)
    return polls.withColumn("gap", gap).withColumn("valid_gap", F.when(gap >= least, gap))


def with_cadence(polls: DataFrame, stream: list[str], default: float) -> DataFrame:
    """Adds the stream's cadence: upper median of its valid gaps, else the default. A stream is a feed's day, whose polls are bounded."""
    cadence = polls.groupBy(*stream).agg(F.coalesce(upper_median(F.col("valid_gap")), F.lit(default)).alias("cadence"))
    return polls.join(cadence, stream)


def gap_summary(polls: DataFrame, stream: list[str], factor: float = 1.5) -> DataFrame:
    """For each stream: polls, cadence, gaps longer than factor * cadence, the longest interval."""
    long = F.col("gap") > factor * F.col("cadence")
    return polls.groupBy(*stream, "cadence").agg(F.count(F.lit(1)).alias("n_polls"), F.count(F.when(long, 1)).alias("n_gaps"), F.max("gap").alias("max_gap"))


def first_gaps(polls: DataFrame, feed: list[str], order: list[str], bucket: str, n: int = 20, factor: float = 1.5) -> DataFrame:
    """The first n gaps of each feed in time order, from the first n of each of its buckets (which rise with the order)."""
    here = F.row_number().over(Window.partitionBy(*feed, bucket).orderBy(*order))
    few = polls.filter(F.col("gap") > factor * F.col("cadence")).withColumn("_no", here).filter(F.col("_no") <= n).drop("_no")
    return few.withColumn("gap_no", F.row_number().over(Window.partitionBy(*feed).orderBy(*order))).filter(F.col("gap_no") <= n)


def expected_polls(cadence: Column, seconds: float = 86_400.0) -> Column:
    return F.greatest(F.lit(1), F.bround(seconds / cadence).cast("long"))


def lower_quantile(df: DataFrame, by: list[str], value: str, fraction: float, name: str) -> DataFrame:
    """Value at index int((n - 1) * fraction) of the sorted values, by cumulative counts of distinct values."""
    w = Window.partitionBy(*by).orderBy(value)
    counts = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    cumulated = counts.withColumns({"_upto": F.sum("_n").over(w), "_total": F.sum("_n").over(Window.partitionBy(*by))})
    return cumulated.filter(F.col("_upto") > F.floor((F.col("_total") - 1) * F.lit(fraction))).groupBy(*by).agg(F.min(value).alias(name))


def flag_list(rules: list[tuple[str, Column]]) -> Column:
    """Names of the rules that hold, in order; a null condition does not."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]))


def verdict(stats: DataFrame, errors: list[tuple[str, Column]], flags: list[tuple[str, Column]]) -> DataFrame:
    """Adds errors, complete (none), flags, quality_ok (none but warnings)."""
    out = stats.withColumns({"errors": flag_list(errors), "flags": flag_list(flags)})
    return out.withColumns({"complete": F.size("errors") == 0, "quality_ok": F.size(F.filter("flags", lambda f: ~f.endswith("_warning"))) == 0})


def coverage_percent(data: Column, expected: Column) -> Column:
    """Two decimals; null (not measured) without a numerator or with no expected polls."""
    return F.when(expected > 0, F.round(100.0 * data / expected, 2))
