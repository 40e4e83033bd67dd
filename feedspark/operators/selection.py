"""Exact order statistics of groups of any size, by refining histograms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Cells of a histogram, and values that are sorted in one array at the end.
CELLS, AT_MOST = 1024, 4096


def order_statistics(rows: DataFrame, by: list[str], value: str, rank: Callable[[Column], Column], name: str, stage: Callable[[DataFrame], DataFrame], cells: int = CELLS, at_most: int = AT_MOST) -> DataFrame:
    """(by, n, name): the value at the place ``rank(n)`` (from 0) of each group's n values in order; exact.

    Null, NaN and infinite values are left out. A pass counts values in ``cells`` cells between the
    smallest and the largest one that still count, keeps the cell that holds the place, and ends
    when it holds few values or one value only; so no task sorts a group. Every pass shrinks the
    cell of a group, as its new ends are values of it. Counts are combined before the shuffle; a group's
    state is one row, which ``stage`` writes to shared storage. Null keys are keys."""
    v = F.col(value).cast("double")
    fine = rows.filter(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], v.alias("_v"))
    keys = [f"_k{i}" for i in range(len(by))]
    state = fine.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    state = stage(state.withColumns({"_place": rank(F.col("n")).cast("long"), "_left": F.col("n")}))

    def inside() -> DataFrame:
        other = state.select(*[F.col(k).alias(f"{k}_s") for k in keys], "_low", "_high", "_place", "_left", "n")
        same = (F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high"))
        for k in keys:
            same = F.col(k).eqNullSafe(F.col(f"{k}_s")) & same
        return fine.join(other, same).drop(*[f"{k}_s" for k in keys])

    while not state.filter((F.col("_left") > at_most) & (F.col("_low") < F.col("_high"))).isEmpty():
        share = F.col("_v") / 2 - F.col("_low") / 2  # halves, as the width of a range may be no number
        cell = F.least(F.floor(share / (F.col("_high") / 2 - F.col("_low") / 2) * cells), F.lit(cells - 1))
        counted = inside().withColumn("_cell", F.when(F.col("_low") < F.col("_high"), cell).otherwise(0)).groupBy(*keys, "n", "_place", "_cell").agg(F.count(F.lit(1)).alias("_left"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        upto = F.sum("_left").over(Window.partitionBy(*keys).orderBy("_cell"))
        here = counted.withColumn("_before", upto - F.col("_left")).filter((F.col("_before") <= F.col("_place")) & (F.col("_place") < F.col("_before") + F.col("_left")))
        state = stage(here.select(*keys, "n", "_low", "_high", (F.col("_place") - F.col("_before")).alias("_place"), "_left"))
    one = F.col("_low") == F.col("_high")
    few = inside().groupBy(*keys, "n", "_place").agg(F.min("_low").alias("_only"), F.array_sort(F.collect_list(F.when(~one, F.col("_v")))).alias("_vs"))
    got = F.when(F.size("_vs") > 0, F.get("_vs", F.col("_place").cast("int"))).otherwise(F.col("_only"))
    return few.select(*[F.col(k).alias(c) for k, c in zip(keys, by, strict=True)], "n", got.alias(name))
