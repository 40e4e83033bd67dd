"""Keeping only meaningful rows: comparison with the row emitted last, which no fixed window expresses."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedspark.operators.carry import inside, with_carry, with_previous


@dataclass(frozen=True)
class CompressionPolicy:
    """Which fields make a row worth emitting, compared with the last emitted row of its key."""

    key: tuple[str, ...]
    exact: tuple[str, ...] = ()
    tolerant: dict[str, float] = field(default_factory=dict)
    heartbeat: float | None = None
    ignored: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.exact and not self.tolerant:
            raise ValueError("no tracked fields")
        if any(not math.isfinite(t) or t < 0 for t in self.tolerant.values()):
            raise ValueError("tolerances must be finite and not negative")
        if self.heartbeat is not None and not self.heartbeat > 0:
            raise ValueError("the heartbeat must be positive")
        named = [*self.key, *self.exact, *self.tolerant, *self.ignored]
        if len(named) != len(set(named)):
            raise ValueError("a field is classified twice")

    def covers(self, columns: Iterable[str]) -> bool:
        """Whether every column is classified, once."""
        return {*self.key, *self.exact, *self.tolerant, *self.ignored} == set(columns)

    def changed(self, last: tuple, row: tuple) -> bool:
        n = len(self.exact)
        if any(a != b for a, b in zip(last[:n], row[:n], strict=True)):
            return True
        for a, b, t in zip(last[n:], row[n:], self.tolerant.values(), strict=True):
            if isinstance(a, str) or isinstance(b, str) or a is None or b is None:
                if a != b:
                    return True
            elif abs(b - a) > t if t > 0 else a != b:
                return True
        return False


def plain(values: pa.Array) -> list:
    """Exact Python values; NaN as a text, so that it equals itself and nothing else."""
    return ["NaN" if x != x else x for x in values.to_pylist()]


def compress(df: DataFrame, policy: CompressionPolicy, time: str, order: list[str], bucket: list[str] | None = None, durable: str | None = None, cut: bool = False) -> DataFrame:
    """Rows to emit: the first of a key and bucket (a day, say), a changed one, one after the heartbeat.

    ``time``: seconds. ``order``: a total order inside a key. Rows whose ``durable`` column is
    not true are dropped and do not become the row to compare with. One shuffle by key and
    bucket; a streaming fold holds the last emitted row of one key only, so a key may have
    any number of rows. Null keys are a key; null equals null, NaN equals NaN. Only key,
    time and tracked columns come to Python; the rows that stay are filtered in Arrow, as
    they are. ``cut``, for few keys with many rows: a gap of the heartbeat or more emits
    whatever came before, so runs between such gaps are folded apart."""
    group, fields = [*policy.key, *(bucket or [])], [*policy.exact, *policy.tolerant]
    rows = df.filter(F.coalesce(F.col(durable), F.lit(False))) if durable else df
    if cut and policy.heartbeat is not None:
        w = Window.partitionBy(*group).orderBy(*order)
        new = F.coalesce(F.col(time) - F.lag(time).over(w) >= policy.heartbeat, F.lit(True))
        rows, group = rows.withColumn("_new", new.cast("int")).withColumn("_run", F.sum("_new").over(w)).drop("_new"), [*group, "_run"]

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, last, since = object(), None, 0.0
        for batch in batches:
            keys = zip(*(plain(batch.column(c)) for c in group), strict=True)
            tracked = zip(*(plain(batch.column(c)) for c in fields), strict=True)
            keep = []
            for k, row, now in zip(keys, tracked, batch.column(time).to_pylist(), strict=True):
                if k != key:
                    key, last = k, None
                emit = last is None or policy.changed(last, row) or policy.heartbeat is not None and now - since >= policy.heartbeat
                if emit:
                    last, since = row, now
                keep.append(emit)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return rows.repartition(*group).sortWithinPartitions(*group, *order).mapInArrow(fold, rows.schema).select(*df.columns)


def thin(df: DataFrame, key: list[str], time: str, order: list[str], interval: float, forced: Column, bucket: str) -> DataFrame:
    """Rows kept: the first of a key, one at least ``interval`` after the last kept, and forced ones.

    A forced row and a row at least ``interval`` after its predecessor are kept whatever came
    before; they cut a key's rows into independent runs, over which the fold is dealt. Rows are
    ordered inside (key, bucket) only: ``bucket`` rises with the order (a day, say), and hands
    on its last time and its last cut."""
    before = with_previous(df, key, bucket, order, F.col(time), "_before")
    gap = F.col(time) - F.col("_before.v")
    marked = before.withColumn("_cut", F.coalesce(forced, F.lit(False)) | gap.isNull() | (gap >= interval)).drop("_before")
    w = inside(key, bucket, order)
    numbered = marked.withColumn("_no", F.when(F.col("_cut"), F.sum(F.col("_cut").cast("int")).over(w)))
    last_cut = F.max(F.when(F.col("_cut"), F.struct(F.col(bucket).alias("b"), F.col("_no").alias("n"))))
    carried = with_carry(numbered, key, bucket, {"_carried": last_cut})
    own = F.last(F.when(F.col("_cut"), F.struct(F.col(bucket).alias("b"), F.col("_no").alias("n"))), ignorenulls=True).over(w)
    runs = carried.withColumn("_run", F.coalesce(own, "_carried")).drop("_no", "_carried")

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0.0
        for batch in batches:
            keep = []
            for cut, now in zip(batch.column("_cut").to_pylist(), batch.column(time).to_pylist(), strict=True):
                emit = cut or now - at >= interval
                at = now if emit else at
                keep.append(emit)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return runs.repartition(*key, "_run").sortWithinPartitions(*key, "_run", *order).mapInArrow(fold, runs.schema).select(*df.columns)


def null_guard(df: DataFrame, poll: list[str], signal: Column, guard: int, stream: list[str] | None = None) -> DataFrame:
    """For each poll: rows, signals, rows since the last poll with a signal, and whether these reach the guard."""
    if guard <= 0:
        raise ValueError("the guard must be positive")
    stream = stream or []
    polls = df.groupBy(*stream, *poll).agg(F.count(F.lit(1)).alias("n_rows"), F.count(signal).alias("n_signals"))
    w = Window.partitionBy(*stream).orderBy(*poll)
    island = F.sum((F.col("n_signals") > 0).cast("int")).over(w)
    silent = F.when(F.col("n_signals") == 0, F.col("n_rows")).otherwise(0)
    run = Window.partitionBy(*stream, "_island").orderBy(*poll)
    return polls.withColumn("_island", island).withColumn("silent_rows", F.sum(silent).over(run)).withColumn("tripped", F.col("silent_rows") >= guard).drop("_island")
