"""Change compression as a stream: the state of a key is its last emitted row."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql import types as T

from feedspark.operators.compression import CompressionPolicy
from feedspark.streaming.texts import as_texts, from_texts, number


def compress_stream(df: DataFrame, policy: CompressionPolicy, time: str, order: list[str], bucket: str, event_time: str | None = None) -> DataFrame:
    """As the batch operator, over a streaming DataFrame; rows of a micro-batch are ordered inside each key.

    The state starts anew when ``bucket`` (a day, as text or number) changes. With a heartbeat
    and a watermark on ``event_time`` it is dropped once the heartbeat has passed: the next row
    would be emitted anyway. Number columns are texts on their way, so that whole numbers
    beyond 2**53, NaN and nulls stay as they are."""
    fields = [*policy.exact, *policy.tolerant]
    rows, own = as_texts(df)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    state_schema = T.StructType([T.StructField("bucket", T.StringType()), T.StructField("since", T.DoubleType()), *[T.StructField(f, kinds[f]) for f in fields]])

    def values(pdf: pd.DataFrame, c: str) -> list:
        return [None if x is None or x is pd.NaT else x for x in pdf[c].tolist()]

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(batches))
        by = list(zip(*([number(x, own.get(c)) for x in values(pdf, c)] for c in order), strict=True))
        pdf = pdf.iloc[sorted(range(len(pdf)), key=by.__getitem__)]
        day_of, since, last = None, 0.0, None
        if state.exists:
            day_of, since, *held = state.get
            last = tuple(held)
        parsed = lambda row: tuple(number(x, own.get(c)) for x, c in zip(row, fields, strict=True))
        keep = []
        for day, at, row in zip(pdf[bucket].astype(str), values(pdf, time), zip(*(values(pdf, f) for f in fields), strict=True), strict=True):
            now = number(at, own.get(time))
            if day != day_of:
                day_of, last = day, None
            emit = last is None or policy.changed(parsed(last), parsed(row)) or policy.heartbeat is not None and now - since >= policy.heartbeat
            if emit:
                since, last = now, row
            keep.append(emit)
        state.update((day_of, float(since), *last))
        if event_time and policy.heartbeat is not None:
            state.setTimeoutTimestamp(max(int((since + policy.heartbeat) * 1000), state.getCurrentWatermarkMs() + 1))
        yield pdf[keep]

    timeout = GroupStateTimeout.EventTimeTimeout if event_time and policy.heartbeat is not None else GroupStateTimeout.NoTimeout
    return from_texts(rows.groupBy(*policy.key).applyInPandasWithState(fold, rows.schema, state_schema, "append", timeout), own)


def once_per_poll(df: DataFrame, poll: list[str], event_time: str, delay: str = "1 day") -> DataFrame:
    """A poll that is delivered again within the delay is dropped."""
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(poll)
