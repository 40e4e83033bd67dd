"""Presence and freshness as streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import TimerValues
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from feedspark.streaming.texts import as_texts, from_texts

PRESENCE = "feed string, shard int, time double, kind string, sequence long, entered array<string>, withdrawn array<string>, members long"


class Membership(StatefulProcessor):
    """Members of one shard of a feed, a state entry each; a poll writes the entries that change and its head."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.members = handle.getMapState("members", "member string", "since double")
        self.head = handle.getValueState("head", "day string, sequence long, known boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timer: TimerValues) -> Iterator[pd.DataFrame]:
        day, sequence, known = self.head.get() if self.head.exists() else (None, 0, False)
        out = []
        for row in pd.concat(list(rows)).sort_values("time", kind="stable").itertuples():
            if not row.ok:
                known = False
                continue
            new, held = set(row.members), {m for (m,) in self.members.keys()}
            entered, left = new - held, held - new
            for m in entered:
                self.members.updateValue((m,), (row.time,))
            for m in left:
                self.members.removeKey((m,))
            fresh = not known or row.day != day
            sequence = 1 if fresh else sequence + 1
            out.append((*key, row.time, "baseline" if fresh else "delta", sequence, sorted(new if fresh else entered), [] if fresh else sorted(left), len(new)))
            day, known = row.day, True
        self.head.update((day, sequence, known))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in PRESENCE.split(", ")])

    def close(self) -> None:
        pass


def presence_stream(polls: DataFrame, shards: int = 16) -> DataFrame:
    """Membership changes of full snapshots, a row for each poll and shard: baseline or delta, empty ones too.

    ``polls``: feed string, time double (seconds), day string, ok boolean, members array<string>
    (null members do not count). A poll that is not ok, or a new day, makes the next one a
    baseline: nothing is concluded over a gap, but members that stay keep their state entries. Members
    are dealt by their hash, so the state of a large feed is spread over ``shards`` keys; each shard
    sees every poll. The session needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``)."""
    dealt = polls.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    own = F.filter(F.col("members"), lambda m: m.isNotNull() & (F.pmod(F.xxhash64(m), F.lit(shards)) == F.col("shard")))
    dealt = dealt.select("feed", "shard", "time", "day", "ok", F.coalesce(own, F.array().cast("array<string>")).alias("members"))
    return dealt.groupBy("feed", "shard").transformWithStateInPandas(Membership(), PRESENCE, "append", "none")


def unchanged_since_stream(polls: DataFrame) -> DataFrame:
    """Adds content_since and header_since to each poll; the freshness rules then apply to the row alone.

    ``polls``: feed string, time double, header long, content string. Null equals null."""
    polls, own = as_texts(polls, ("time",))
    schema = f"{', '.join(f'{n} {k}' for n, k in polls.dtypes)}, content_since double, header_since double"

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches)).sort_values("time", kind="stable")
        content, header, since_c, since_h = state.get if state.exists else (None, None, None, None)
        got = []
        for now, c, h in zip(pdf["time"].tolist(), pdf["content"].tolist(), pdf["header"].tolist(), strict=True):
            c, h = (None if pd.isna(x) else x for x in (c, h))
            since_c = now if since_c is None or c != content else since_c
            since_h = now if since_h is None or h != header else since_h
            content, header = c, h
            got.append((since_c, since_h))
        state.update((content, header, since_c, since_h))
        yield pdf.assign(content_since=[g[0] for g in got], header_since=[g[1] for g in got])

    got = polls.groupBy("feed").applyInPandasWithState(step, schema, "content string, header string, since_c double, since_h double", "append", GroupStateTimeout.NoTimeout)
    return from_texts(got, own)
