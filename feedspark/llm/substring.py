"""Substring dedup: repeated passages of at least WINDOW words are removed but for their first occurrence.

Positions are compared by (doc_id, start of the window in words). Every window of WINDOW words
belongs to one anchor, its smallest GRAM-word hash; consecutive windows of one anchor form a
segment. Equal windows have equal anchors, so a passage that recurs shows as an anchor of
several segments, and it is enough to compare the segments of one anchor.

1. Each task cuts its texts to segments and writes their anchors and places only. Anchors are
   counted over all documents; a segment whose anchor stands nowhere else cannot recur.
2. The words of the other segments are taken from the texts. Of segments with the same words
   in one slice of a task, the first goes on; the others are repeated whole.
3. Segments are dealt by anchor. In each partition, windows that stand in several places are
   confirmed by their words and compiled to Aho-Corasick automata, one for each bounded chunk
   of anchors; the segments of these anchors are streamed through it in the order of their
   places, and each match but a window's first is a repeated window.
4. An anchor of more than CROWDED segments (a line that stands in a large share of all
   documents, in ever new surroundings) would make one partition large. Its windows are dealt
   one by one instead, by 128 bits of hash of their words, with partial aggregation: the first
   place of each window, written once and joined back, so that Spark can split a frequent one.
5. The marked intervals are joined to the texts, and the covered words are removed."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm.common import in_batches, materialize, order_id, partitions, table, text_of, tie_of
from feedspark.llm.decontaminate import merged
from feedspark.llm.hashing import HASHES, rolled, sliding_min

WINDOW, GRAM = 20, 6
#: A segment has this many windows at most: its first and last window then cover all its words.
RUN = 20
#: From more segments of one anchor in all documents, its windows are dealt one by one.
CROWDED = 1_000
#: Bytes of text that are looked at together, and segments whose windows one automaton holds (and one anchor's more).
SLICE, CHUNK = 4_000_000, 100
#: What a row of ``CONTENTS`` is: a segment's words, to be dealt by anchor; the hash of a crowded anchor's window; windows that are repeated whole.
PLAIN, CROWD, REPEATED = 0, 1, 2
ANCHORS = "anchor long, did long, tie long, at long, weight int"
CONTENTS = "kind byte, anchor long, did long, tie long, start long, n long, content binary"
SPANS = "did long, tie long, start long, n long"


def _slices(batches: Iterable[pa.RecordBatch], text: int, size: int = SLICE) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of each batch by about ``size`` bytes of text, with the texts."""
    for batch in batches:
        held, total, first = [], 0, 0
        for i, x in enumerate(batch.column(text)):
            held.append(x.as_py().encode())
            total += len(held[-1])
            if total > size:
                yield batch.slice(first, i + 1 - first), held
                held, total, first = [], 0, i + 1
        if held:
            yield batch.slice(first), held


def segments(texts: list[bytes], window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Of all segments: number of the text, first window's start, windows, anchor, whether a window recurs inside."""
    words = [t.split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    n = int(sizes.sum())
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, none, none.astype(bool)
    h = np.fromiter(map(HASHES.__getitem__, chain.from_iterable(words)), np.uint64, n)
    del words
    doc = np.repeat(np.arange(len(sizes)), sizes)
    word = np.arange(n) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    anchors, wins = sliding_min(rolled(h, GRAM), window - GRAM + 1), rolled(h, window)
    at = np.flatnonzero(doc[: len(wins)] == doc[window - 1 :])
    anchors, wins, doc, word = anchors[at], wins[at], doc[at], word[at]
    starts = np.ones(len(at), bool)
    starts[1:] = (anchors[1:] != anchors[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(starts)
    inside = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    starts |= inside % RUN == 0
    first = np.flatnonzero(starts)
    count = np.diff(np.append(first, len(at)))
    of, looped = np.repeat(np.arange(len(first)), count), np.zeros(len(first), bool)
    for lag in range(1, RUN):
        i = np.flatnonzero(wins[:-lag] == wins[lag:])
        looped[of[i[of[i] == of[i + lag]]]] = True
    return doc[first], word[first], count, anchors[first].view(np.int64), looped


def _anchors(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for rows, texts in _slices(batches, 2):
        doc, start, count, anchor, looped = segments(texts, window)
        did, tie = rows.column(0).to_numpy()[doc], rows.column(1).to_numpy()[doc]
        made = [anchor, did, tie, start << 8 | count, (1 + looped).astype(np.int32)]
        yield pa.RecordBatch.from_arrays(list(map(pa.array, made)), names=["anchor", "did", "tie", "at", "weight"])


def _contents(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows (did, tie, t, places [at, anchor, crowded]) to rows of CONTENTS."""
    digest = xxhash.xxh3_128_digest
    for rows, texts in _slices(batches, 2):
        did, tie = rows.column(0).to_pylist(), rows.column(1).to_pylist()
        out: list[list] = [[] for _ in range(7)]

        def put(*row, out=out) -> None:
            for column, x in zip(out, row, strict=True):
                column.append(x)

        seen: dict[bytes, tuple[int, int, int]] = {}
        wins: dict[bytes, tuple[int, int, int]] = {}
        for i in sorted(range(len(texts)), key=lambda i: (did[i], tie[i])):
            words, repeated = texts[i].split(), []
            for at, anchor, crowded in sorted({(p["at"], p["anchor"], p["crowded"]) for p in rows.column(3)[i].as_py()}):
                start, n = at >> 8, at & 255
                content = b" ".join(words[start : start + n + window - 1])
                here = (did[i], tie[i], start)
                if seen.setdefault(content, here) != here:
                    repeated.append((start, start + n))
                elif not crowded:
                    put(PLAIN, anchor, did[i], tie[i], start, n, content)
                else:
                    for j in range(start, start + n):
                        win, own = digest(b" ".join(words[j : j + window])), (did[i], tie[i], j)
                        if wins.setdefault(win, own) != own:
                            repeated.append((j, j + 1))
                        else:
                            put(CROWD, anchor, did[i], tie[i], j, 1, win)
            for since, until in merged(repeated):
                put(REPEATED, 0, did[i], tie[i], since, until - since, None)
        kinds = (pa.int8(), *[pa.int64()] * 5, pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["kind", "anchor", "did", "tie", "start", "n", "content"])


def located(groups: list[list[tuple[int, int, int, bytes]]], window: int = WINDOW) -> Iterator[tuple[int, int, int, int]]:
    """(did, tie, start, n): runs of n windows that match an earlier place; rows of a group: (did, tie, start, words), one anchor's, in order.

    The automaton's letters are the words, numbered as they come. They are few (CHUNK segments
    and one anchor's more), so that no node has many children."""
    number: dict[bytes, int] = {}
    texts = [[[number.setdefault(w, 1 + len(number)) for w in row[3].split(b" ")] for row in rows] for rows in groups]
    coded = [["".join(map(chr, own)) for own in rows] for rows in texts]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for rows in coded:  # confirmed passages: windows whose words stand in several places of the anchor
        counts = Counter(text[i : i + window] for text in rows for i in range(len(text) - window + 1))
        for passage, n in counts.items():
            if n > 1:
                automaton.add_word(passage, len(automaton))
    if not len(automaton):
        return
    automaton.make_automaton()
    first: dict[int, tuple[int, int, int]] = {}
    for (did, tie, start, _), text in zip(chain.from_iterable(groups), chain.from_iterable(coded), strict=True):
        since = until = 0
        for end, passage in automaton.iter(text):
            at = start + end + 1 - window
            here = (did, tie, at)
            if first.setdefault(passage, here) != here:
                if at != until:
                    if until > since:
                        yield did, tie, since, until - since
                    since = at
                until = at + 1
        if until > since:
            yield did, tie, since, until - since


def _resolve(batches: Iterable[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows (anchor, did, tie, start, content) come sorted. Holds one chunk of anchors, each of CROWDED segments at most."""

    def out(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["did", "tie", "start", "n"])

    groups: list[list[tuple[int, int, int, bytes]]] = []
    held, key = 0, None
    for batch in batches:
        found: list[tuple[int, int, int, int]] = []
        for anchor, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if anchor != key:
                key = anchor
                if held >= CHUNK:
                    found += located(groups, window)
                    groups, held = [], 0
                groups.append([])
            groups[-1].append(tuple(row))
            held += 1
        yield out(found)
    yield out(list(located(groups, window)))


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(did, tie, start, n): runs of n windows, from word ``start``, that also start earlier.

    did: the identifier (null: the largest number), tie: the text's hash."""
    if window - GRAM + 1 < 1:
        raise ValueError(f"a window needs {GRAM} words or more")
    spark = docs.sparkSession
    rows = docs.select(order_id(id_col).alias("did"), tie_of(text_col).alias("tie"), text_of(text_col).alias("t"))
    anchors = materialize(in_batches(rows, lambda b: _anchors(b, window), ANCHORS))
    frequent = anchors.groupBy("anchor").agg(F.sum("weight").alias("n")).filter("n > 1")
    recurring = materialize(anchors.drop("weight").join(frequent, "anchor").select("did", "tie", F.struct("at", "anchor", (F.col("n") > CROWDED).alias("crowded")).alias("p")))
    places = recurring.groupBy("did", "tie").agg(F.collect_list("p").alias("places"))
    contents = materialize(in_batches(rows.join(places, ["did", "tie"]), lambda b: _contents(b, window), CONTENTS))

    plain = contents.filter(F.col("kind") == PLAIN).select("anchor", "did", "tie", "start", "content")
    dealt = plain.repartition(partitions(spark), "anchor").sortWithinPartitions("anchor", "did", "tie", "start")
    matched = in_batches(dealt, lambda b: _resolve(b, window), SPANS)
    whole = contents.filter(F.col("kind") == REPEATED).select("did", "tie", "start", "n")
    crowd = contents.filter(F.col("kind") == CROWD).select(F.col("content").alias("win"), "did", "tie", "start")
    lead = materialize(crowd.groupBy("win").agg(F.min(F.struct("did", "tie", "start")).alias("lead"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    single = crowd.join(lead, "win").filter(F.struct("did", "tie", "start") != F.col("lead")).select("did", "tie", "start", F.lit(1).cast("long").alias("n"))
    return materialize(whole.unionByName(matched).unionByName(single))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_removed, kept (words joined by spaces), passages [(start, length)].

    Windows are judged on the input. Null text has no words; shorter texts than a window are
    kept. Very long texts are cut to segments whole, one text in memory at a time with its
    slice. Null ids come last in the order; rows of one id are ordered by their text's hash,
    rows that repeat id and text both count as one document and get the same result. Empty
    table: no rows. Other columns are not read."""
    spans = repeated_passages(docs, id_col, text_col, window).groupBy("did", "tie").agg(F.collect_list(F.struct("start", (F.col("n") + (window - 1)).alias("length"))).alias("spans"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), order_id(id_col).alias("did"), tie_of(text_col).alias("tie"), text_of(text_col).alias("t"))
    joined = rows.join(spans, ["did", "tie"], "left").select("doc_id", "t", "spans")

    def strip(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept, runs = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                words, merged = text.as_py().encode().split(), []
                for s, e in sorted((x["start"], x["start"] + x["length"]) for x in spans.as_py() or ()):
                    if merged and s <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], e)
                    else:
                        merged.append([s, e])
                total.append(len(words))
                removed.append(sum(e - s for s, e in merged))
                runs.append([{"start": s, "length": e - s} for s, e in merged])
                for s, e in reversed(merged):
                    del words[s:e]
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))],
                names=["doc_id", "n_words", "n_removed", "kept", "passages"],
            )

    return in_batches(joined, strip, "doc_id long, n_words long, n_removed long, kept string, passages array<struct<start:long,length:long>>")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = remove_repeats(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS rn FROM win) WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS p FROM rep),
wd AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS p FROM d WHERE len(w) > 0),
kept AS (SELECT wd.doc_id, count(gone.p) AS n_removed, string_agg(CASE WHEN gone.p IS NULL THEN word END, ' ' ORDER BY wd.p) AS s
         FROM wd LEFT JOIN gone ON wd.doc_id = gone.doc_id AND wd.p = gone.p GROUP BY wd.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
