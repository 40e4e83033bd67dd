"""Packing of documents into sequences of fixed length, planned by non-negative least squares.

A document's ids are cut into whole sequences and a remainder. The histogram of the
remainders (a count for each length below the window) is all that the plan needs:
combinations of two to four remainders that fill the window are the columns of a
non-negative least-squares problem, whose rounded solution says how often each is used.
What is left is packed greedily, with cuts, into full sequences."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedspark.llm.common import in_batches, materialize, table, text_of
from feedspark.llm.encoding import REMEMBERED, encoded

WINDOW = 2048
#: Columns of one least-squares problem at most; further rounds take up what one leaves.
COLUMNS, ROUNDS, SWEEPS = 4000, 6, 30
#: A task's first ranks, a number for each length, are broadcast up to this many tasks (16 kB each); those of more are joined by a shuffle.
BROADCAST_TASKS = 4_096


def nnls(columns: list[dict[int, int]], target: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """x >= 0 that minimises |Ax - target| by cyclic coordinate descent; column j holds its rows' weights."""
    x, rest = np.zeros(len(columns)), target.astype(float).copy()
    flat = [(list(c), np.array(list(c.values()), float)) for c in columns]
    for _ in range(sweeps):
        moved = 0.0
        for j, (rows, weight) in enumerate(flat):
            step = max(-x[j], float(weight @ rest[rows]) / float(weight @ weight))
            if step:
                x[j] += step
                rest[rows] -= step * weight
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def combinations(left: np.ndarray, window: int, limit: int = COLUMNS) -> list[dict[int, int]]:
    """Shallow combinations of lengths that are left and fill the window: twos, threes, and fours by halves."""
    lengths = np.flatnonzero(left)
    by_count = lengths[np.argsort(-left[lengths], kind="stable")]
    found: dict[tuple[int, ...], float] = {}

    def put(parts: Iterable[int]) -> None:
        parts = tuple(sorted(parts))
        if parts not in found and all(left[p] >= parts.count(p) for p in set(parts)):
            found[parts] = float(min(left[p] / parts.count(p) for p in set(parts)))

    for a in lengths.tolist():
        if 0 < window - a < window and left[window - a]:
            put((a, window - a))
    top = by_count[:160].tolist()
    for i, a in enumerate(top):
        for b in top[i:]:
            if 0 < window - a - b < window and left[window - a - b]:
                put((a, b, window - a - b))
    few = by_count[:24].tolist()
    for i, a in enumerate(few):
        for j, b in enumerate(few[i:], i):
            for c in few[j:]:
                if 0 < window - a - b - c < window and left[window - a - b - c]:
                    put((a, b, c, window - a - b - c))
    best = sorted(found, key=lambda p: (-found[p], p))[:limit]
    return [{p: parts.count(p) for p in parts} for parts in best]


def plan(histogram: dict[int, int], window: int = WINDOW) -> tuple[list[tuple[int, int, int, int, int]], dict[int, int], int]:
    """Slots (length, first rank, last rank + 1, first sequence, offset), the first rank left by length, sequences used.

    Bounded work: the histogram has fewer than ``window`` rows whatever the corpus is."""
    left = np.zeros(window, np.int64)
    for r, n in histogram.items():
        left[r] = n
    used = np.zeros(window, np.int64)
    slots, sequences = [], 0
    for _ in range(ROUNDS):
        columns = combinations(left, window)
        if not columns:
            break
        x, before = nnls(columns, left), sequences
        for j in np.argsort(-x, kind="stable").tolist():
            times = min([int(np.floor(x[j] + 0.5)), *(int(left[r]) // n for r, n in columns[j].items())])
            if times <= 0:
                continue
            offset = 0
            for r, n in sorted(columns[j].items()):
                for _ in range(n):
                    slots.append((r, int(used[r]), int(used[r]) + times, sequences, offset))
                    used[r] += times
                    left[r] -= times
                    offset += r
            sequences += times
        if sequences == before:
            break
    return slots, {r: int(used[r]) for r in histogram}, sequences


def pack(docs: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Whole sequences and combinations are full. The rest forms one stream that is cut every
    ``window`` ids; its last part is cut at powers of two, which need no padding.

    Ranks: a task numbers its remainders of each length; counts by (task, length) and running
    sums over tasks make the numbers global. The plan (a bounded number of slots) is broadcast.
    Ids are written once and joined to their task's sums, an array by length: without a shuffle
    of ids while there are at most BROADCAST_TASKS tasks.

    Null text: only the end id. A very long text is encoded whole and cut. Identifiers may be null or repeat: rows are told apart by
    position. Empty table: no rows. Other columns are not read. ``window``: a power of two."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"))
    tail = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, whole, ranks = TaskContext.get().partitionId(), 0, {}
        for batch in batches:
            held: list[list] = [[] for _ in range(7)]
            size = 0

            def full():
                kinds = (pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds, strict=True)], names=["part", "doc_id", "ids", "n", "whole_before", "r", "rank"])

            for doc_id, ids in zip(batch.column(0).to_pylist(), encoded(batch.column(1), tokenizer_path, limit=remembered), strict=True):
                ids += tail
                n = len(ids) // 4
                r = n % window
                rank = ranks.get(r, 0)
                ranks[r] = rank + 1
                small = np.frombuffer(ids, "<u4")
                stored = small.astype("<u2").tobytes() if small.max() < 65_536 else ids
                for col, x in zip(held, (part, doc_id, stored, n, whole, r, rank), strict=True):
                    col.append(x)
                whole, size = whole + n // window, size + len(stored)
                if size > 8_000_000:
                    yield full()
                    held, size = [[] for _ in range(7)], 0
            yield full()

    ids = materialize(in_batches(rows, encode, "part int, doc_id long, ids binary, n long, whole_before long, r int, rank long"))
    counts = materialize(ids.groupBy("part", "r").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("n") / window).cast("long")).alias("w")))
    histogram = {x.r: x.n for x in counts.filter("r > 0").groupBy("r").agg(F.sum("n").alias("n")).collect()}
    slots, rest_from, combined = plan(histogram, window)
    base, at = {}, 0
    for r in sorted(histogram):
        base[r] = at
        at += r * (histogram[r] - rest_from[r])
    streamed, over = divmod(at, window)
    rest_sequences = streamed + bin(over).count("1")
    shared = spark.sparkContext.broadcast((_slot_index(slots), rest_from, base))

    before = Window.partitionBy("r").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks_before = counts.select("part", "r", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank_base"))
    all_before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole_base = counts.groupBy("part").agg(F.sum("w").alias("w")).select("part", F.coalesce(F.sum("w").over(all_before), F.lit(0)).alias("whole_base"))
    known = F.map_from_entries(F.collect_list(F.struct("r", "rank_base"))).alias("m")
    dense = F.transform(F.sequence(F.lit(0), F.lit(window - 1)), lambda r: F.coalesce(F.element_at("m", r), F.lit(0)))
    bases = materialize(ranks_before.groupBy("part").agg(known).join(whole_base, "part").select("part", "whole_base", dense.alias("rank_bases")))
    if bases.count() <= BROADCAST_TASKS:
        bases = F.broadcast(bases)
    joined = ids.join(bases, "part").select("doc_id", "n", "r", "ids", (F.col("rank") + F.get("rank_bases", F.col("r"))).alias("rank"), (F.col("whole_before") + F.col("whole_base")).alias("whole"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, first_left, bases = shared.value
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            held: list[list] = [[] for _ in kinds]
            for doc_id, n, r, stored, rank, whole in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(stored, "<u2" if len(stored) == 2 * n else "<u4").astype("<u4")
                pieces = [(i * window, window, combined + rest_sequences + whole + i, 0) for i in range(n // window)]
                if r:
                    start = n - r
                    if rank < first_left[r]:
                        sequence, offset = _place(index[r], rank)
                        pieces.append((start, r, sequence, offset))
                    else:
                        at = bases[r] + r * (rank - first_left[r])
                        for length, sequence, offset in _stream(at, r, streamed, over, window):
                            pieces.append((start, length, combined + sequence, offset))
                            start += length
                for start, length, sequence, offset in pieces:
                    for col, x in zip(held, (doc_id, start, length, own[start : start + length].tobytes(), n, sequence, offset), strict=True):
                        col.append(x)
                if len(held[0]) >= 4000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds, strict=True)], names=names)
                    held = [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(held, kinds, strict=True)], names=names)

    return in_batches(joined, cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def _slot_index(slots: list[tuple[int, int, int, int, int]]) -> dict[int, tuple[list[int], list[tuple[int, int]]]]:
    out: dict[int, tuple[list[int], list[tuple[int, int]]]] = {}
    for r, first, _, sequence, offset in sorted(slots):
        own = out.setdefault(r, ([], []))
        own[0].append(first)
        own[1].append((sequence, offset))
    return out


def _place(own: tuple[list[int], list[tuple[int, int]]], rank: int) -> tuple[int, int]:
    i = int(np.searchsorted(own[0], rank, side="right")) - 1
    sequence, offset = own[1][i]
    return sequence + rank - own[0][i], offset


def _stream(at: int, size: int, streamed: int, over: int, window: int) -> Iterator[tuple[int, int, int]]:
    """(length, sequence, offset) of the pieces of [at, at + size) in the stream of what is left."""
    while size:
        sequence, offset = divmod(at, window)
        room = window - offset
        if sequence == streamed:
            first = 0
            for k in reversed(range(over.bit_length())):
                if over >> k & 1:
                    if offset < first + (1 << k):
                        offset, room = offset - first, first + (1 << k) - offset
                        break
                    first += 1 << k
                    sequence += 1
        take = min(size, room)
        yield take, sequence, offset
        at, size = at + take, size - take


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    got = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1)
    return got.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
