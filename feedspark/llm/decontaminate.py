"""Benchmark decontamination: one Aho-Corasick automaton over the items' windows, one scan of each text.

A word of the benchmark is spelled by two letters of the automaton, so that a window of 13 words
is 26 nodes and no node has many children. A text's words are looked up once, words that no
item has are never part of a window, and places found are mapped to characters of the text."""

from __future__ import annotations

import math
import re
import uuid
from array import array
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm.common import NULL_ID, filter_rows, in_batches, materialize, table, text_of, word_array
from feedspark.llm.hashing import HASHES, P, mix, rolled

WINDOW = 13
#: A pass looks for about this many windows (some 2.6 million nodes, 120 MB in each worker) of about
#: this many characters of items; a larger benchmark is looked for in several passes.
PASS_WINDOWS, PASS_CHARS = 100_000, 8_000_000
#: Logarithm of the bits (16 MB) of the filter that a text must pass before it meets several automata, bits of a window in it, and item names remembered by a worker.
FILTER_BITS, PROBES, NAMES_HELD = 27, 4, 1_000_000
#: Windows of one item that are dealt together: longer items are cut, the parts overlapping.
PART_WINDOWS = 2_000
#: Bytes that end a word, and A-Z to lower case. Bytes from 0x80 belong to words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
RUNS = "array<struct<first:long,last:long,start:long,end:long>>"
_RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")]))


def words(text: str) -> list[bytes]:
    return text.encode().translate(FOLD).split()


class Finder:
    """The automaton over all windows of the items (name or None, words joined by spaces)."""

    def __init__(self, items: Iterable[tuple[str | None, str]], width: int = WINDOW):
        number: dict[bytes, int] = {}
        coded = [(name, [number.setdefault(w, len(number)) for w in words(text)]) for name, text in items]
        base = math.isqrt(len(number)) + 1
        self.codes = {w: chr(1 + n // base) + chr(1 + base + n % base) for w, n in number.items()}
        by_number = list(self.codes.values())
        coded.sort(key=lambda x: (x[0] is None, x[0] or ""))
        self.names: list[str | None] = list(dict.fromkeys(name for name, _ in coded))
        place = {name: i for i, name in enumerate(self.names)}
        self.owners: list[array] = []  # of each window, the places of its items' names, rising
        self.named: dict[frozenset[int], list[str | None]] = {}
        self.automaton, shortest = ahocorasick.Automaton(ahocorasick.STORE_INTS), width
        for name, own in coded:
            only, text, n = place[name], "".join([by_number[c] for c in own]), min(len(own), width)
            shortest = min(shortest, n or width)
            for i in range(0, len(text) - 2 * n + 1 if n else 0, 2):
                window = text[i : i + 2 * n]
                at = self.automaton.get(window, -1)
                if at < 0:
                    self.automaton.add_word(window, len(self.owners) << 8 | n)
                    self.owners.append(array("I", (only,)))
                elif self.owners[at >> 8][-1] != only:
                    self.owners[at >> 8].append(only)
        self.runs = re.compile("[^\0]{%d,}" % (2 * shortest))
        if self.owners:
            self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[int, list[tuple[int, int]], list[str | None]]:
        """Number of words, runs of hit words [first, last), and the items found, a null name last.

        Only runs of known words as long as the shortest window go through the automaton."""
        w, get = words(text), self.codes.get
        if not w or not self.owners:
            return len(w), [], []
        found = []
        for m in self.runs.finditer("".join([get(x, "\0\0") for x in w])):
            found += [((m.start() + end + 1) // 2, v) for end, v in self.automaton.iter(m[0])]
        if not found:
            return len(w), [], []
        runs = merged((last - (v & 255), last) for last, v in found)
        return len(w), runs, self.items_of(frozenset(v >> 8 for _, v in found))

    def items_of(self, windows: frozenset[int]) -> list[str | None]:
        """Names of the items that own any of the windows, in order; remembered, as one passage stands in many texts."""
        if windows not in self.named:
            if sum(map(len, self.named.values())) > NAMES_HELD:
                self.named.clear()
            owners = np.unique(np.concatenate([np.frombuffer(self.owners[v], np.uint32) for v in windows]))
            self.named[windows] = [self.names[o] for o in owners.tolist()]
        return self.named[windows]


def merged(runs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs in order, those that touch or overlap made one."""
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


def placed(text: str, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Runs of words with their character offsets in the original text."""
    at = [m.span() for m in WORD.finditer(text)] if runs else []
    return [{"first": a, "last": b, "start": at[a][0], "end": at[b - 1][1]} for a, b in runs]


#: The finder that this worker process built last, by the name of its broadcast.
_BUILT: dict[str, Finder] = {}


def _finder(name: str, items: Broadcast) -> Finder:
    """Built once for each worker process, not for each task; one at a time."""
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Finder(items.value)
    return _BUILT[name]


def parts_of(benchmark: DataFrame, item_col: str, text_col: str, size: int = PART_WINDOWS, width: int = WINDOW) -> DataFrame:
    """(item, t, n): every item, cut to parts of ``size`` windows at most that share width - 1 words; t: words joined by spaces."""
    n = F.size("w")
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), n - width), F.lit(size))
    cut = benchmark.select(F.col(item_col).cast("string").alias("item"), word_array(text_of(text_col)).alias("w")).filter(n > 0).select("item", "w", F.explode(starts).alias("s"))
    own = F.slice("w", F.col("s") + 1, F.lit(size + width - 1))
    return cut.select("item", F.array_join(own, " ").alias("t"), F.greatest(F.lit(1), F.size(own) - (width - 1)).alias("n")).distinct()


def _scanned(rows: DataFrame, items: DataFrame) -> DataFrame:
    """For each row (doc_id, text_key, t): doc_id, text_key, n_words, runs of hit words, items."""
    shared = rows.sparkSession.sparkContext.broadcast([(x.item, x.t) for x in items.select("item", "t").toLocalIterator()])
    name = uuid.uuid4().hex

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _finder(name, shared)
        for batch in batches:
            n_words, runs, found = [], [], []
            for x in batch.column(2):
                text = x.as_py()
                n, r, ids = own.scan(text)
                n_words.append(n)
                runs.append(placed(text, r))
                found.append(ids)
            made = [pa.array(n_words, pa.int64()), pa.array(runs, _RUNS), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["doc_id", "text_key", "n_words", "runs", "items"])

    return in_batches(rows, find, f"doc_id long, text_key long, n_words long, runs {RUNS}, items array<string>")


def _joined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one document that several passes found, made one where they touch."""
    for batch in batches:
        out = []
        for runs in batch.column(3).to_pylist():
            begins = {r["first"]: r["start"] for r in runs}
            ends = {r["last"]: r["end"] for r in runs}
            out.append([{"first": a, "last": b, "start": begins[a], "end": ends[b]} for a, b in merged((r["first"], r["last"]) for r in runs)])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, _RUNS), batch.column(4)], names=["doc_id", "text_key", "n_words", "runs", "items"])


def _places(h: np.ndarray) -> np.ndarray:
    """Bits of the filter of each window's hash, PROBES of them."""
    return np.concatenate([mix(h + np.uint64(i) * P) >> np.uint64(64 - FILTER_BITS) for i in range(PROBES)]).reshape(PROBES, -1)


def _hashed(w: list[bytes]) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, w), np.uint64, len(w))


def _sifted(rows: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, text_key, n_words, t: the text stays where it may hold a window, and is null elsewhere.

    One scan with a Bloom filter of all windows, of fixed size: a larger benchmark lets more texts
    pass, none of those with a window is stopped. The filter is put together by partial aggregates."""

    def bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [_hashed(x.as_py().encode().split()) for x in batch.column(0)]
            at = np.unique(np.concatenate([_places(rolled(h, min(len(h), width))).ravel() for h in own] or [np.zeros(0, np.uint64)]))
            cell, first = np.unique(at >> np.uint64(6), return_index=True)
            mask = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int64)), pa.array(mask.view(np.int64))], names=["cell", "mask"])

    made = in_batches(items.select("t"), bits, "cell long, mask long").groupBy("cell").agg(F.bit_or("mask").alias("mask")).toArrow()
    table_ = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    table_[made.column("cell").to_numpy()] = made.column("mask").to_numpy().view(np.uint64)
    sizes = [r.n for r in items.select(F.least(F.size(F.split("t", " ")), F.lit(width)).alias("n")).distinct().collect()]
    shared = rows.sparkSession.sparkContext.broadcast((table_, sizes))

    def sift(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, widths = shared.value
        for batch in batches:
            n_words, keep = [], []
            for x in batch.column(2):
                h = _hashed(words(x.as_py()))
                n_words.append(len(h))
                hit = False
                for n in widths:
                    at = _places(rolled(h, n))
                    hit = hit or bool(((held[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0).any())
                keep.append(hit)
            texts = pa.compute.if_else(pa.array(keep, pa.bool_()), batch.column(2), pa.scalar(None, batch.column(2).type))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_words, pa.int64()), texts], names=["doc_id", "text_key", "n_words", "t"])

    return in_batches(rows, sift, "doc_id long, text_key long, n_words long, t string")


def _in_passes(rows: DataFrame, items: DataFrame, passes: int) -> DataFrame:
    """Parts of items are dealt by hash over the passes. All texts are scanned once, for windows' hashes; only
    those that may hold a window go through the automata, and what these find (few rows, without texts) is
    joined to the documents by identifier and text hash."""
    key = [F.coalesce("doc_id", F.lit(NULL_ID)).alias("_o"), "text_key"]
    base = materialize(_sifted(rows, items))
    some = base.filter("t is not null").select("doc_id", "text_key", "t")
    found = [materialize(_scanned(some, items.filter(F.pmod(F.xxhash64("item", "t"), F.lit(passes)) == i)).filter(F.size("runs") > 0)) for i in range(passes)]
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
    by_key = hits.groupBy(*key).agg(F.flatten(F.collect_list("runs")).alias("runs"), ids.alias("items"))
    got = base.select("doc_id", "n_words", *key).join(by_key, ["_o", "text_key"], "left")
    filled = got.select("doc_id", "text_key", "n_words", F.coalesce("runs", F.array().cast(RUNS)).alias("runs"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return in_batches(filled, _joined, f"doc_id long, text_key long, n_words long, runs {RUNS}, items array<string>")


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", pass_windows: int = PASS_WINDOWS, pass_chars: int = PASS_CHARS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_key, n_words, n_hit, items (sorted as strings), spans, contaminated.

    The benchmark's windows and characters are counted first. Up to about ``pass_windows`` and
    ``pass_chars`` of them, its words are broadcast and each text is scanned once. A larger one,
    or a very long item, is dealt over passes of that size, which only texts meet that a filter
    of all windows lets pass; the results are the same.

    Null text (of documents or items) has no words. A null item id is an item too: it counts,
    its name is null and comes last. Items that repeat count once. Very long texts are scanned
    whole, one at a time. Rows of documents that repeat are judged alike. Empty benchmark:
    nothing is hit. Empty documents: no rows. Other columns are not read."""
    items = materialize(parts_of(benchmark, item_col, item_text_col))
    size = items.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.length("t").cast("long")), F.lit(0)).alias("chars")).first()
    passes = 1 + max(size.n // pass_windows, size.chars // pass_chars)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_key"), text_of(text_col).alias("t"))
    got = _scanned(rows, items) if passes == 1 else _in_passes(rows, items, passes)
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda s, r: s + r["last"] - r["first"])
    spans = F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))
    out = got.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), "items", spans.alias("spans"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without contamination, with all their columns (anti join with the few contaminated ones)."""
    bad = contamination(docs, benchmark, id_col, text_col).filter("contaminated").select("doc_id", "text_key")
    return filter_rows(docs, bad, "left_anti", id_col, text_col)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 13) AS size, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
       FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
             FROM d, (SELECT DISTINCT size FROM iw) WHERE len(w) >= size)),
hit AS (SELECT dw.doc_id, dw.i, dw.size, iw.item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.size = iw.size),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
