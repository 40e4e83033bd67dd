"""Token counts from pre-token frequencies: every distinct pre-token is counted once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm.common import in_batches, materialize, table, text_of
from feedspark.llm.encoding import encoder, slices, unit_lists

#: The head, which is broadcast, holds a pre-token of L bytes if it makes up at least max(1, L / HEAD_BYTES) / HEAD_SHARE
#: of all occurrences. So there are HEAD_SHARE of them at most, of HEAD_SHARE * HEAD_BYTES bytes together: about 170 MB in
#: a worker in the worst case; in texts, where frequencies fall off, there are far fewer.
HEAD_SHARE, HEAD_BYTES = 1 << 20, 32
#: Units whose pre-tokens a worker remembers, and bytes of texts that are split at once.
REMEMBERED, SLICE = 400_000, 10_000_000


class PreTokens:
    """Splits units into pre-tokens; remembers about ``limit`` units.

    A unit with characters beyond U+024F is split by the library itself, so that no difference
    between Unicode tables matters; one with a special string is one pre-token whole."""

    def __init__(self, pattern: str, path: str, limit: int = REMEMBERED):
        self.split, self.limit, self.known = regex.compile(pattern).findall, limit, {}
        self.own = encoder(path, 0).tokenizer.pre_tokenizer.pre_tokenize_str

    def _of(self, unit: str) -> tuple[str, ...]:
        if "<|" in unit:
            return (unit,)
        if max(unit, default="a") > "\u024f":
            return tuple(unit[a:b] for _, (a, b) in self.own(unit))
        return tuple(self.split(unit))

    def of(self, distinct: list[str]) -> list[tuple[str, ...]]:
        got = list(map(self.known.get, distinct))
        if len(self.known) > self.limit:
            self.known = {}
        for i, x in enumerate(got):
            if x is None:
                got[i] = self.known[distinct[i]] = self._of(distinct[i])
        return got

    def occurrences(self, texts: pa.StringArray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct pre-tokens, and for each occurrence its text's number and its pre-token's."""
        lists = unit_lists(texts)
        ends = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        flat = lists.flatten()
        coded = flat.dictionary_encode()
        heads = flat.take(pa.array(ends[:-1])).to_pylist()
        distinct = [f" {u}" for u in coded.dictionary.to_pylist()]
        codes = coded.indices.to_numpy().copy()
        codes[ends[:-1]] = np.arange(len(heads)) + len(distinct)
        parts = self.of(distinct + heads)
        number: dict[str, int] = {}
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        own = np.fromiter((number.setdefault(p, len(number)) for x in parts for p in x), np.int64, int(sizes.sum()))
        first = np.cumsum(sizes) - sizes
        many = sizes[codes]
        doc = np.repeat(np.repeat(np.arange(len(heads)), np.diff(ends)), many)
        at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[codes], many)
        return list(number), doc, own[at]


_PRE: dict[str, PreTokens] = {}


def _pre(pattern: str, path: str) -> PreTokens:
    if pattern not in _PRE:
        _PRE[pattern] = PreTokens(pattern, path)
    return _PRE[pattern]


def token_counts(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", head_share: int = HEAD_SHARE) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens.

    1. Pre-token frequencies over all documents: counted by task, then summed.
    2. Each distinct one gets its number of pieces, once. The frequent ones are broadcast.
    3. Documents' pre-token frequencies are summed where they are for pre-tokens of the head;
       the others leave the task as (row, pre-token, frequency), are joined to the pieces of
       the distinct pre-tokens, each counted once, and are summed by row.

    No ids are kept. Null text is empty: no tokens. A very long text is in memory whole, its
    pre-tokens leave the task counted. Rows that repeat are counted alike. Identifiers may be null or repeat: rows
    are told apart by position. Empty table: no rows. Other columns are not read."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("_r"), F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"))

    def vocabulary(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre = _pre(pattern, tokenizer_path)
        for batch in batches:
            for held in slices(batch.column(0), SLICE):
                names, _, codes = pre.occurrences(held)
                yield pa.RecordBatch.from_pydict({"p": pa.array(names, pa.string()), "n": pa.array(np.bincount(codes, minlength=len(names)).astype(np.int64))})

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path, 0)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            n = [len(x) // 4 for at in range(0, len(texts), 20_000) for x in own.direct(texts[at : at + 20_000])]
            yield pa.RecordBatch.from_pydict({"p": batch.column(0), "n": batch.column(1), "n_pieces": pa.array(n, pa.int64())})

    counted = in_batches(rows.select("t"), vocabulary, "p string, n long").groupBy("p").agg(F.sum("n").alias("n"))
    distinct = materialize(in_batches(counted, pieces, "p string, n long, n_pieces long"))
    total = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    weight = F.greatest(F.lit(1.0), F.octet_length("p") / F.lit(float(HEAD_BYTES)))
    frequent = distinct.filter(F.col("n") * F.lit(float(head_share)) >= weight * F.lit(float(total)))
    head = spark.sparkContext.broadcast(dict(map(tuple, frequent.select("p", "n_pieces").toLocalIterator())))

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, known = _pre(pattern, tokenizer_path), head.value
        for batch in batches:
            row, done = batch.column(0).to_numpy(), 0
            for held in slices(batch.column(1), SLICE):
                names, doc, codes = pre.occurrences(held)
                size = np.fromiter((known.get(x, -1) for x in names), np.int64, len(names))
                in_head = size[codes] >= 0
                base = np.bincount(doc[in_head], weights=size[codes[in_head]], minlength=len(held)).astype(np.int64)
                pairs, freq = np.unique(doc[~in_head] * len(names) + codes[~in_head], return_counts=True)
                own, which = row[done : done + len(held)], np.asarray(names, object)
                keys = pa.array([*which[pairs % max(1, len(names))], *(f"\0{r}" for r in own)], pa.string())  # a row of its own for each document: it meets no pre-token
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate((own[pairs // max(1, len(names))], own))), keys, pa.array(np.concatenate((freq, np.zeros(len(own), np.int64)))), pa.array([None] * len(freq) + base.tolist(), pa.int64())],
                    names=["_r", "p", "freq", "base"],
                )
                done += len(held)

    per_document = in_batches(rows.select("_r", "t"), documents, "_r long, p string, freq long, base long")
    summed = per_document.join(distinct.select("p", "n_pieces"), "p", "left").groupBy("_r").agg(F.sum(F.coalesce("base", F.col("freq") * F.col("n_pieces"))).alias("n_tokens"))
    return rows.select("_r", "doc_id", F.octet_length("t").cast("long").alias("n_bytes")).join(summed, "_r").drop("_r")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    got = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return got.withColumn("over_limit", F.col("n_tokens") > 1024)
