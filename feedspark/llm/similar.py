"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of at least 0.8.

SimHash over the shingles gives every set a fingerprint, and its covering tables link all
fingerprints within their radius; so near copies of few changes meet at once. At similarity 0.8
fingerprints of 64 bits differ in about 10, though; covering masks for such a radius number
thousands and keep too few bits to tell texts apart. So the remaining pairs come from the
inverted lists of ``overlaps``, which lose none, and every pair of either kind is checked
exactly."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedspark.llm.common import in_batches, materialize, text_of
from feedspark.llm.overlaps import BLOCK, SMALL, node_of, shingles, similar_sets
from feedspark.llm.simhash import RADIUS, links

SHINGLE, LEAST = 5, (80, 100)


def set_fingerprint(s: np.ndarray) -> int:
    """SimHash of a set of shingle hashes: a bit is 1 if it is set in over half of them."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(s), 4096):
        total += np.unpackbits(s[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(s), bitorder="little").view("<i8")[0])


def fingerprint_links(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Pairs of nodes (a, b), a < b, that fingerprints within ``radius`` bits propose: nodes of one fingerprint as a star, fingerprints by covering tables."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for s in (shingles(x.as_py(), shingle) for x in batch.column(0)) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array(map(node_of, sets), pa.int64()), pa.array(map(set_fingerprint, sets), pa.int64())], names=["node", "fp"])

    prints = materialize(in_batches(docs.select(text_of(text_col).alias("t")), run, "node long, fp long").distinct())
    first = materialize(prints.groupBy("fp").agg(F.min("node").alias("first")))
    star = prints.join(first, "fp").filter("node != first").select("first", "node")
    end = lambda c: first.select(F.col("fp").alias(c), F.col("first").alias(f"n{c}"))
    between = links(first.select("fp"), radius).join(end("a"), "a").join(end("b"), "b").select("na", "nb")
    return star.unionByName(between.toDF("first", "node")).select(F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: tuple[int, int] = LEAST, radius: int = RADIUS, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_key, n_shingles, component_id, kept.

    component_id is the smallest id that can be reached over pairs of similarity ``least`` or
    more, all such pairs; ``kept`` marks the component's first document (smallest id, then
    text_key); rows that repeat both are marked alike. Words are cut at ASCII white space, A-Z
    lower-cased.

    Null text and texts without words are alike, and like nothing else. Very long texts count
    whole. Null ids sort last, a component of only null ids has a null component_id. Empty
    table: no rows. Other columns are not read."""
    also = fingerprint_links(docs, text_col, shingle, radius)
    return similar_sets(docs, id_col, text_col, shingle, least, small, block, also, empty_alike=True)
