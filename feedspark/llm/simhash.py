"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm.common import BROADCAST_KEYS, NULL_ID, in_batches, materialize, order_id, table, text_of

RADIUS, SHINGLE, SEED = 2, 3, 42
#: Buckets of more fingerprints are split by further masks before any pair is compared.
BUCKET = 32


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 bits, as a signed number. No words: zero."""
    w = text.encode().lower().split()
    if not w:
        return 0
    flat = b" ".join(w)
    digest = xxhash.xxh64_intdigest
    if len(w) <= shingle:
        h = np.array([digest(flat, seed)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
        starts = np.concatenate(([0], ends[: -shingle])).tolist()
        h = np.fromiter((digest(flat[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)), np.uint64, len(starts))
    total = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        total += np.unpackbits(h[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(total * 2 > len(h), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key, fp for each row. A text is in memory whole, one at a time with its batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = pa.array([fingerprint(x.as_py(), shingle) for x in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fp], names=["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_key"), text_of(text_col).alias("t"))
    return in_batches(rows, run, "doc_id long, text_key long, fp long")


def masks(radius: int = RADIUS, positions: tuple[int, ...] = tuple(range(64))) -> list[int]:
    """The covering masks over these bit positions, 2 ** (radius + 1) - 1 of them.

    Every position gets a nonzero vector of radius + 1 bits; mask v keeps the positions
    whose vector has an odd inner product with v. Given any ``radius`` positions, some v is
    orthogonal to all their vectors: its mask keeps none of them, so the two fingerprints
    agree in that table. No pair within the radius is lost."""
    size = 2 ** (radius + 1)
    return [sum(1 << p for i, p in enumerate(positions) if (v & (i % (size - 1) + 1)).bit_count() % 2) for v in range(1, size)]


def refined(above: list[int], radius: int) -> list[int]:
    """For each mask, the masks of a covering of the positions that it leaves free, each with those that it keeps."""
    return [m | x for m in above for x in masks(radius, tuple(i for i in range(64) if not m >> i & 1))]


def _signed(xs: list[int]) -> Column:
    return F.array(*[F.lit(x - 2**64 if x >= 2**63 else x).cast("long") for x in xs])


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints (fp) within ``radius`` bits; their components are those of all such pairs.

    Pairs are compared inside the buckets of the covering tables, and a pair belongs to the
    first table in which it meets. A pair is left out where a smaller member of the bucket is
    within the radius of both: it joins them already, so that a crowd gives a star and not all
    its pairs. A bucket of more than ``bucket`` fingerprints is split: its members agree in the
    bits that its mask keeps, so a covering of the free bits deals them to further tables,
    again without loss. Every step leaves fewer bits free; when these number five, a bucket has
    32 members at most. So no group is compared that is larger than ``bucket`` (32 at least)."""
    bucket = max(bucket, 32)
    over, tables = masks(radius), 2 ** (radius + 1) - 1
    place = F.posexplode(F.transform(_signed(over), lambda m: F.col("fp").bitwiseAND(m))).alias("t", "k")
    rows, found = distinct.select("fp", place), None

    def close(x: Column, y: Column) -> Column:
        return F.bit_count(x.bitwiseXOR(y)) <= radius

    while True:
        sizes = materialize(rows.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
        met = rows.join(sizes.filter(F.col("n") <= bucket).drop("n"), ["t", "k"]).groupBy("t", "k").agg(F.array_sort(F.collect_list("fp")).alias("g"))
        earlier = F.slice(_signed(over), (F.col("t") - F.col("t") % tables + 1).cast("int"), (F.col("t") % tables).cast("int"))
        with_table = met.select("g", earlier.alias("e"))

        def of(b: Column, j: Column) -> Column:
            smaller = F.slice("g", F.lit(1), j)
            here = F.filter(smaller, lambda a: close(a, b) & F.forall("e", lambda m: a.bitwiseXOR(b).bitwiseAND(m) != 0))
            needed = F.filter(here, lambda a: ~F.exists(smaller, lambda x: (x < a) & close(x, a) & close(x, b)))
            return F.transform(needed, lambda a: F.struct(a.alias("a"), b.alias("b")))

        pairs = with_table.select(F.explode(F.flatten(F.transform("g", of))).alias("p")).select("p.a", "p.b")
        found = pairs if found is None else found.unionByName(pairs)
        large = sizes.filter(F.col("n") > bucket).drop("n")
        if large.isEmpty():
            return found.distinct()
        crowded = rows.join(large, ["t", "k"], "left_semi")
        over = refined(over, radius)
        own = F.slice(_signed(over), (F.col("t") * tables + 1).cast("int"), tables)
        rows = materialize(crowded.select("fp", F.col("t").alias("_t"), F.posexplode(F.transform(own, lambda m: F.col("fp").bitwiseAND(m))).alias("i", "k")).select("fp", (F.col("_t") * tables + F.col("i")).alias("t"), "k"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, by alternating large-star and small-star steps.

    Neighbourhoods are reduced by partial aggregates and joins, never collected; the minima are
    broadcast while there are BROADCAST_KEYS edges or fewer. Each round is written to shared
    storage, which cuts the lineage. The rounds end when every node has one edge, to a node that has none to a smaller one."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    size = edges.count()
    while True:
        near = F.broadcast if size <= BROADCAST_KEYS else lambda df: df
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(near(low), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(near(low), "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").filter("u != v").distinct()
        edges = materialize(small)
        size = edges.count()
        near = F.broadcast if size <= BROADCAST_KEYS else lambda df: df
        chained = edges.join(near(edges.select(F.col("v").alias("u"))), "u", "left_semi")
        if chained.isEmpty() and edges.select("u").distinct().count() == size:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_key, fp, component_id, kept.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the smallest id that
    can be reached. Equal fingerprints become one node first, so that a group of copies of
    any size costs one node. ``kept`` marks the component's first document (smallest id,
    then text_key); rows that repeat both are marked alike.

    Null text and texts without words have fingerprint zero and link like any other. Very long
    texts are hashed whole. Null
    ids sort last, a component of only null ids has a null component_id. Empty table: no
    rows. Other columns are not read."""
    prints = materialize(fingerprints(docs, id_col, text_col, shingle))
    first = F.min(F.struct(order_id("doc_id").alias("o"), F.col("text_key").alias("k")))
    nodes = materialize(prints.groupBy("fp").agg(first.alias("w")))
    roots = components(links(nodes.select("fp"), radius))
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("w").alias("c"))
    labels = named.join(least, "root").select("fp", "c")
    got = prints.join(labels, "fp")
    kept = (order_id("doc_id") == F.col("c.o")) & (F.col("text_key") == F.col("c.k"))
    return got.select("doc_id", "text_key", "fp", F.nullif(F.col("c.o"), F.lit(NULL_ID)).alias("component_id"), kept.alias("kept"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
