"""Hard negatives: exact search by inner product with length buckets and sorted coordinate lists.

Vectors become integers. Rows are dealt by length class (and by label where only one label is
asked for), a class of many rows over blocks of bounded size, so that no label, length or
repeated vector is a task. An anchor goes to the blocks whose longest vector can reach its bound.

In a block the rows lie in buckets by falling length, each with a sorted list of every
coordinate. With the bound theta of an anchor q, a row p of a bucket of longest vector m must
have a cosine of at least c = theta / (|q| m) with q. So where q's unit vector has value u in a
coordinate, p's lies between u c - s and u c + s, s = sqrt((1 - u^2) (1 - c^2)) (or reaches 1
or -1, where u itself is beyond c). The ranges of the focus coordinates, those where the anchor
is largest, are looked up in the lists and intersected; what is left is multiplied out, exactly.
The best rows so far raise the bound for the next bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedspark.llm.common import BROADCAST_KEYS, materialize, table
from feedspark.llm.whitening import _padded, usable

POSITIVES, NEGATIVES, SCALE = 5, 3, 256
#: Rows of a block and of a bucket, anchors of a block, focus coordinates.
ROWS, BUCKET, ANCHORS, FOCUS = 8192, 1024, 2048, 4
#: Length classes grow by this factor.
CLASS = 1.1
LARGEST = 2**63 - 1


def integers(vector: str) -> Column:
    """floor(256 * entry), entries as double; results beyond 2^60 in size are held there."""
    most = float(1 << 60)
    return F.transform(vector, lambda c: F.greatest(F.least(F.floor(c.cast("double") * SCALE).cast("double"), F.lit(most)), F.lit(-most)).cast("long"))


def products(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles or 64 bits where they are exact there, else as Python's integers."""
    most = int(np.abs(rows).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(1, rows.shape[1])
    if most < 1 << 53:
        return (rows.astype(float) @ q.astype(float)).astype(np.int64)
    if most < 1 << 63:
        return rows @ q
    return np.array([min(LARGEST, max(-LARGEST, v)) for v in rows.astype(object) @ q.astype(object)], np.int64)


class Bucket:
    """Rows of similar length with their sorted coordinate lists."""

    def __init__(self, rows: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> None:
        self.rows, self.at, self.longest = rows, at, float(lengths.max(initial=0.0))
        self.flat = rows.astype(float) if int(np.abs(rows).max(initial=0)) < 1 << 20 else None
        self.unit = rows / np.where(lengths > 0, lengths, 1.0)[:, None]
        self.order = np.argsort(self.unit, axis=0)
        self.values = np.take_along_axis(self.unit, self.order, 0)

    def candidates(self, unit: np.ndarray, size: float, bound: float) -> np.ndarray | None:
        """Places of the rows that can reach the bound; None for all."""
        if bound <= 0 or not size or not self.longest:
            return None
        c = bound / (size * self.longest)
        if c > 1 + 1e-9:
            return np.zeros(0, np.int64)
        c, ranges = min(1.0, c), []
        for f in np.argsort(-np.abs(unit))[:FOCUS].tolist():
            u = float(unit[f])
            s = np.sqrt(max(0.0, 1 - u * u) * (1 - c * c))
            low, high = (-1.0 if u <= -c else u * c - s), (1.0 if u >= c else u * c + s)
            a, b = np.searchsorted(self.values[:, f], (low - 1e-9, high + 1e-9))
            ranges.append((int(b - a), f, int(a), int(b), low - 1e-9, high + 1e-9))
        ranges.sort()
        few, f, a, b, *_ = ranges[0]
        if few * 2 > len(self.rows):
            return None
        left = self.order[a:b, f]
        for _, g, _, _, low, high in ranges[1:]:
            here = self.unit[left, g]
            left = left[(here >= low) & (here <= high)]
        return left

    def scores(self, q: np.ndarray, places: np.ndarray | None) -> np.ndarray:
        if self.flat is not None and int(np.abs(q).max(initial=0)) < 1 << 20:
            return ((self.flat if places is None else self.flat[places]) @ q.astype(float)).astype(np.int64)
        return products(self.rows if places is None else self.rows[places], q)


def buckets(x: np.ndarray) -> list[Bucket]:
    lengths = np.sqrt((x.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-lengths, kind="stable")
    return [Bucket(x[p], lengths[p], p) for p in (order[i : i + BUCKET] for i in range(0, len(order), BUCKET))]


def _best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first rows by falling score, then id, then the row's key."""
    if len(score) > 8 * k:
        bar = np.partition(score, len(score) - k)[len(score) - k]
        some = np.flatnonzero(score >= bar)
        return some[np.lexsort((rows[some], ids[some], -score[some]))[:k]]
    return np.lexsort((rows, ids, -score))[:k]


def blocks_of(rows: DataFrame, by: list[str], size: int) -> DataFrame:
    """A row for each ``by`` and length class: first_block, n_blocks, longest."""
    sizes = rows.groupBy(*by, "_class").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("n_blocks"), F.max("_length").alias("longest"))
    return materialize(sizes.select(*by, "_class", "n_blocks", "longest"))


def search(anchors: DataFrame, rows: DataFrame, by: list[str], run: Callable, schema: str, size: int) -> DataFrame:
    """``run`` on each block of rows and block of anchors that can meet: anchors have ``by``, a_row, _length and _bound."""
    kinds = blocks_of(rows, by, size)
    few = F.broadcast(kinds) if kinds.count() <= BROADCAST_KEYS // 10 else kinds
    own = [*by, "_class"]
    home = F.pmod(F.xxhash64("row"), F.col("n_blocks")).cast("int")
    n = max(1, -(-anchors.count() // ANCHORS))
    dealt = rows.join(few, own).select("row", "vec_id", "label", "x", *own, home.alias("_block"))
    dealt = dealt.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    if by:
        asked = anchors.join(few, by)
    else:  # each class's rows, longest first, as one small array: it holds a few hundred classes at most
        all_kinds = [(r["_class"], r.n_blocks, r.longest) for r in kinds.collect()]
        made = F.array(*[F.struct(F.lit(c).alias("_class"), F.lit(b).alias("n_blocks"), F.lit(m).alias("longest")) for c, b, m in all_kinds]) if all_kinds else F.expr("cast(array() as array<struct<_class:int,n_blocks:int,longest:double>>)")
        asked = anchors.select("*", F.inline(made))
    reach = (F.col("_bound") <= 0) | (F.col("_length") * F.col("longest") * (1 + 1e-9) >= F.col("_bound"))
    meet = asked.filter(reach).withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).drop("n_blocks", "longest", "_length", "_bound")
    meet = meet.withColumn("_part", F.pmod(F.xxhash64("a_row"), F.lit(n)).cast("int"))
    key = [*own, "_block", "_part"]
    meet = meet.select(*[F.col(c).alias(c) for c in meet.columns])  # columns of its own beside those of the rows
    return dealt.groupBy(*key).cogroup(meet.groupBy(*key)).applyInArrow(run, schema)


def prepared(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    own = rows.filter(label.isNotNull() & usable(vector_col)).select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), integers(vector_col).alias("x"))
    own = own.filter(F.col("vec_id").isNotNull()).distinct()
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))
    own = own.select("*", F.xxhash64("vec_id", "label", "x").alias("row"), length.alias("_length"))
    return own.withColumn("_class", F.when(F.col("_length") > 0, F.floor(F.log(F.col("_length")) / float(np.log(CLASS)))).otherwise(-1).cast("int"))


def _columns(t: pa.Table, names: tuple[str, ...]) -> list[np.ndarray]:
    return [t.column(c).to_numpy() for c in names]


def _matrix(t: pa.Table, name: str, d: int) -> np.ndarray:
    return _padded(t.column(name), d, np.int64)


def _width(*lists: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.offsets.to_numpy()).max(initial=0)) for x in lists for c in x.chunks), default=0)


def mine(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = 50, high: int = 95, block: int = ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor.

    An anchor's positives are its first rows of the same label with another id, its negatives,
    for each positive, the first rows of other labels with low % to high % of the positive's
    score. Scores are inner products of the integer vectors; higher ones come first, then
    smaller ids. ``label`` and ``anchor`` are expressions over ``rows``.

    Rows without id, label or vector, or with null or non-finite entries, take no part. Rows
    that repeat id, label and vector are one; rows that share an id only are different ones,
    in a fixed order where score and id tie, and never positives of each other. Shorter
    vectors are filled with zeros; scores beyond 64 bits are held at their largest number. An anchor without a
    positive, or a positive of negative score, has no rows. Empty table: no rows. Other
    columns are not read."""
    label = F.col("label") if label is None else label
    all_rows = materialize(prepared(rows, id_col, vector_col, label))
    chosen = F.col("vec_id") % 50 == 0 if anchor is None else anchor
    asked = all_rows.filter(chosen).select(F.col("row").alias("a_row"), F.col("vec_id").alias("anchor_id"), "label", F.col("x").alias("q"), "_length")

    def nearest(_: tuple, members: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if members.num_rows and anchors.num_rows:
            d = _width(members.column("x"), anchors.column("q"))
            ids, keys = _columns(members, ("vec_id", "row"))
            parts = buckets(_matrix(members, "x", d))
            for a, own, q in zip(*_columns(anchors, ("a_row", "anchor_id")), _matrix(anchors, "q", d), strict=True):
                size = float(np.sqrt((q.astype(float) ** 2).sum()))
                unit, bound = q / (size or 1), -np.inf
                best: list[np.ndarray] = [np.zeros(0, np.int64)] * 3
                for b in parts:
                    c = b.candidates(unit, size, bound)
                    s, at = b.scores(q, c), b.at if c is None else b.at[c]
                    other = (ids[at] != own) & (s >= bound)
                    best = [np.concatenate(p) for p in zip(best, (s[other], ids[at][other], keys[at][other]), strict=True)]
                    top = _best(*best, positives)
                    best = [p[top] for p in best]
                    if len(top) == positives:
                        bound = int(best[0][-1])
                out += [(int(a), int(own), *map(int, r)) for r in zip(*best, strict=True)]
        names = ("a_row", "anchor_id", "positive_score", "positive_id", "p_row")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*out, strict=True) if out else [[]] * 5, strict=True)})

    found = search(asked.withColumn("_bound", F.lit(0.0)), all_rows, ["label"], nearest, "a_row long, anchor_id long, positive_score long, positive_id long, p_row long", block)
    place = F.row_number().over(Window.partitionBy("a_row").orderBy(F.desc("positive_score"), "positive_id", "p_row"))
    first = found.withColumn("place", place).filter(F.col("place") <= positives).filter("positive_score >= 0")
    paired = first.groupBy("a_row").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("ps"))
    wanted = asked.join(materialize(paired), "a_row").withColumn("_bound", F.array_min(F.col("ps.positive_score")) * low / F.lit(100.0))

    def harder(_: tuple, members: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if members.num_rows and anchors.num_rows:
            d = _width(members.column("x"), anchors.column("q"))
            ids, keys, labels = _columns(members, ("vec_id", "row", "label"))
            parts = buckets(_matrix(members, "x", d))
            for a, own, mine_, q, ps in zip(*_columns(anchors, ("a_row", "anchor_id", "label")), _matrix(anchors, "q", d), anchors.column("ps").to_pylist(), strict=True):
                size = float(np.sqrt((q.astype(float) ** 2).sum()))
                unit = q / (size or 1)
                floors = [-(-low * p["positive_score"] // 100) for p in ps]
                caps = [high * p["positive_score"] // 100 for p in ps]
                bars, best = list(floors), [[np.zeros(0, np.int64)] * 3 for _ in ps]
                for b in parts:
                    bound = min(bars)
                    c = b.candidates(unit, size, bound)
                    s, at = b.scores(q, c), b.at if c is None else b.at[c]
                    some = np.flatnonzero((s >= bound) & (s <= max(caps)) & (labels[at] != mine_))
                    s, at = s[some], at[some]
                    for i, cap in enumerate(caps):
                        inside = (s >= bars[i]) & (s <= cap)
                        if inside.any():
                            both = [np.concatenate(p) for p in zip(best[i], (s[inside], ids[at][inside], keys[at][inside]), strict=True)]
                            top = _best(*both, negatives)
                            best[i] = [p[top] for p in both]
                            if len(top) == negatives:
                                bars[i] = max(floors[i], int(best[i][0][-1]))
                for p, got in zip(ps, best, strict=True):
                    out += [(int(a), int(own), p["place"], p["positive_id"], p["positive_score"], *map(int, r)) for r in zip(*got, strict=True)]
        names = ("a_row", "anchor_id", "place", "positive_id", "positive_score", "negative_score", "negative_id", "n_row")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*out, strict=True) if out else [[]] * 8, strict=True)})

    hard = search(wanted, all_rows, [], harder, "a_row long, anchor_id long, place long, positive_id long, positive_score long, negative_score long, negative_id long, n_row long", block)
    rank = F.row_number().over(Window.partitionBy("a_row", "place").orderBy(F.desc("negative_score"), "negative_id", "n_row"))
    return hard.withColumn("rank", rank).filter(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), label=label)


OP13_SQL = """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike, CAST(list_inner_product(CAST(a.x AS DOUBLE[]), CAST(b.x AS DOUBLE[])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS rank, s.other_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3
"""
