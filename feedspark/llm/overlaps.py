"""Components of similar sets: bottom-k sketches, inverted lists, union sketches, exact Jaccard.

A text's set of word shingles is ordered by one hash function, in which values that many texts
hold come last (the logarithm of their number leads the hash). Its sketch is the bottom k, where
k = size - ceil(least * size) + 1: two sets of Jaccard similarity ``least`` or more share a
retained value, whatever the order is, so the inverted lists of retained values lose no pair.

1. Equal sets become one node. In each list the most central node (fewest values of its own) meets
   the others; links give first components.
2. What is still apart is compared: in short lists by pairs, with the number of lists they share
   (up to SMALL nodes; where more values are frequent than can be told to the tasks, also lists as long as
   those of the values left out, up to PAIRED); in crowded lists in blocks of sketches, inside tasks. There the nodes outside the list's
   largest component meet all others, so a crowd that is one component is not compared again,
   and pairs that share the crowded value most nodes had before are left to its list.
3. A pair passes the union sketch if its common retained values and all values
   after the sketches could be common values enough; this bound drops no link. The set whose
   last retained value is the smaller one is known up to there: what both hold up to there are
   the lists they share, and it has size - k further values.
4. What passes is checked on full sets: pair by pair, or, where a block's sketches propose more
   than a few pairs a node, as that block.

The steps are the same for any data; only connecting links to components takes rounds, by
the logarithm of their length. Sets are of 58-bit hashes and nodes of 64-bit hashes of sets."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm.common import BROADCAST_KEYS, NULL_ID, discard, filter_rows, in_batches, materialize, order_id, releasing, table, text_of
from feedspark.llm.hashing import HASHES, rolled
from feedspark.llm.simhash import components

SHINGLE, LEAST = 3, (85, 100)
#: Lists up to this size are compared by pairs; nodes of a block of a longer one (and 512 values a node on average).
SMALL, BLOCK = 16, 1024
#: Lists of values that were too many to be told are compared by pairs up to this size: a pair is a row of three numbers, a node in a block its whole sketch.
PAIRED = 256
#: Pairs of lists are counted in passes of this many a node (before sizes are compared).
PAIRS = 256
#: Values that are counted together before they leave a task; hashes below this are counted (a quarter; sketches reach a sixth); how many frequent values are told to the tasks.
SLICE, COUNTED, TOLD = 1 << 20, np.uint64(1 << 62), 1 << 19
#: A block whose sketches propose more pairs than this for each of its nodes is compared on full sets as a block.
DENSE = 4
#: Sets are copied to their pairs and blocks in passes of this many copies a node, or PASS_ROWS in all, counted in sets of mean size: what a pass shuffles is removed before the next.
COPIES, PASS_ROWS = 3, 20_000
#: Full sets are so many times as large as sketches (about): their copies in a pass are fewer by this.
FULL = 8
#: Bits of a value that hold its hash; those above hold the logarithm of its count, 31 at most, so that a value is no negative number.
HASH_BITS = np.uint64(58)


def shingles(text: str, width: int) -> np.ndarray:
    """Hashes of the different runs of ``width`` words, in order; a shorter text is one run. A-Z lower-cased, words cut at ASCII white space."""
    w = text.encode().lower().split()
    h = np.fromiter(map(HASHES.__getitem__, w), np.uint64, len(w))
    return np.unique(rolled(h, min(width, len(w)))) if w else h


def node_of(s: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def coded(s: np.ndarray, known: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The set's values in the order of the sketches: rank of the frequent ones (0 for all others), then hash."""
    h = s >> np.uint64(64 - int(HASH_BITS))
    if len(known) and len(s):
        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
        h |= np.where(known[at] == s, rank[at], np.uint64(0)) << HASH_BITS
    return np.unique(h)


def retained(size: int, least: tuple[int, int]) -> int:
    """k of the bottom-k sketch; 0 for an empty set."""
    return size + 1 - -(-size * least[0] // least[1]) if size else 0


def enough(common: int, x: int, y: int, least: tuple[int, int]) -> bool:
    """Whether sets of x and y values that share ``common`` reach the similarity."""
    return common * (least[0] + least[1]) >= least[0] * (x + y)


def common(x: np.ndarray, y: np.ndarray) -> int:
    """Common values of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0


def lists_needed(nx: int, ny: int, least: tuple[int, int]) -> int:
    """How many retained values sets of these sizes must share at least to reach the similarity."""
    whole = -(-least[0] * (nx + ny) // (least[0] + least[1]))
    return whole - max(nx - retained(nx, least), ny - retained(ny, least))


def common_counts(xs: list[np.ndarray], ys: list[np.ndarray], chunk: int = 4096) -> np.ndarray:
    """Common values of each of xs and each of ys, by products of 0/1 matrices over the values that both sides hold."""
    fx, fy = np.concatenate(xs), np.concatenate(ys)
    ix, iy = np.repeat(np.arange(len(xs)), [len(x) for x in xs]), np.repeat(np.arange(len(ys)), [len(y) for y in ys])
    shared = np.intersect1d(fx, fy)
    out = np.zeros((len(xs), len(ys)), np.float32)
    for at in range(0, len(shared), chunk):
        part = shared[at : at + chunk]
        both = []
        for f, i, n in ((fx, ix, len(xs)), (fy, iy, len(ys))):
            p = np.minimum(np.searchsorted(part, f), len(part) - 1)
            hit = part[p] == f
            m = np.zeros((n, len(part)), np.float32)
            m[i[hit], p[hit]] = 1
            both.append(m)
        out += both[0] @ both[1].T
    return out


def bottom(s: np.ndarray, k: int, known: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first k of ``coded``: most often among the smallest hashes, where few values have to be looked up."""
    low = s[: 2 * k + 16]
    if len(known) and len(low) < len(s):
        at = np.minimum(np.searchsorted(known, low), len(known) - 1)
        rest = low[known[at] != low]
        if len(rest) >= k:
            return rest[:k] >> np.uint64(64 - int(HASH_BITS))
    elif len(low) < len(s):
        return low[:k] >> np.uint64(64 - int(HASH_BITS))
    return coded(s, known, rank)[:k]


def frequent(rows: DataFrame, width: int, above: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of more than ``above`` texts (sorted) and their ranks: the logarithms of these numbers.

    Counted over all texts, for hashes below COUNTED, which all sketches but those of short texts keep
    to; at most TOLD values, the most frequent ones, are told to the tasks. Any order that all tasks use
    gives the same links: these counts only keep the lists short."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed() -> pa.RecordBatch:
            v, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)), pa.array(n)], names=["v", "n"])

        for batch in batches:
            for x in batch.column(0):
                s = shingles(x.as_py(), width)
                held.append(s[: np.searchsorted(s, COUNTED)])
                size += len(held[-1])
                if size > SLICE:
                    yield summed()
                    held, size = [], 0
        if held:
            yield summed()

    seen = materialize(in_batches(rows.select("t"), count, "v long, n long").groupBy("v").agg(F.sum("n").alias("n")).filter(F.col("n") > above))
    got = seen.orderBy(F.desc("n"), "v").limit(TOLD).toArrow()
    v, n = got.column("v").to_numpy().view(np.uint64), got.column("n").to_numpy()
    order = np.argsort(v)
    return v[order], np.minimum(31, np.log2(n[order])).astype(np.uint64)


def _pairs(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _roots_of(entries: DataFrame, roots: DataFrame, n_roots: int) -> DataFrame:
    known = F.broadcast(roots) if n_roots <= BROADCAST_KEYS else roots
    return entries.join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _passes(rows: DataFrame, key: list[str], passes: int, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    done = [materialize(run(rows.filter(F.pmod(F.xxhash64(*key), F.lit(passes)) == i))) for i in range(passes)]
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _in_passes(rows: DataFrame, key: list[str], nodes: int, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``run`` over all rows, those of one key together, in passes that copy at most COPIES * ``nodes`` sets of mean size; a row copies ``weight`` of them.

    Long sets are in more lists than short ones, so that copies are several times as large as sets are on average."""
    copies = rows.agg(F.ceil(F.sum("weight"))).first()[0] or 0
    return _passes(rows, key, max(1, -(-copies // max(PASS_ROWS, COPIES * nodes))), run)


def paired(known: np.ndarray, rank: np.ndarray, small: int) -> int:
    """Up to which size lists are compared by pairs: ``small``, or the count of the rarest value that was told if there was no room for others."""
    return small if len(known) < TOLD else min(max(small, 2 << int(rank.min())), max(small, PAIRED))


def _blocked(entries: DataFrame, sketches: DataFrame, sets_of: Callable[[DataFrame], DataFrame], least: tuple[int, int], block: int, total: int, mean: float) -> tuple[DataFrame, DataFrame]:
    """Of the components that meet in crowded lists, entries (k, node, size, before, root): pairs of nodes that pass the union sketch, and links of roots from dense blocks. ``total`` nodes have sets of ``mean`` values."""
    largest = entries.groupBy("k", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("k").agg(F.max_by("root", "n").alias("big"), F.count(F.lit(1)).alias("roots")).filter("roots > 1").drop("roots")
    usual = entries.filter(F.col("before").isNotNull()).groupBy("k", "before").agg(F.count(F.lit(1)).alias("n")).groupBy("k").agg(F.max_by("before", "n").alias("usual"))
    kind = F.when(F.col("root") != F.col("big"), F.when(F.col("usual").isNull() | ~F.col("before").eqNullSafe(F.col("usual")), "OA").otherwise("OB")).when(F.col("usual").isNull() | ~F.col("before").eqNullSafe(F.col("usual")), "SA").otherwise("SB")
    here = materialize(entries.join(largest, "k").join(usual, "k", "left").select("k", "node", "size", "root", kind.alias("c")))
    count = lambda c: F.greatest(F.ceil(F.count_if(F.col("c") == c) / block), F.ceil(F.sum(F.when(F.col("c") == c, F.col("size"))) / (block * 512))).cast("int").alias(f"n{c}")
    shape = here.groupBy("k").agg(*[F.coalesce(count(c), F.lit(0)).alias(f"n{c}") for c in ("OA", "OB", "SA", "SB")])
    i = F.pmod(F.xxhash64("node", "k"), F.greatest(F.lit(1), F.element_at(F.create_map(*[x for c in ("OA", "OB", "SA", "SB") for x in (F.lit(c), F.col(f"n{c}"))]), F.col("c")))).cast("int")
    upto = lambda n: F.slice(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), F.lit(1), n)

    def place(rc: str | Column, ri: Column, cc: str | Column, ci: Column, side: int) -> Column:
        return F.struct(F.lit(rc).alias("rc"), ri.alias("ri"), F.lit(cc).alias("cc"), ci.alias("ci"), F.lit(side).alias("side"))

    own = F.col("i")
    as_row = lambda rc, cc, js: F.transform(js, lambda j: place(rc, own, cc, j, 0))
    as_column = lambda rc, cc, js: F.transform(js, lambda j: place(rc, j, cc, own, 1))
    n = {c: F.col(f"n{c}") for c in ("OA", "OB", "SA", "SB")}
    oa = F.concat(as_row("OA", "OA", F.filter(upto(n["OA"]), lambda j: j >= own)), as_column("OA", "OA", F.filter(upto(n["OA"]), lambda j: j < own)), *[as_row("OA", c, upto(n[c])) for c in ("OB", "SA", "SB")])
    ob = F.concat(as_column("OA", "OB", upto(n["OA"])), as_row("OB", "SA", upto(n["SA"])))
    sa = F.concat(as_column("OA", "SA", upto(n["OA"])), as_column("OB", "SA", upto(n["OB"])))
    places = F.when(F.col("c") == "OA", oa).when(F.col("c") == "OB", ob).when(F.col("c") == "SA", sa).otherwise(as_column("OA", "SB", upto(n["OA"])))
    dealt = here.join(shape, "k").withColumn("i", i).select("k", "node", "root", (F.col("size") / mean).alias("weight"), F.inline(places))

    key = ["k", "rc", "ri", "cc", "ci"]
    none = pa.array([], pa.int64())

    def propose(group: pa.Table) -> pa.Table:
        side, root, node, size = (group.column(c).to_numpy() for c in ("side", "root", "node", "size"))
        lists = group.column("keys").combine_chunks()
        flat, ends = lists.flatten().to_numpy().view(np.uint64), np.cumsum(np.diff(lists.offsets.to_numpy()))
        values = np.split(flat, ends[:-1])
        rows, cols = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        inner = not len(cols)
        cols = rows if inner else cols
        a, b, dense = none, none, False
        if len(rows) and len(cols):
            rest = size - np.array([len(v) for v in values])
            both = common_counts([values[i] for i in rows], [values[i] for i in cols]).astype(np.int64)
            whole = -(-least[0] * (size[rows][:, None] + size[cols][None]) // (least[0] + least[1]))
            close = both >= np.maximum(1, whole - np.maximum(rest[rows][:, None], rest[cols][None]))
            close &= root[rows][:, None] != root[cols][None]
            if inner:
                close &= node[rows][:, None] < node[cols][None]
            dense = bool(close.sum() > DENSE * (len(rows) + len(cols)))
            if not dense:
                i, j = np.nonzero(close)
                x, y = node[rows[i]], node[cols[j]]
                a, b = pa.array(np.minimum(x, y), pa.int64()), pa.array(np.maximum(x, y), pa.int64())
        if dense:
            a = b = pa.array([None], pa.int64())
        first = {c: group.column(c)[0] for c in key}
        return pa.table({c: pa.array([v.as_py()] * len(a), v.type) for c, v in first.items()} | {"a": a, "b": b})

    def check(group: pa.Table) -> pa.Table:
        side, root = group.column("side").to_numpy(), group.column("root").to_numpy()
        values = [np.frombuffer(v.as_py(), np.uint64) for v in group.column("s")]
        rows, cols = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(cols):
            cols = rows
        out: dict[tuple[int, int], None] = {}
        if len(rows) and len(cols):
            size = np.array([len(v) for v in values], np.int64)
            both = common_counts([values[i] for i in rows], [values[i] for i in cols]).astype(np.int64)
            close = both * (least[0] + least[1]) >= least[0] * (size[rows][:, None] + size[cols][None])
            close &= root[rows][:, None] != root[cols][None]
            at: dict[int, int] = {}

            def top(x: int) -> int:
                while at.get(x, x) != x:
                    x = at[x]
                return x

            for i, j in zip(*np.nonzero(close), strict=True):
                x, y = top(int(root[rows[i]])), top(int(root[cols[j]]))
                if x != y:
                    at[max(x, y)] = min(x, y)
                    out[min(x, y), max(x, y)] = None
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    dealt = materialize(dealt)
    proposed = _in_passes(dealt, key, total, lambda x: x.drop("weight").join(sketches, "node").groupBy(*key).applyInArrow(releasing(propose), "k long, rc string, ri int, cc string, ci int, a long, b long"))
    dense = materialize(dealt.join(proposed.filter("a is null").select(*key), key, "left_semi"))
    links = dealt.limit(0).select(F.col("root").alias("a"), F.col("root").alias("b"))
    if not dense.isEmpty():
        sets = sets_of(dense.select("node"))
        links = _in_passes(dense, key, total // FULL, lambda x: x.drop("weight").join(sets, "node").groupBy(*key).applyInArrow(releasing(check), "a long, b long"))
        discard(sets)
    return proposed.filter("a is not null").select("a", "b"), links


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, least: tuple[int, int] = LEAST, small: int = SMALL, block: int = BLOCK, also: DataFrame | None = None, empty_alike: bool = False) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_key, n_shingles, component_id, kept.

    Documents link when the Jaccard similarity of their shingle sets is least[0] / least[1] or
    more; component_id is the smallest id that can be reached, itself included; ``kept`` marks the
    component's first document (smallest id, then text_key); rows that repeat both are marked
    alike. Texts without words or null have an empty set, which links with nothing: each of
    these rows is a component of its own id. Null ids sort last, a component of only null ids
    has a null component_id. Very long texts count whole; a task holds one text's set at a
    time, a pair's two, or those of two blocks. Empty table: no rows. Other columns are not
    read. ``also`` proposes further pairs (a, b), a < b, of nodes (``node_of`` the set); with
    ``empty_alike`` texts without words are copies of each other."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_key"), text_of(text_col).alias("t"))
    told = spark.sparkContext.broadcast(frequent(rows, shingle, small))

    def sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = told.value
        for batch in batches:
            made: tuple[list, ...] = ([], [], [], [])
            for x in batch.column(2):
                s = shingles(x.as_py(), shingle)
                low = bottom(s, retained(len(s), least), known, rank)
                for column, v in zip(made, (node_of(s), len(s), int((low >> HASH_BITS == 0).sum()), low.view(np.int64)), strict=True):
                    column.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, made, kinds)], names=["doc_id", "text_key", "node", "size", "own", "keys"])

    def members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = told.value
        for batch in batches:
            sets = [shingles(x.as_py(), shingle) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(map(node_of, sets), pa.int64()), pa.array([coded(s, known, rank).tobytes() for s in sets], pa.binary())], names=["node", "s"])

    def exact(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([np.frombuffer(v.as_py(), np.uint64) for v in batch.column(i)] for i in (2, 3))
            good = pa.array([enough(common(p, q), len(p), len(q), least) for p, q in zip(x, y, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], names=["a", "b"])

    made = materialize(in_batches(rows, sketch, "doc_id long, text_key long, node long, size long, own long, keys array<long>"))
    first = F.min(F.struct(order_id("doc_id").alias("o"), F.col("text_key").alias("k")))
    sketched = materialize((made if empty_alike else made.filter("size > 0")).groupBy("node").agg(first.alias("w"), F.first("size").alias("size"), F.first("own").alias("own"), F.first("keys").alias("keys")))
    packed = F.col("size") * 256 + F.floor(F.col("own") * 255 / F.greatest("size", F.lit(1)))  # the size, and the share of values of one's own
    nodes, named_rows = materialize(sketched.drop("keys", "own")), materialize(made.drop("keys", "own"))
    discard(made)
    entries = sketched.select("node", packed.cast("long").alias("p"), F.explode("keys").alias("k"))
    counts = materialize(entries.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    lists = materialize(entries.join(counts, "k").select("k", "node", F.shiftright("p", 8).alias("size"), F.col("p").bitwiseAND(255).alias("own"), "n"))
    discard(counts)
    total, mean = nodes.agg(F.count(F.lit(1)), F.greatest(F.lit(1.0), F.avg("size"))).first()
    upto = paired(*told.value, small)
    crowds = lists.filter(F.col("n") > upto)
    in_crowds = crowds.groupBy("node").agg(F.count(F.lit(1)).alias("crowded"))
    kept_of = lambda n: n + 1 - F.ceil(n * least[0] / F.lit(least[1]))
    rest = lambda n: n - kept_of(n)
    can = lambda x, y: F.least(x, y) * (least[0] + least[1]) >= F.lit(least[0]) * (x + y)
    needed = lambda x, y: F.ceil(F.lit(least[0]) * (x + y) / F.lit(least[0] + least[1])) - F.greatest(rest(x), rest(y))

    def sets_of(some: DataFrame) -> DataFrame:
        """(node, s): the full sets of these nodes, from the texts of one document each."""
        wanted = nodes.join(some.distinct(), "node", "left_semi").select(F.nullif(F.col("w.o"), F.lit(NULL_ID)).alias("doc_id"), F.col("w.k").alias("text_key"))
        return materialize(in_batches(filter_rows(rows, wanted, "left_semi", "doc_id", "t").select("t"), members, "node long, s binary").dropDuplicates(["node"]))

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("node"))

    def linked(pairs: DataFrame) -> DataFrame:
        """Those of the pairs whose full sets are similar enough."""
        sets = sets_of(ends(pairs))
        a, b = (sets.select(F.col("node").alias(c), F.col("s").alias(f"s_{c}")) for c in "ab")
        copied = pairs.join(nodes.select(F.col("node").alias("a"), (F.col("size") / mean).alias("weight")), "a")
        got = _in_passes(copied, ["a", "b"], total // FULL, lambda x: in_batches(x.drop("weight").join(a, "a").join(b, "b").select("a", "b", "s_a", "s_b"), exact, "a long, b long"))
        discard(sets)
        return got

    central = lists.groupBy("k").agg(F.min(F.struct("own", "node", "size")).alias("x"))
    met = lists.join(central, "k").filter((F.col("x.node") != F.col("node")) & can(F.col("size"), F.col("x.size")))
    met = met.groupBy(*_pairs(F.col("x.node"), F.col("node"))).agg(F.count(F.lit(1)).alias("shared"), F.max(needed(F.col("size"), F.col("x.size"))).alias("needed")).filter("shared >= needed").select("a", "b")
    pairs = materialize(met if also is None else met.unionByName(also).distinct())
    roots = components(linked(pairs))
    n_roots = roots.count()
    here = _roots_of(lists, roots, n_roots)
    apart = here.groupBy("k").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("k")
    here = materialize(here.join(apart, "k", "left_semi").join(in_crowds, "node", "left").withColumn("crowded", F.coalesce("crowded", F.lit(0))))
    short = here.filter(F.col("n") <= upto)
    few = short.groupBy("k").agg(F.collect_list(F.struct("root", "node", "size", "crowded")).alias("g"))
    meet = lambda x, y: (x["root"] < y["root"]) & can(x["size"], y["size"])
    pair = lambda x, y: F.struct(F.least(x["node"], y["node"]).alias("a"), F.greatest(x["node"], y["node"]).alias("b"), (needed(x["size"], y["size"]) - F.least(x["crowded"], y["crowded"])).alias("needed"))
    across = F.flatten(F.transform("g", lambda x: F.transform(F.filter("g", lambda y: meet(x, y)), lambda y: pair(x, y))))
    several = lambda x: x.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"), F.max("needed").alias("needed")).filter("shared >= needed").select("a", "b")
    compared = short.agg(F.ceil(F.sum((F.col("n") - 1) / 2))).first()[0] or 0
    more, dense = _passes(few.select(F.explode(across).alias("p")).select("p.*"), ["a", "b"], max(1, -(-compared // (PAIRS * max(1, total)))), several), None
    open_lists = here.filter(F.col("n") > upto)
    if not open_lists.isEmpty():
        before = crowds.groupBy("node").agg(F.array_sort(F.collect_list("k")).alias("all")).select("node", "all", F.posexplode("all").alias("i", "k")).select("node", "k", F.when(F.col("i") > 0, F.col("all")[F.col("i") - 1]).alias("before"))
        crowded = materialize(open_lists.join(before, ["node", "k"]).select("k", "node", "size", "before", "root"))
        met, dense = _blocked(crowded, sketched.select("node", "size", "keys"), sets_of, least, block, total, mean)
        more = more.unionByName(met)
    more = materialize(more.distinct().join(pairs, ["a", "b"], "left_anti"))
    discard(lists, here, sketched)
    links = linked(more)
    links = links if dense is None else links.unionByName(dense)
    if not links.isEmpty():
        roots = components(links.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    named = _roots_of(nodes.select("node", "w"), roots, NULL_ID)
    least_of = named.groupBy("root").agg(F.min("w").alias("c"))
    got = named_rows.join(named.join(least_of, "root").select("node", "c"), "node", "left")
    mine = F.coalesce(F.col("c"), F.struct(order_id("doc_id").alias("o"), F.col("text_key").alias("k")))
    kept = (order_id("doc_id") == mine["o"]) & (F.col("text_key") == mine["k"])
    return got.select("doc_id", "text_key", F.col("size").alias("n_shingles"), F.nullif(mine["o"], F.lit(NULL_ID)).alias("component_id"), kept.alias("kept"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = similar_sets(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP12_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM d),
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 185 * count(*) >= 85 * (a.n + b.n)),
l AS MATERIALIZED (SELECT a, b FROM p UNION SELECT b, a FROM p),
r AS (SELECT a AS node, a AS low FROM l UNION SELECT l.b, r.low FROM r JOIN l ON l.a = r.node WHERE r.low < l.b),
c AS (SELECT node, min(low) AS low FROM r GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(c.low, s.doc_id)) AS component_id, s.doc_id = least(s.doc_id, coalesce(c.low, s.doc_id)) AS kept FROM s LEFT JOIN c ON c.node = s.doc_id
"""
