"""Embedding whitening: spectral divide and conquer by QDWH polar decompositions.

1. Entries become integers; the fit list is each distinct vector once (one shuffle, repeats
   are combined before it).
2. Tasks sum the vectors, then the products of vectors that are centred at the rounded mean.
   All are integers, so the covariance is exact until it is rounded once.
3. The d x d covariance is split on the driver: the polar factor U of V - shift gives the
   projector (U + I) / 2 on the eigenvalues above the shift, bases of its range and of the
   complement give two smaller symmetric matrices, and so on down to single components.
4. Components, d numbers each, go to the tasks, which project all rows. One more pass over
   the fit list measures how far the whitened covariance is from the identity."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm.common import in_batches, materialize, table

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
#: Components of an eigenvalue of at most this share of the largest one are noise of the arithmetic.
NEGLIGIBLE = 1e-10
#: Integers that are below this in size have products whose sums over a batch fit 64 bits.
SMALL_INT = 1 << 22
EPS = float(np.finfo(float).eps)
DIGITS = 10**18


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QR-based dynamically weighted Halley steps."""
    size = np.linalg.norm(a)
    if size == 0:
        return np.eye(len(a))
    x, eye = a / size, np.eye(len(a))
    low = max(EPS, 0.9 / (np.linalg.norm(np.linalg.pinv(x, rcond=EPS), 2) or 1))
    for _ in range(40):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square**2)
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack((np.sqrt(wc) * x, eye)))[0]
        step = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[: len(a)] @ q[len(a) :].T
        step = (step + step.T) / 2
        moved, x = np.linalg.norm(step - x), step
        low = min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if moved <= np.cbrt(EPS) * 0.1 and abs(low - 1) < 1e-8:
            break
    return x


def _basis(p: np.ndarray, rank: int, r: np.random.Generator) -> np.ndarray:
    """An orthonormal basis of a projector's range: two steps of subspace iteration."""
    q = np.linalg.qr(p @ r.standard_normal((len(p), rank)))[0]
    return np.linalg.qr(p @ q)[0]


def split(a: np.ndarray, scale: float, r: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces, larger eigenvalues first; None where no shift parts the eigenvalues."""
    d, best = len(a), (np.inf, None)
    diagonal = np.sort(np.diag(a))
    radius = np.linalg.norm(a - np.eye(d) * np.trace(a) / d)
    shifts = [float(np.median(diagonal)), float(np.mean(diagonal)), *(float(np.trace(a) / d + radius * t) for t in r.uniform(-0.5, 0.5, 24))]
    for shift in shifts:
        p = (polar(a - shift * np.eye(d)) + np.eye(d)) / 2
        rank = round(float(np.trace(p)))
        if not 0 < rank < d:
            continue
        up, down = _basis(p, rank, r), _basis(np.eye(d) - p, d - rank, r)
        both = np.linalg.qr(np.hstack((up, down)))[0]
        up, down = both[:, :rank], both[:, rank:]
        left = float(np.linalg.norm(down.T @ a @ up))
        if left < best[0]:
            best = left, (up, down)
        if left <= 4 * d * EPS * scale:
            break
    return best[1]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, by recursive splitting."""
    scale, r = float(np.linalg.norm(a)), np.random.default_rng(0)
    todo, done = [(a, np.eye(len(a)))], []
    while todo:
        b, q = todo.pop()
        b = (b + b.T) / 2
        mean = float(np.trace(b)) / len(b)
        if len(b) == 1 or np.linalg.norm(b - mean * np.eye(len(b))) <= EPS * scale:
            done += [(float(v @ a @ v), v) for v in q.T]
            continue
        parts = split(b, scale, r)
        if parts is None:
            done += [(float(v @ a @ v), v) for v in q.T]
            continue
        todo += [(v.T @ b @ v, q @ v) for v in parts]
    done.sort(key=lambda x: -x[0])
    return np.array([e for e, _ in done]), np.array([v for _, v in done]).reshape(len(done), len(a)).T


def usable(vector: str) -> Column:
    """True for vectors that are there and hold finite numbers only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def _padded(column: pa.Array, d: int, dtype: type) -> np.ndarray:
    """Rows of a list column; missing last entries are zero."""
    lists, at = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, 0
    flat, lengths = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
    if len(lengths) and (lengths == d).all():
        return flat.reshape(-1, d).astype(dtype)
    out = np.zeros((len(lengths), d), dtype)
    for i, k in enumerate(lengths.tolist()):
        out[i, :k] = flat[at : at + k]
        at += k
    return out


def _exact(x: np.ndarray) -> np.ndarray:
    """Integers as they are while products of them fit 64 bits, else as Python's."""
    return x if not x.size or int(np.abs(x).max()) < SMALL_INT else x.astype(object)


def _deltas(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact."""
    wide = x.size and (int(np.abs(x).max()) + 1) * n + max(map(abs, sums)) >= 1 << 62
    return x.astype(object) * n - np.array(sums, object) if wide else x * n - np.array(sums, np.int64)


def summed(df: DataFrame, run: Callable[[np.ndarray], np.ndarray], d: int) -> list:
    """Sums over all rows of the fit list of each place of ``run``'s result for a batch of vectors.

    Integers stay exact at any size: they are handed on by a task as two decimals, 18 digits and the rest."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | int = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                got = run(_padded(batch.column(0).slice(at, 4096), d, np.int64)).ravel()
                total = total + (got if got.dtype.kind == "f" else got.astype(object))
        if not isinstance(total, int):
            whole = total.dtype == object
            high, low = zip(*(divmod(v, DIGITS) if whole else (None, None) for v in total), strict=True)
            part = np.zeros(len(total)) if whole else total
            yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(total)), pa.int32()), "high": pa.array(high, pa.decimal128(38, 0)), "low": pa.array(low, pa.decimal128(38, 0)), "part": pa.array(part)})

    each = in_batches(df, work, "place int, high decimal(38,0), low decimal(38,0), part double")
    got = each.groupBy("place").agg(F.sum("high").alias("h"), F.sum("low").alias("l"), F.sum("part").alias("p")).collect()
    return [r.p if r.h is None else int(r.h) * DIGITS + int(r.l) for r in sorted(got, key=lambda r: r.place)]


@dataclass
class Whitening:
    """n distinct vectors and their sums; components (columns), eigenvalues, their shares of the trace, and the measured distance from the identity."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    error: float | None

    def project(self, x: np.ndarray) -> np.ndarray:
        return (_deltas(x, self.n, self.sums) / self.n).astype(float) @ self.vectors / np.sqrt(self.values)


def integers(vector: str) -> Column:
    """floor(64 * entry) + 1,000,000 as long, entries as double; results beyond 2^60 in size are held there."""
    most = float(1 << 60)
    return F.transform(vector, lambda c: F.greatest(F.least(F.floor(c.cast("double") * SCALE).cast("double"), F.lit(most)), F.lit(-most)).cast("long") + OFFSET)


def fit(vectors: DataFrame, count: int = COMPONENTS) -> Whitening | None:
    """The whitening of a table of distinct integer vectors (x). Sent to the driver: d sums, d * (d + 1) / 2 products, and as many errors; None without any entry."""
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).first()
    n, d = shape.n, shape.d or 0
    if not n or not d:
        return None
    sums = summed(vectors, lambda x: x.astype(object).sum(axis=0) if int(np.abs(x).max()) > 1 << 48 else x.sum(axis=0), d)
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    upper = np.triu_indices(d)

    def products(x: np.ndarray) -> np.ndarray:
        c = _exact(x - centre)
        both = c.T @ c if c.dtype == object or int(np.abs(c).max()) ** 2 * len(c) >= 1 << 52 else (c.astype(float).T @ c.astype(float)).astype(np.int64)
        return both[upper]

    got, rest = summed(vectors, products, d), [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    v = np.zeros((d, d))
    for at, (i, j) in enumerate(zip(*map(np.ndarray.tolist, upper), strict=True)):
        v[i, j] = v[j, i] = (n * got[at] - rest[i] * rest[j]) / n**2
    values, components = eigen(v)
    kept = [i for i in range(min(count, d)) if values[i] > NEGLIGIBLE * values[0]]
    out = Whitening(n, sums, components[:, kept], values[kept], values[kept] / (np.trace(v) or 1), None)
    if kept:
        k = len(kept)

        def moments(x: np.ndarray) -> np.ndarray:
            w = out.project(x)
            return np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))

        got = summed(vectors, moments, d)
        mean, second = np.array(got[:k]) / n, np.array(got[k:]).reshape(k, k) / n
        out.error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())
    return out


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """For each usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries are left out. Repeated vectors
    count once in the fit and get a result each; null ids are kept. Shorter vectors are filled
    with zeros. Components of an eigenvalue of at most NEGLIGIBLE times the largest have no
    result: none of fewer than two distinct vectors, nor of empty ones. A deviation beyond 64
    bits is held at their largest number. Empty table: no rows. Other columns are not read."""
    own = rows.filter(usable(vector_col)).select(F.col(id_col).cast("long").alias("vec_id"), integers(vector_col).alias("x"))
    own = materialize(own)
    made = fit(materialize(own.select("x").distinct()), count)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = (len(made.values), len(made.sums)) if made else (0, 0)
        for batch in batches:
            for at in range(0, batch.num_rows if k else 0, 4096):
                part = batch.slice(at, 4096)
                x = _padded(part.column(1), d, np.int64)
                off = _deltas(x, made.n, made.sums)
                if off.dtype != object and int(np.abs(off).max()) >= 1 << 28:
                    off = off.astype(object)
                deviation = [min(int(v), 2**63 - 1) for v in (off * off).sum(axis=1)]
                m = part.num_rows
                yield pa.RecordBatch.from_pydict({
                    "vec_id": part.column(0).take(pa.array(np.repeat(np.arange(m), k))), "component": pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), "n": pa.array(np.full(m * k, made.n)),
                    "deviation": pa.array(np.repeat(np.array(deviation, np.int64), k)), "whitened": pa.array(made.project(x).ravel()), "explained": pa.array(np.tile(made.explained, m)), "identity_error": pa.array(np.full(m * k, made.error)),
                })

    return in_batches(own, run, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
