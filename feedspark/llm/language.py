"""Language identification by a byte convolutional network, trained and applied in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm.common import BROADCAST_KEYS, in_batches, materialize, table, text_of
from feedspark.llm.hashing import P, mix

#: Bytes of a window, of which a text has as many as it needs; size of a byte's vector; filters of each width.
WINDOW, DIM, WIDTHS, FILTERS = 256, 8, (2, 3, 4), 16
#: Different windows of labelled texts that the network is trained on, about this many of each language and of all.
TRAIN_WINDOWS, TRAIN_ALL = 4_000, 200_000
#: Training passes over the sample EPOCHS times, and more often if these are fewer than STEPS batches.
EPOCHS, STEPS, BATCH, RATE, SEED = 6, 500, 64, 0.004, 11
#: A document is rejected if it has no letter, or if its best language has less than this probability.
LEAST_SCORE = 0.3
UNKNOWN = "und"


def byte_windows(data: bytes, size: int = WINDOW) -> np.ndarray:
    """All bytes, A-Z lower-cased, as rows of ``size``, the last one filled up with spaces."""
    data = data.lower() or b" "
    return np.frombuffer(data.ljust(-(-len(data) // size) * size), np.uint8).reshape(-1, size)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Network:
    """Byte vectors, convolutions of several widths, maximum over positions, softmax."""

    languages: list[str]
    vectors: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def new(languages: list[str], seed: int = SEED) -> Network:
        r = np.random.default_rng(seed)
        n, span = FILTERS * len(WIDTHS), max(WIDTHS)
        f = lambda *s, by: (r.standard_normal(s) * by).astype(np.float32)
        net = Network(languages, f(256, DIM, by=0.5), f(span * DIM, n, by=0.25), np.zeros(n, np.float32), f(n, len(languages), by=0.2), np.zeros(len(languages), np.float32))
        net.weights *= net.mask()
        return net

    @staticmethod
    def mask() -> np.ndarray:
        """A filter of width w sees the first w bytes only."""
        return np.concatenate([np.repeat((np.arange(max(WIDTHS) * DIM) < w * DIM)[:, None], FILTERS, 1) for w in WIDTHS], axis=1).astype(np.float32)

    def patches(self, windows: np.ndarray) -> np.ndarray:
        span = max(WIDTHS)
        x = self.vectors[windows].reshape(len(windows), -1)
        n = windows.shape[1] - span + 1
        return np.ascontiguousarray(np.lib.stride_tricks.as_strided(x, (len(windows), n, span * DIM), (x.strides[0], 4 * DIM, 4)))

    def pooled(self, patches: np.ndarray) -> np.ndarray:
        return (patches.reshape(-1, patches.shape[2]) @ self.weights).reshape(*patches.shape[:2], -1)

    def log_probabilities(self, windows: np.ndarray, chunk: int = 16) -> np.ndarray:
        """For each window; in chunks that stay in the processor's cache."""
        hidden = np.concatenate([self.pooled(self.patches(windows[i : i + chunk])).max(axis=1) for i in range(0, len(windows), chunk)])
        z = np.maximum(hidden + self.bias, 0) @ self.out + self.out_bias
        z = z - z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Language and probability of each text: all its windows vote, by their bytes."""
        parts = [byte_windows(t.encode()) if has_letter(t) else None for t in texts]
        known = [p for p in parts if p is not None]
        if not known or not self.languages:
            return [(UNKNOWN, 0.0)] * len(texts)
        score = self.log_probabilities(np.concatenate(known))
        out, at = [], 0
        for text, p in zip(texts, parts, strict=True):
            if p is None:
                out.append((UNKNOWN, 0.0))
                continue
            weight = np.full(len(p), WINDOW, np.float64)
            weight[-1] = (len(text.encode()) - 1) % WINDOW + 1
            z = weight @ score[at : at + len(p)] / weight.sum()
            e = np.exp(z - z.max())
            at += len(p)
            out.append((self.languages[int(e.argmax())], float(e.max() / e.sum())))
        return out


def train(samples: list[tuple[str | bytes, str]], epochs: int = EPOCHS, seed: int = SEED) -> Network:
    """Adam on cross entropy over the samples' windows; (text or its bytes, language)."""
    languages = sorted({lang for _, lang in samples})
    net = Network.new(languages, seed)
    if not languages:
        return net
    x, y, number = [], [], {lang: i for i, lang in enumerate(languages)}
    for text, lang in sorted((t.encode() if isinstance(t, str) else t, lang) for t, lang in samples):
        for w in byte_windows(text):
            x.append(w)
            y.append(number[lang])
    x, y = np.stack(x), np.array(y)
    r, mask = np.random.default_rng(seed), Network.mask()
    span = max(WIDTHS)
    names = ("vectors", "weights", "bias", "out", "out_bias")
    first, second, step = ({n: np.zeros_like(getattr(net, n)) for n in names} for _ in range(2)), None, 0
    first, second = first
    epochs = max(epochs, -(-STEPS // -(-len(x) // BATCH)))
    for epoch in range(epochs):
        order = r.permutation(len(x))
        for i in range(0, len(x), BATCH):
            own = order[i : i + BATCH]
            windows, n = x[own], len(own)
            patches = net.patches(windows)
            conv = net.pooled(patches)
            best = conv.argmax(axis=1)
            hidden = np.take_along_axis(conv, best[:, None], 1)[:, 0] + net.bias
            active = np.maximum(hidden, 0)
            z = active @ net.out + net.out_bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), y[own]] -= 1
            p /= n
            back = (p @ net.out.T) * (hidden > 0)
            at = patches[np.arange(n)[:, None], best]
            gradient = {"out": active.T @ p, "out_bias": p.sum(0), "bias": back.sum(0), "weights": np.einsum("nf,nfk->kf", back, at) * mask}
            down = (back[:, :, None] * net.weights.T[None]).reshape(-1, DIM)
            rows = windows[np.arange(n)[:, None, None], best[:, :, None] + np.arange(span)].reshape(-1)
            gradient["vectors"] = np.zeros_like(net.vectors)
            np.add.at(gradient["vectors"], rows, down)
            step += 1
            rate = RATE * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
            for name, g in gradient.items():
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g * g - second[name])
                setattr(net, name, (getattr(net, name) - rate * first[name] / (np.sqrt(second[name]) + 1e-8)).astype(np.float32))
    return net


def drawn(windows: np.ndarray, share: float) -> np.ndarray:
    """The windows that a hash of their bytes draws; equal windows are all in or all out."""
    h = np.zeros(len(windows), np.uint64)
    for column in np.ascontiguousarray(windows).view(np.uint64).T:
        h = mix(h * P + column)
    return windows[(h >> np.uint64(11)).astype(np.float64) < share * 2.0**53]


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = TRAIN_WINDOWS, in_all: int = TRAIN_ALL) -> Network:
    """Train on a bounded sample: different windows of all labelled texts, about ``per_language`` of each language and ``in_all`` of all.

    Windows are drawn by their hash where the texts are, from all windows of whole texts; only
    the sample, WINDOW bytes a row, comes to the driver, however long the texts are. Every language
    is learned. Rows without a language or a letter are left out, copies count once."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(F.col(text_col).alias("t"), F.col(lang_col).cast("string").alias("lang"))
    texts = rows.groupBy("lang", F.xxhash64("t").alias("h")).agg(F.max(F.ceil(F.octet_length("t") / F.lit(WINDOW))).alias("windows"))
    counts = materialize(texts.groupBy("lang").agg(F.sum("windows").alias("n")))
    languages = counts.count()
    each = min(per_language, max(1, in_all // max(1, languages)))
    shares = counts.select("lang", F.least(F.lit(1.0), F.lit(float(each)) / F.col("n")).alias("share"))
    known = rows.join(F.broadcast(shares) if languages <= BROADCAST_KEYS else shares, "lang").select("t", "lang", "share")

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [drawn(byte_windows(t.as_py().encode()), s.as_py()) for t, s in zip(batch.column(0), batch.column(2), strict=True)]
            at = pa.array(np.repeat(np.arange(len(got)), [len(w) for w in got]), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(1).take(at), pa.array([w.tobytes() for part in got for w in part], pa.binary())], names=["lang", "w"])

    sample = in_batches(known, draw, "lang string, w binary").distinct()
    return train([(bytes(x.w), x.lang) for x in sample.toLocalIterator()])


def identify(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_key, lang_pred, score, has_letter.

    Whole texts: every byte is in a window, of a very long text too, whose windows are scored
    part by part. Null texts and texts without a letter: 'und', score 0; likewise all texts if
    the network knows no language. Rows that repeat are judged alike; of equally probable
    languages the first by name. Empty table: no rows. Other columns, among them any label,
    are not read."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("text_key"), F.col(text_col).alias("t"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            got: list[tuple[str, float]] = []
            held, size = [], 0
            for x in batch.column(2):
                held.append(x.as_py())
                size += len(held[-1] or "")
                if size > 500_000:
                    got += net.predict(held)
                    held, size = [], 0
            got += net.predict(held)
            letters = pa.array([has_letter(x.as_py()) for x in batch.column(2)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), letters], names=["doc_id", "text_key", "lang_pred", "score", "has_letter"])

    return in_batches(rows, run, "doc_id long, text_key long, lang_pred string, score double, has_letter boolean")


def rejected(network: Network) -> Column:
    """Without a letter, or of no language with any certainty; a network that knows no language rejects only the first."""
    return ~F.col("has_letter") | ((F.col("score") < LEAST_SCORE) if network.languages else F.lit(False))


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that nothing is learned from; a null identifier is not in it."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = fit(docs.filter(~held_out()))
    return identify(docs, network).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
