"""Token-id output as sorted-string-table shards.

A shard holds documents in ascending order of their key (eight bytes, big-endian, sign bit
flipped, so that bytes sort as numbers). Layout: data blocks, then a Bloom filter, then the
index, then a footer of fixed size.

* Data block: zstd of entries ``varint shared, varint rest, varint size, key bytes, ids``.
  A key drops the prefix that it shares with the key before it. Ids are unsigned 16-bit
  where every id of the vocabulary fits, else 32-bit.
* Index (sparse: a row for each block): last key, offset, stored size, first entry's number.
* Bloom filter: ten bits a key, seven probes by double hashing.
* Footer: offsets and sizes, entry and id counts, the ids' width, checksum, magic."""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedspark.llm.common import in_batches, order_id, partitions, shared_dir, text_of, tie_of
from feedspark.llm.encoding import encoded

MAGIC = b"FSSTAB01"
FOOTER = struct.Struct("<QQQQQQBI8s")
BLOCK_BYTES = 256 * 1024
#: Text of one shard, about.
SHARD_BYTES = 256 << 20
BITS_PER_KEY, PROBES = 10, 7
MANIFEST = "shard int, file string, first_key long, last_key long, n_docs long, n_ids long"


def key_of(doc_id: int) -> bytes:
    return ((doc_id + 2**63) % 2**64).to_bytes(8, "big")


def id_of(key: bytes) -> int:
    return int.from_bytes(key, "big") - 2**63


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(buf: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = buf[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _probes(key: bytes, bits: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & (2**64 - 1), h >> 64 | 1
    return [(a + i * b) % bits for i in range(PROBES)]


class ShardWriter:
    """Writes one shard; ``add`` takes keys in ascending order. Memory: one block, index, keys."""

    def __init__(self, out, width: int):
        self.out, self.width, self.at = out, width, 0
        self.block, self.last, self.keys, self.index, self.n_ids, self.first = bytearray(), b"", [], [], 0, 0
        self.zstd = zstandard.ZstdCompressor(level=1)

    def _put(self, data: bytes) -> tuple[int, int]:
        at = self.at
        self.out.write(data)
        self.at += len(data)
        return at, len(data)

    def add(self, key: bytes, ids: np.ndarray) -> None:
        shared = 0
        if self.block:
            while shared < len(key) and key[shared : shared + 1] == self.last[shared : shared + 1]:
                shared += 1
        value = ids.astype("<u2" if self.width == 2 else "<u4").tobytes()
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.last = key
        self.keys.append(key)
        self.n_ids += len(ids)
        if len(self.block) >= BLOCK_BYTES:
            self._flush()

    def _flush(self) -> None:
        if self.block:
            at, size = self._put(self.zstd.compress(bytes(self.block)))
            self.index.append((self.last, at, size, self.first))
            self.block, self.first = bytearray(), len(self.keys)

    def close(self) -> None:
        self._flush()
        bits = max(64, BITS_PER_KEY * len(self.keys))
        bloom = np.zeros(bits // 8 + 1, np.uint8)
        for key in self.keys:
            for p in _probes(key, bits):
                bloom[p >> 3] |= 1 << (p & 7)
        bloom_at, _ = self._put(struct.pack("<Q", bits) + bloom.tobytes())
        body = b"".join(struct.pack("<B", len(k)) + k + struct.pack("<QQQ", at, size, first) for k, at, size, first in self.index)
        index_at, index_size = self._put(body)
        self._put(FOOTER.pack(bloom_at, index_at, index_size, len(self.index), len(self.keys), self.n_ids, self.width, zlib.crc32(body), MAGIC))


class ShardReader:
    """Reads a shard by ranges: the footer and index at once, blocks when they are asked for."""

    def __init__(self, file):
        self.file = file
        file.seek(file.size() - FOOTER.size)
        self.bloom_at, self.index_at, size, n, self.n_docs, self.n_ids, self.width, crc, magic = FOOTER.unpack(file.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard: wrong magic")
        file.seek(self.index_at)
        body = file.read(size)
        if zlib.crc32(body) != crc:
            raise ValueError("the shard's index is damaged")
        self.index, at = [], 0
        for _ in range(n):
            k = body[at]
            self.index.append((body[at + 1 : at + 1 + k], *struct.unpack_from("<QQQ", body, at + 1 + k)))
            at += 25 + k
        self.last_keys = [x[0] for x in self.index]
        self.bloom: tuple[int, bytes] | None = None

    def may_hold(self, key: bytes) -> bool:
        if self.bloom is None:
            self.file.seek(self.bloom_at)
            raw = self.file.read(self.index_at - self.bloom_at)
            self.bloom = struct.unpack_from("<Q", raw)[0], raw[8:]
        bits, held = self.bloom
        return all(held[p >> 3] >> (p & 7) & 1 for p in _probes(key, bits))

    def block(self, i: int) -> Iterator[tuple[bytes, np.ndarray]]:
        _, at, size, _ = self.index[i]
        self.file.seek(at)
        buf, at, key = zstandard.ZstdDecompressor().decompress(self.file.read(size)), 0, b""
        while at < len(buf):
            shared, at = _read_varint(buf, at)
            rest, at = _read_varint(buf, at)
            size, at = _read_varint(buf, at)
            key = key[:shared] + buf[at : at + rest]
            at += rest
            yield key, np.frombuffer(buf, "<u2" if self.width == 2 else "<u4", size // self.width, at)
            at += size

    def entries(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for i in range(len(self.index)):
            yield from self.block(i)

    def get(self, key: bytes) -> list[np.ndarray]:
        """All entries of the key, by Bloom filter, binary search in the index, and one or more blocks."""
        found: list[np.ndarray] = []
        if not self.may_hold(key):
            return found
        for i in range(bisect_left(self.last_keys, key), len(self.index)):
            for k, ids in self.block(i):
                if k == key:
                    found.append(ids)
                elif k > key:
                    return found
        return found


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write_token_shards(docs: DataFrame, tokenizer_path: str, end_id: int | None, out: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: int = 50_257, shards: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the ids of every text to shards below ``out``; return their manifest (a row for each shard).

    Documents are dealt to shards by ranges of identifier and text hash, so that an identifier
    that many rows have (null, say) is no shard of its own, and are sorted inside: shards in
    order hold all documents in order. There are as many as shuffle partitions, and more where
    a shard would hold over ``shard_bytes`` of text. A task writes to a name of its own; the
    manifest, which Spark commits, names the file of the attempt that succeeded.

    Null text: only the end id. Null identifier: sorts last, as the largest key. Repeated
    identifiers: every row is an entry, ordered by the text's hash. Empty table: no shard.
    Other columns are not read. A text's length is bounded by memory for one text only."""
    spark = docs.sparkSession
    width = 2 if max(vocabulary, (end_id or 0) + 1) <= 65_536 else 4

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        store, base = _filesystem(out)
        name = f"shard-{ctx.partitionId():06d}-{ctx.taskAttemptId()}.sst"
        keys: list[int] = []
        writer = sink = None
        tail = np.array([] if end_id is None else [end_id], "<u4").tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                store.create_dir(base, recursive=True)
                sink = store.open_output_stream(f"{base}/{name}")
                writer = ShardWriter(sink, width)
            ids = batch.column(0).to_pylist()
            for doc_id, got in zip(ids, encoded(batch.column(1), tokenizer_path), strict=True):
                writer.add(key_of(doc_id), np.frombuffer(got + tail, "<u4"))
            keys = [*keys[:1], ids[0], ids[-1]]
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([ctx.partitionId()], pa.int32()), "file": [name], "first_key": [keys[0]], "last_key": [keys[-1]], "n_docs": [len(writer.keys)], "n_ids": [writer.n_ids]})

    rows = docs.select(order_id(id_col).alias("k"), text_of(text_col).alias("t"), tie_of(text_col).alias("h"))
    if shards is None:
        size = docs.agg(F.sum(F.octet_length(text_col).cast("long"))).first()[0] or 0
        shards = max(partitions(spark), -(-size // shard_bytes))
    done = in_batches(rows.repartitionByRange(shards, "k", "h").sortWithinPartitions("k", "h", "t"), write, MANIFEST)
    done.write.parquet(f"{out}/manifest")
    return spark.read.schema(done.schema).parquet(f"{out}/manifest")


def read_token_shards(spark: SparkSession, out: str) -> DataFrame:
    """Every entry of the shards: doc_id, start (ids of all entries before it), ids (unsigned 32-bit, little-endian)."""
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    manifest = spark.read.parquet(f"{out}/manifest").withColumn("base", before)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(out)
        names = ("doc_id", "start", "ids")
        for batch in batches:
            for row in batch.to_pylist():
                with store.open_input_file(f"{base}/{row['file']}") as f:
                    at, held, size = row["base"], ([], [], []), 0
                    for key, ids in ShardReader(f).entries():
                        for col, x in zip(held, (id_of(key), at, ids.astype("<u4").tobytes()), strict=True):
                            col.append(x)
                        at += len(ids)
                        size += len(ids)
                        if size > 1_000_000:
                            yield pa.RecordBatch.from_arrays([pa.array(held[0], pa.int64()), pa.array(held[1], pa.int64()), pa.array(held[2], pa.binary())], names=names)
                            held, size = ([], [], []), 0
                    if held[0]:
                        yield pa.RecordBatch.from_arrays([pa.array(held[0], pa.int64()), pa.array(held[1], pa.int64()), pa.array(held[2], pa.binary())], names=names)

    n = partitions(spark)
    return manifest.repartition(n, "shard").select("file", "base").mapInArrow(read, "doc_id long, start long, ids binary")


def lookup(spark: SparkSession, out: str, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The entries of the wanted identifiers: doc_id, ids. Opens only shards whose range holds a key.

    The manifest (a row for each shard) gives the shard by a range join; a shard's keys are
    looked up by Bloom filter and binary search. An identifier in several entries gives
    several rows; one in none gives none."""
    manifest = F.broadcast(spark.read.parquet(f"{out}/manifest").select("file", "first_key", "last_key"))
    keys = wanted.select(order_id(id_col).alias("k")).distinct()
    routed = keys.join(manifest, (keys.k >= manifest.first_key) & (keys.k <= manifest.last_key)).select("file", "k")

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _filesystem(out)
        name, reader = None, None
        for batch in batches:
            ids, values = [], []
            for file, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if file != name:
                    name, reader = file, ShardReader(store.open_input_file(f"{base}/{file}"))
                for got in reader.get(key_of(k)):
                    ids.append(k)
                    values.append(got.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(values, pa.binary())], names=["doc_id", "ids"])

    return routed.repartition("file").sortWithinPartitions("file", "k").mapInArrow(find, "doc_id long, ids binary")


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from feedspark.llm.common import table

    out = shared_dir(spark)
    write_token_shards(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2, out)
    got = read_token_shards(spark, out)
    return got.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
