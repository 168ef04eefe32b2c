"""Token ids in sorted-string-table shards: documents by key in prefix-compressed blocks, a sparse index, a Bloom filter, a footer.

A shard file:
    blocks    entries (shared, own, value length) as varints, the key's own end, the value; a block is about BLOCK bytes
    index     for each block: key length, last key, place, length, number of entries, number of ids
    filter    Bloom filter of the keys
    footer    places and lengths of index and filter, entries, ids' bytes, MAGIC
Keys are 9 bytes: 0 for a null id, else 1, then the id, big-endian with its sign bit turned, so byte order is id order.
A shard ends at SHARD_BYTES or SHARD_KEYS, so neither writing nor reading one grows with the input.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh_dir, open_fs, small, small_batches
from .tokens import default_path, encoder

MAGIC = b"TMSST001"
BLOCK = 1 << 18
#: A shard is closed at so many bytes or documents; a task writes shards for about TASK_BYTES of text and reads blocks of READ_BYTES.
SHARD_BYTES, SHARD_KEYS = 128 << 20, 1 << 20
TASK_BYTES, READ_BYTES = 512 << 20, 32 << 20
BITS, PROBES = 10, 7
FOOTER = struct.Struct("<QQQQQB8s")


def to_key(doc_id: int | None) -> bytes:
    return b"\0" * 9 if doc_id is None else b"\1" + struct.pack(">Q", (doc_id + (1 << 63)))


def from_key(key: bytes) -> int | None:
    return None if key[0] == 0 else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(b: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        x = b[at]
        at += 1
        n |= (x & 127) << shift
        if x < 128:
            return n, at
        shift += 7


def _hashes(key: bytes) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(key)
    return h >> 64, h & (1 << 64) - 1 | 1


def _bloom_bits(a: int, b: int, size: int) -> list[int]:
    return [(a + i * b) % size for i in range(PROBES)]


class ShardWriter:
    """Takes (key, ids as little-endian unsigned 32-bit) by rising key; keeps only a block, the index and the keys' hashes in memory."""

    def __init__(self, out, width: int):
        self.out, self.width, self.at = out, width, 0
        self.block, self.entries, self.ids, self.last = bytearray(), 0, 0, b""
        self.index, self.hashes, self.n, self.n_ids = bytearray(), array("Q"), 0, 0

    def add(self, key: bytes, raw: bytes) -> None:
        value = np.frombuffer(raw, "<u4").astype("<u2").tobytes() if self.width == 2 else raw
        shared = 0
        if self.entries:
            while shared < len(key) and key[shared] == self.last[shared]:
                shared += 1
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.entries += 1
        self.ids += len(raw) // 4
        self.n += 1
        self.n_ids += len(raw) // 4
        if key != self.last or self.n == 1:
            self.hashes.extend(_hashes(key))
        self.last = key
        if len(self.block) >= BLOCK:
            self._flush()

    def _flush(self) -> None:
        if self.entries:
            self.out.write(bytes(self.block))
            self.index += _varint(len(self.last)) + self.last + _varint(self.at) + _varint(len(self.block)) + _varint(self.entries) + _varint(self.ids)
            self.at += len(self.block)
            self.block, self.entries, self.ids = bytearray(), 0, 0

    @property
    def full(self) -> bool:
        return self.at + len(self.block) >= SHARD_BYTES or self.n >= SHARD_KEYS

    def close(self) -> None:
        self._flush()
        size = max(64, len(self.hashes) // 2 * BITS)
        bits = np.zeros(size + 7 >> 3, np.uint8)
        for a, b in zip(self.hashes[::2], self.hashes[1::2]):
            for i in _bloom_bits(a, b, size):
                bits[i >> 3] |= 1 << (i & 7)
        bloom = struct.pack("<Q", size) + bits.tobytes()
        self.out.write(bytes(self.index) + bloom + FOOTER.pack(self.at, len(self.index), self.at + len(self.index), len(bloom), self.n, self.width, MAGIC))


def read_block(file, place: int, length: int, width: int):
    """(key, ids as little-endian unsigned 32-bit) of a block's entries."""
    b, at, key = file.read_at(length, place), 0, b""
    while at < length:
        shared, at = _read_varint(b, at)
        own, at = _read_varint(b, at)
        size, at = _read_varint(b, at)
        key, at = key[:shared] + b[at : at + own], at + own
        value, at = b[at : at + size], at + size
        yield key, np.frombuffer(value, "<u2").astype("<u4").tobytes() if width == 2 else value


class Shard:
    """Reads a shard through its footer, index and filter."""

    def __init__(self, uri: str):
        self.fs, self.path = open_fs(uri)
        self.file = self.fs.open_input_file(self.path)
        end = self.file.size()
        i_at, i_len, b_at, b_len, self.n, self.width, magic = FOOTER.unpack(self.file.read_at(FOOTER.size, end - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri}: no token shard")
        raw, at, self.blocks = self.file.read_at(i_len, i_at), 0, []
        while at < len(raw):
            n, at = _read_varint(raw, at)
            key, at = raw[at : at + n], at + n
            place, at = _read_varint(raw, at)
            length, at = _read_varint(raw, at)
            _, at = _read_varint(raw, at)
            n_ids, at = _read_varint(raw, at)
            self.blocks.append((key, place, length, n_ids))
        self.bloom_at, self.bloom_len = b_at, b_len

    def block(self, k: int):
        _, place, length, _ = self.blocks[k]
        return read_block(self.file, place, length, self.width)

    def may_hold(self, key: bytes) -> bool:
        bloom = self.file.read_at(self.bloom_len, self.bloom_at)
        (size,) = struct.unpack_from("<Q", bloom)
        return all(bloom[8 + (i >> 3)] >> (i & 7) & 1 for i in _bloom_bits(*_hashes(key), size))

    def close(self) -> None:
        self.file.close()

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of all documents of this id: filter, binary search in the index, then the blocks that can hold it."""
        from bisect import bisect_left

        key, out = to_key(doc_id), []
        if self.may_hold(key):
            for k in range(bisect_left(self.blocks, (key,)), len(self.blocks)):
                got = [(x, v) for x, v in self.block(k) if x >= key]
                out += [np.frombuffer(v, "<u4") for x, v in got if x == key]
                if got and got[-1][0] > key:
                    break
        return out


SHARD = "file string, place long, first_key binary, n_docs long, n_ids long"


def write_shards(docs: DataFrame, folder: str, path: str | None = None, end_id: int = 2) -> DataFrame:
    """Writes shards for each range of doc_ids; returns their table, SHARD, written once: place tells their order.

    Rows of one doc_id, and those without, are in the order of their texts' hashes and may go to several tasks. A task
    writes under names of its own, so a repeated or doubled task leaves files that no row names.
    """
    spark = docs.sparkSession

    def write(batches):
        enc, end = encoder(path or default_path()), np.array([end_id], "<u4").tobytes()
        width = 2 if enc.n_ids <= 1 << 16 and end_id < 1 << 16 else 4
        fs, base = open_fs(folder)
        task, nth = TaskContext.get().partitionId(), 0
        writer = out = name = first = None

        def closed():
            writer.close()
            out.close()
            return pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "place": [(task << 32) + nth], "first_key": pa.array([first], pa.binary()), "n_docs": [writer.n], "n_ids": [writer.n_ids]})

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1))):
                if writer is not None and writer.full:
                    yield closed()
                    writer, nth = None, nth + 1
                if writer is None:
                    fs.create_dir(base, recursive=True)
                    first, name = to_key(doc), f"{uuid.uuid4().hex}.sst"
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                    writer = ShardWriter(out, width)
                writer.add(to_key(doc), ids.tobytes() + end)
        if writer is not None:
            yield closed()

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    # rows that share doc_id and text may be many: their place in the table parts them
    dealt = docs.select("doc_id", "text", F.xxhash64("text").alias("key"), F.monotonically_increasing_id().alias("nth")).repartitionByRange(n, "doc_id", "key", "nth").sortWithinPartitions("doc_id", "key", "nth")
    with small_batches(spark, 2000):
        return cut(dealt.select("doc_id", "text").mapInArrow(write, SHARD))


def read_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every entry of all shards, by reading the files; start counts over the shards in key order.

    Footers and indexes tell the blocks and how many ids come before each; stretches of READ_BYTES are read apart.
    """
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("before"))  # a row a shard
    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def index(batches):
        for batch in batches:
            for file, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard, starts = Shard(file), []
                for *_, n_ids in shard.blocks:
                    starts.append(at)
                    at += n_ids
                k = len(starts)
                columns = [[file] * k, [b[1] for b in shard.blocks], [b[2] for b in shard.blocks], [shard.width] * k, starts]
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["file", "at", "length", "width", "start"])
                shard.close()

    def scan(batches):
        name = f = None
        for batch in batches:
            for file, place, length, width, at in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "length", "width", "start"))):
                if file != name:
                    if f is not None:
                        f.close()
                    fs, path = open_fs(file)
                    name, f = file, fs.open_input_file(path)
                out = ([], [], [], [])
                for key, raw in read_block(f, place, length, width):
                    for to, x in zip(out, (from_key(key), at, len(raw) // 4, zlib.crc32(raw))):
                        to.append(x)
                    at += len(raw) // 4
                yield _rows(out)

    blocks = placed.repartition(n, "file").mapInArrow(index, "file string, at long, length long, width long, start long")
    blocks = blocks.withColumn("near", F.floor(F.col("at") / READ_BYTES)).repartition(n, "file", "near").sortWithinPartitions("file", "at")
    return blocks.select("file", "at", "length", "width", "start").mapInArrow(scan, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _rows(cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])


def lookup(shards: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids of the documents of ids(doc_id): each id goes to the shards whose range can hold it."""
    spans = shards.select("file", "first_key", F.lead("first_key").over(Window.orderBy("place")).alias("next_key"))
    key = F.when(F.col("doc_id").isNull(), F.unhex(F.lit("00" * 9))).otherwise(F.unhex(F.concat(F.lit("01"), F.lpad(F.hex(F.col("doc_id").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))))
    asked = ids.select("doc_id").distinct().withColumn("key", key)
    met = asked.join(small(cut(spans)), (F.col("key") >= F.col("first_key")) & (F.col("next_key").isNull() | (F.col("key") <= F.col("next_key"))))

    def find(batches):
        shard = None
        for batch in batches:
            for doc, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if shard is None or shard[0] != file:
                    shard = file, Shard(file)
                if got := shard[1].get(doc):
                    yield pa.RecordBatch.from_arrays([pa.array([doc] * len(got), pa.int64()), pa.array([len(g) for g in got], pa.int64()), pa.array([g.astype("int64").tolist() for g in got], pa.list_(pa.int64()))], ["doc_id", "n_tokens", "ids"])

    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return met.select("doc_id", "file").repartition(n, "file").sortWithinPartitions("file", "doc_id").mapInArrow(find, "doc_id long, n_tokens long, ids array<long>")


def encoded(docs: DataFrame, path: str | None = None, end_id: int = 2) -> DataFrame:
    """Writes all documents and reads them back: doc_id, start, n_tokens, ids_crc32.

    A null or empty text is the end id alone; null doc_ids come first; repeated ids lie side by side, by their texts'
    hashes, then texts; an empty table writes no file and gives no row. Texts of any length are encoded whole; docs'
    other columns play no part, whatever their names. Ranges of doc_ids are sampled, so no task gets more than its share.
    """
    return read_shards(write_shards(docs, fresh_dir(docs.sparkSession, "tokens"), path, end_id))
