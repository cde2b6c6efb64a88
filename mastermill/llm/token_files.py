"""Token ids in binary files with a fixed number of bits per id.

A shard holds documents in ascending doc_id order (null first, then by text), one shard per range of doc_id, numbered in that order:

    magic | bits u32 | ids per block u32 | ids u64 | documents u64
    blocks: ids in ``bits`` bits each, lowest bit first, every block filled up to 8 bytes
    block offsets u64[blocks + 1] | doc_ids i64[documents] | doc_id present u8[documents] | starts u64[documents + 1]
    position of the block offsets u64 | magic

``bits`` is the least number that holds every id of the vocabulary. A reader unpacks any range of ids from the blocks that
hold it. Files get names that no other attempt uses; the manifest, which Spark commits once, names those that count, so a lost or
repeated task leaves at most a file that nothing refers to. The folder must be one that pyarrow opens (a path,
``file:``, ``hdfs:``, ``s3:``, ``gs:``).

Defined results: null and empty texts are the end id alone. Repeated rows are written each. Columns other than doc_id and text
are not read. An empty table gives an empty manifest.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mastermill.session import new_work_path

from .common import opened, stored
from .tokens import encoder

MAGIC = b"IDBITS01"
HEAD = struct.Struct("<8sIIQQ")
BLOCK_IDS = 1 << 16
RANGE_IDS = 1 << 20


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """The ids in ``bits`` bits each, filled up to a multiple of 8 bytes."""
    if bits in (8, 16, 32):
        data = ids.astype(f"<u{bits // 8}").tobytes()
    else:
        each = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
        data = np.packbits(each.ravel(), bitorder="little").tobytes()
    return data + bytes(-len(data) % 8)


def unpack_bits(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    each = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little").reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, :bits] = each
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").ravel().astype(np.uint32)


class ShardWriter:
    def __init__(self, path: str, bits: int):
        system, name = opened(path)
        system.create_dir(name.rpartition("/")[0], recursive=True)
        self.out, self.bits = system.open_output_stream(name), bits
        self.out.write(HEAD.pack(MAGIC, 0, 0, 0, 0))  # the counts stand in the trailer
        self.offsets, self.doc_ids, self.present, self.sizes = [HEAD.size], [], [], []
        self.waiting, self.n_waiting = [], 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id or 0)
        self.present.append(doc_id is not None)
        self.sizes.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK_IDS:
            joined = np.concatenate(self.waiting)
            whole = len(joined) // BLOCK_IDS * BLOCK_IDS
            for at in range(0, whole, BLOCK_IDS):
                self._block(joined[at : at + BLOCK_IDS])
            self.waiting, self.n_waiting = [joined[whole:]], len(joined) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = pack_bits(ids, self.bits)
        self.out.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def close(self) -> tuple[int, int]:
        """Documents and ids of the shard."""
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        starts = np.concatenate([[0], np.cumsum(self.sizes, dtype=np.int64)]).astype("<u8")
        for part in (np.array(self.offsets, "<u8"), np.array(self.doc_ids, "<i8"), np.array(self.present, np.uint8), starts):
            self.out.write(part.tobytes())
        self.out.write(struct.pack("<Q", self.offsets[-1]) + HEAD.pack(MAGIC, self.bits, BLOCK_IDS, int(starts[-1]), len(self.sizes)))
        self.out.close()
        return len(self.sizes), int(starts[-1])


class ShardReader:
    """Random access to a shard: ``document(k)`` and ``ids(start, stop)`` read only the blocks that they need."""

    def __init__(self, path: str):
        system, name = opened(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        tail = self.file.read_at(8 + HEAD.size, size - 8 - HEAD.size)
        table = struct.unpack("<Q", tail[:8])[0]
        magic, self.bits, self.block, self.n_ids, self.n_docs = HEAD.unpack(tail[8:])
        if magic != MAGIC:
            raise ValueError(f"{path} is not a file of token ids")
        data = self.file.read_at(size - 8 - HEAD.size - table, table)
        n = self.n_docs
        blocks = -(-self.n_ids // self.block)
        at = 8 * (blocks + 1)
        self.offsets = np.frombuffer(data, "<u8", blocks + 1).astype(np.int64)
        self.doc_ids = np.frombuffer(data, "<i8", n, at)
        self.present = np.frombuffer(data, np.uint8, n, at + 8 * n).astype(bool)
        self.starts = np.frombuffer(data, "<u8", n + 1, at + 9 * n).astype(np.int64)

    def ids(self, start: int, stop: int) -> np.ndarray:
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (stop - 1) // self.block
        data = self.file.read_at(int(self.offsets[last + 1] - self.offsets[first]), int(self.offsets[first]))
        parts, at = [], 0
        for b in range(first, last + 1):
            size = int(self.offsets[b + 1] - self.offsets[b])
            parts.append(unpack_bits(data[at : at + size], self.bits, min(self.block, self.n_ids - b * self.block)))
            at += size
        return np.concatenate(parts)[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, folder: str | None = None) -> DataFrame:
    """Encode and write all documents; the manifest has ``shard``, ``file``, ``n_docs``, ``n_ids`` and ``base`` (ids of all shards before)."""
    spark = docs.sparkSession
    folder = folder or new_work_path(spark, "token-files")

    def write(batches):
        encode, writer, file = encoder(tokenizer), None, f"{folder}/{uuid.uuid4().hex}.ids"
        bits = max(1, int(max(encode.tokenizer.get_vocab_size() - 1, end_id)).bit_length())
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                for doc_id, ids in zip(part.column(0).to_pylist(), encode.encode([x or "" for x in part.column(1).to_pylist()])):
                    writer = writer or ShardWriter(file, bits)
                    writer.add(doc_id, np.concatenate([ids, end]))
        if writer:
            row = (TaskContext.get().partitionId(), file, *writer.close())
            yield pa.RecordBatch.from_pylist([dict(zip(("shard", "file", "n_docs", "n_ids"), row))])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("tie", F.xxhash64("text"))
    ranged = texts.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    manifest = stored(ranged.select("doc_id", "text").mapInArrow(write, "shard long, file string, n_docs long, n_ids long"), "manifest")
    # One row per shard, so one task for the running sum.
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("base", F.coalesce(before, F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids`` (little-endian 32-bit) of each document."""
    spark = manifest.sparkSession
    # Ranges of documents of about RANGE_IDS ids, dealt over the tasks.
    parts = F.greatest(F.lit(1), F.least(F.col("n_docs"), F.ceil(F.col("n_ids") / RANGE_IDS)))
    ranges = manifest.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    ranges = ranges.select("file", "base", F.expr("part * n_docs div parts").alias("first"), F.expr("(part + 1) * n_docs div parts").alias("last"))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from documents(ShardReader(row["file"]), row["base"], row["first"], row["last"])

    spread = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def documents(shard: ShardReader, base: int, first: int, last: int, at_once: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(first, last, at_once):
        to = min(at + at_once, last)
        ids, starts = shard.ids(int(shard.starts[at]), int(shard.starts[to])).astype("<u4"), shard.starts[at : to + 1]
        columns = [
            pa.array(shard.doc_ids[at:to], pa.int64(), mask=~shard.present[at:to]),
            pa.array(starts[:-1] + base),
            pa.array(np.diff(starts)),
            pa.array([x.tobytes() for x in np.split(ids, starts[1:-1] - starts[0])], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])
