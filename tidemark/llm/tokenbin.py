"""Token ids in files of fixed-width bits, with block offsets."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import read_files, staged, write_files
from tidemark.llm.tokens import batches_of, shared_encoder

# A file: magic, then little-endian 64-bit numbers: part, shard, bits an id, ids a block, documents, ids, blocks;
# then doc_ids, a byte each that is 0 for a null one, ids per document, offsets of the blocks in the body, the body.
MAGIC = b"TMBITS01"
HEAD = "<8s7q"
HEAD_SIZE = struct.calcsize(HEAD)


def bits_for(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids in `bits` bits each, most significant first, filled up to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    spread = np.unpackbits(ids.astype(">u4").view(np.uint8).reshape(-1, 4), axis=1)
    return np.packbits(spread[:, 32 - bits :].ravel()).tobytes()


def unpack_bits(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", count).astype(np.uint32)
    spread = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits).reshape(count, bits)
    wide = np.zeros((count, 32), np.uint8)
    wide[:, 32 - bits :] = spread
    return np.packbits(wide, axis=1).view(">u4").ravel().astype(np.uint32)


def encode_file(part: int, shard: int, bits: int, block: int, doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    every = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    blocks = [pack_bits(every[i : i + block], bits) for i in range(0, len(every), block)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<i8")
    head = struct.pack(HEAD, MAGIC, part, shard, bits, block, len(ids), len(every), len(blocks))
    known = bytes(d is not None for d in doc_ids)
    return b"".join(
        [head, np.array([d or 0 for d in doc_ids], "<i8").tobytes(), known, np.array([len(x) for x in ids], "<i8").tobytes(), offsets.tobytes(), *blocks]
    )


class TokenFile:
    """A file's contents; `ids(start, stop)` touches only the blocks that hold that range."""

    def __init__(self, data: bytes):
        magic, self.part, self.shard, self.bits, self.block, docs, self.total, blocks = struct.unpack_from(HEAD, data)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at = HEAD_SIZE
        numbers = np.frombuffer(data, "<i8", docs, at)
        known = data[at + 8 * docs : at + 9 * docs]
        self.doc_ids = [int(d) if k else None for d, k in zip(numbers, known)]
        at += 9 * docs
        self.counts = np.frombuffer(data, "<i8", docs, at)
        self.offsets = np.frombuffer(data, "<i8", blocks + 1, at + 8 * docs)
        self.body = memoryview(data)[at + 8 * docs + 8 * (blocks + 1) :]

    def ids(self, start: int, stop: int) -> np.ndarray:
        first, last = start // self.block, -(-stop // self.block)
        parts = [
            unpack_bits(bytes(self.body[self.offsets[b] : self.offsets[b + 1]]), self.bits, min(self.block, self.total - b * self.block))
            for b in range(first, last)
        ]
        every = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        return every[start - first * self.block : stop - first * self.block]


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_ids: int = 1 << 22, block_ids: int = 1 << 13) -> None:
    """Write the ids of `docs` (doc_id, text) to files under `path`, in ascending doc_id order.

    The texts are dealt by ranges of doc_id and sorted there; each task encodes its
    range and cuts it into files of about `shard_ids` ids, a document staying whole.
    A null text has the end id alone.  Null doc_ids come first; rows that repeat a
    doc_id follow their texts' order.  An empty table gives no file of ids.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, shard = shared_encoder(tokenizer), TaskContext.get().partitionId(), 0
        bits = bits_for(max(encoder.vocabulary, end_id + 1))
        last = np.array([end_id], dtype=encoder.dtype).tobytes()
        names, parts, held = [], [], 0

        def file() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([encode_file(part, shard, bits, block_ids, names, parts)], pa.binary())], ["blob"])

        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for begin, some in batches_of(texts):
                for doc_id, data in zip(doc_ids[begin:], encoder(some)):
                    names.append(doc_id)
                    parts.append(np.frombuffer(data + last, encoder.dtype))
                    held += len(parts[-1])
                    if held >= shard_ids:
                        yield file()
                        names, parts, held, shard = [], [], 0, shard + 1
        if names:
            yield file()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ranged = rows.repartitionByRange(F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    write_files(ranged.mapInArrow(shards, "blob binary"), path, "\n")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """part, shard, doc_id, place (its place in the file), n_tokens, ids (binary, unsigned 32 bits, little-endian)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                if not len(data.as_buffer()) > HEAD_SIZE:
                    continue
                file = TokenFile(data.as_py())
                stops = np.cumsum(file.counts)
                step = 2000
                for i in range(0, len(stops), step):
                    some = range(i, min(i + step, len(stops)))
                    ids = [file.ids(int(stops[k] - file.counts[k]), int(stops[k])).astype("<u4").tobytes() for k in some]
                    n = len(ids)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([file.part] * n, pa.int64()),
                            pa.array([file.shard] * n, pa.int64()),
                            pa.array([file.doc_ids[k] for k in some], pa.int64()),
                            pa.array([int(stops[k] - file.counts[k]) for k in some], pa.int64()),
                            pa.array([int(file.counts[k]) for k in some], pa.int64()),
                            pa.array(ids, pa.binary()),
                        ],
                        ["part", "shard", "doc_id", "place", "n_tokens", "ids"],
                    )

    return read_files(spark, path).mapInArrow(decode, "part long, shard long, doc_id long, place long, n_tokens long, ids binary")


def with_starts(read: DataFrame) -> DataFrame:
    """Add `start`, the ids of all documents before, from sums per file and per part; `read` is used twice."""
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    files = read.groupBy("part", "shard").agg(F.sum("n_tokens").alias("_n"))
    parts = files.groupBy("part").agg(F.sum("_n").alias("_n"))
    # One row per writing task, then one per file of a task.
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before(Window.orderBy("part"))), F.lit(0)).alias("_part_start"))
    files = files.select("part", "shard", F.coalesce(F.sum("_n").over(before(Window.partitionBy("part").orderBy("shard"))), F.lit(0)).alias("_file_start"))
    starts = files.join(parts, "part").select("part", "shard", (F.col("_part_start") + F.col("_file_start")).alias("_start"))
    return read.join(starts, ["part", "shard"]).withColumn("start", F.col("_start") + F.col("place")).drop("_start", "part", "shard", "place")


def token_digests(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> DataFrame:
    """Write and read back: doc_id, start, n_tokens, ids_crc32."""
    write_token_files(docs, path, tokenizer, end_id)
    read = read_token_files(docs.sparkSession, path)
    digests = staged(read.select("part", "shard", "doc_id", "place", "n_tokens", F.crc32("ids").alias("ids_crc32")), "token-digests")
    return with_starts(digests).select("doc_id", "start", "n_tokens", "ids_crc32")
