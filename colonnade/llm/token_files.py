"""Token files: ids of documents bit-packed at the width of the vocabulary, with block offsets.

``write_token_files`` encodes every document, appends an end id, orders documents by id and writes
segments of about ``SEGMENT_IDS`` ids. A segment holds whole documents and is one blob (see
``TokenFile``): a header, the documents' ids and starts, the byte offset of each block, and blocks
of ``BLOCK_IDS`` ids at ``bits`` bits each, so that any id is found from its number and a block is
unpacked by a few numpy operations. Spark's committer writes the blobs as rows of a Parquet table,
so a lost executor leaves no partial segment.

Defined cases: a null text has the end id only; a null doc_id comes first; rows that share a
doc_id follow each other in the order of their content; an empty table gives a table without
segments; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colonnade.llm import common, tokens

MAGIC = b"CTOK"
BLOCK_IDS = 4096
SEGMENT_IDS = 1 << 20
NO_ID = -(1 << 63)  # stands for a null doc_id inside a blob


def bits_for(vocab_size: int) -> int:
    """The fewest bits that hold every id below ``vocab_size``."""
    return max(1, int(vocab_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids at ``bits`` bits each, little end first, padded to a whole byte."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    out = np.empty((len(ids), bits), np.uint8)
    for b in range(bits):
        out[:, b] = (ids >> b) & 1
    return np.packbits(out.ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of ``data``."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    raw = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * bits).reshape(n, bits)
    out = np.zeros(n, np.uint32)
    for b in range(bits):
        out |= raw[:, b].astype(np.uint32) << np.uint32(b)
    return out


def build_segment(doc_ids: list[int | None], ids: list[np.ndarray], bits: int, block: int = BLOCK_IDS) -> bytes:
    """One blob of whole documents."""
    all_ids = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    starts = np.zeros(len(ids) + 1, "<i8")
    np.cumsum([len(x) for x in ids], out=starts[1:])
    blocks = [pack_bits(all_ids[i:i + block], bits) for i in range(0, len(all_ids), block)]
    offsets = np.zeros(len(blocks) + 1, "<i8")
    np.cumsum([len(b) for b in blocks], out=offsets[1:])
    head = struct.pack("<4sBxxxIqqq", MAGIC, bits, block, len(ids), len(all_ids), len(blocks))
    names = np.array([NO_ID if d is None else d for d in doc_ids], "<i8")
    return b"".join([head, names.tobytes(), starts.tobytes(), offsets.tobytes(), *blocks])


class TokenFile:
    """A segment blob: ``ids(lo, hi)`` reads any run of ids, ``doc(k)`` the ids of its k-th document."""

    HEAD = struct.calcsize("<4sBxxxIqqq")

    def __init__(self, data: bytes):
        magic, self.bits, self.block, n_docs, self.n_ids, n_blocks = struct.unpack_from("<4sBxxxIqqq", data)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = self.HEAD
        self.doc_ids = np.frombuffer(data, "<i8", n_docs, at)
        at += 8 * n_docs
        self.starts = np.frombuffer(data, "<i8", n_docs + 1, at)
        at += 8 * (n_docs + 1)
        self.offsets = np.frombuffer(data, "<i8", n_blocks + 1, at)
        self.payload = memoryview(data)[at + 8 * (n_blocks + 1):]

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids number lo to hi - 1; only the blocks that hold them are unpacked."""
        first, last = lo // self.block, -(-hi // self.block)
        got = [unpack_bits(self.payload[self.offsets[b]:self.offsets[b + 1]], min(self.block, self.n_ids - b * self.block), self.bits)
               for b in range(first, last)]
        if not got:
            return np.zeros(0, np.uint32)
        return np.concatenate(got)[lo - first * self.block:hi - first * self.block]

    def doc(self, k: int) -> np.ndarray:
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))


def write_token_files(docs: DataFrame, path: str, vocab: str, end_id: int = 0, segment_ids: int = SEGMENT_IDS) -> None:
    """Write all documents' ids, in ascending doc_id order, as segments under ``path``. Documents are put in order
    before they are encoded, so that finding the ranges' bounds encodes nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = tokens.encoder(vocab)
        bits = bits_for(max(enc.vocab_size, end_id + 1))
        shard, segment = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        ids: list[np.ndarray] = []
        have = 0

        def flush():
            nonlocal segment, names, ids, have
            blob = build_segment(names, ids, bits)
            out = pa.record_batch([pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), pa.array([have], pa.int64()),
                                   pa.array([len(ids)], pa.int64()), pa.array([blob], pa.binary())],
                                  ["shard", "segment", "n_ids", "n_docs", "data"])
            segment, names, ids, have = segment + 1, [], [], 0
            return out

        for b in common.pieces(batches):
            for d, x in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text").to_pylist())):
                names.append(d)
                ids.append(np.append(x, np.uint32(end_id)))
                have += len(ids[-1])
                if have >= segment_ids:
                    yield flush()
        if names:
            yield flush()

    kept = docs.select(docs["doc_id"].cast("long").alias("doc_id"), common.text_of(docs).alias("text"))
    order = F.col("doc_id").asc_nulls_first()
    segments = kept.repartitionByRange(order).sortWithinPartitions(order, "text").mapInArrow(
        run, "shard int, segment int, n_ids long, n_docs long, data binary")
    # ids hardly compress further
    segments.write.mode("overwrite").option("compression", "uncompressed").parquet(path)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """shard, segment and the number of ids in all segments before it. The running sum over shards
    sees one row for each shard, the one over segments those of its shard."""
    index = spark.read.parquet(path).select("shard", "segment", "n_ids")
    shards = index.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = shards.select("shard", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("shard_start"))
    inner = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    return (index.withColumn("inside", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)))
            .join(before, "shard").select("shard", "segment", (F.col("shard_start") + F.col("inside")).alias("segment_start")))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, segment, data in zip(b.column("shard"), b.column("segment"), b.column("data")):
                f = TokenFile(data.as_buffer().to_pybytes())
                ids = f.ids(0, f.n_ids)
                lo, hi = f.starts[:-1], f.starts[1:]
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(lo.tolist(), hi.tolist())]
                n = len(crc)
                yield pa.record_batch([pa.array(np.full(n, shard.as_py(), np.int32)), pa.array(np.full(n, segment.as_py(), np.int32)),
                                       pa.array(f.doc_ids, mask=f.doc_ids == NO_ID), pa.array(lo), pa.array(hi - lo), pa.array(crc, pa.int64())],
                                      ["shard", "segment", "doc_id", "lo", "n_tokens", "ids_crc32"])

    docs = spark.read.parquet(path).select("shard", "segment", "data").mapInArrow(
        run, "shard int, segment int, doc_id long, lo long, n_tokens long, ids_crc32 long")
    return (docs.join(segment_starts(spark, path), ["shard", "segment"])
            .select("doc_id", (F.col("segment_start") + F.col("lo")).alias("start"), "n_tokens", "ids_crc32"))
