"""Cost-balanced packing of documents into training sequences of one length.

A piece of n tokens costs ``linear * n + quadratic * n^2`` (attention inside the piece). Documents
longer than a sequence give full sequences of their own; the other pieces go in descending length
to the sequence of lowest cost that has room for them, and are cut only when none has. Every
partition packs runs of about ``GROUP_TOKENS`` tokens into full sequences and carries what is left
(less than one sequence) to its next run; what is left of partitions is packed again in groups of
``REST_PARTITIONS`` partitions, whose last sequence alone may be short. No text or ids are shuffled
but those rests.

Defined cases: a null text has the end id only; null or repeated doc_ids are packed as they come,
row by row; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.llm import common, tokens
from colonnade.session import BATCH_ROWS, held_conf, materialize

GROUP_TOKENS = 1 << 20
REST_PARTITIONS = 256
TEXTS = 500  # of a batch that goes to a worker
LINEAR, QUADRATIC = 1.0, 1.0 / 1024
REST_IDS = 1 << 62  # sequence ids of the second round begin here

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Item:
    """A run of a document's ids that is not placed yet."""

    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id, start, ids, doc_tokens):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def cut(self, n: int) -> tuple[Item, Item]:
        return (Item(self.doc_id, self.start, self.ids[:n], self.doc_tokens),
                Item(self.doc_id, self.start + n, self.ids[n:], self.doc_tokens))


def pack_group(items: list[Item], length: int, short_last: bool, linear: float = LINEAR,
               quadratic: float = QUADRATIC) -> tuple[list[list[Item]], list[Item]]:
    """Sequences (lists of pieces) and the pieces left over. All sequences are full; with
    ``short_last`` nothing is left over and the last one may be short."""
    full: list[list[Item]] = []
    heap: list[tuple[int, int, Item]] = []
    for item in items:
        while len(item.ids) >= length:
            head, item = item.cut(length)
            full.append([head])
        if len(item.ids):
            heap.append((-len(item.ids), len(heap), item))
    total = -sum(n for n, _, _ in heap)
    bins = [[] for _ in range(total // length)]
    room = np.full(len(bins), length, np.int64)
    if short_last and total % length:
        bins.append([])
        room = np.append(room, total % length)
    cost = np.zeros(len(bins))
    heapq.heapify(heap)
    serial = len(heap)
    rest: list[Item] = []
    while heap:
        n, _, item = heapq.heappop(heap)
        n = -n
        fits = room >= n
        if not fits.any():
            fits = room > 0
            if not fits.any():
                rest.append(item)
                continue
        at = int(np.argmin(np.where(fits, cost, np.inf)))
        if room[at] < n:
            item, more = item.cut(int(room[at]))
            heapq.heappush(heap, (-len(more.ids), serial, more))
            serial += 1
            n = len(item.ids)
        bins[at].append(item)
        room[at] -= n
        cost[at] += linear * n + quadratic * n * n
    return full + bins, rest


def piece_rows(sequences: list[list[Item]], first_id: int) -> list[tuple]:
    rows = []
    for k, seq in enumerate(sequences):
        at = 0
        for p in seq:
            rows.append((p.doc_id, p.start, len(p.ids), zlib.crc32(p.ids.astype("<u4").tobytes()), p.doc_tokens, first_id + k, at))
            at += len(p.ids)
    return rows


def pack(docs: DataFrame, vocab: str, length: int = 2048, end_id: int = 1, group_tokens: int = GROUP_TOKENS,
         rest_partitions: int = REST_PARTITIONS, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and their ids (little-endian unsigned 32-bit) if ``with_ids``."""
    names = [c.split()[0] for c in PIECES.split(", ")]

    def table(rows: list[tuple], ids: list[bytes | None], part: int) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [()] * len(names)
        return pa.record_batch([pa.array(c, pa.int64()) for c in cols] + [pa.array(ids, pa.binary()), pa.array([part] * len(rows), pa.int64())],
                               [*names, "ids", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc, part = tokens.encoder(vocab), TaskContext.get().partitionId()
        items: list[Item] = []
        have, made = 0, 0

        def flush():
            nonlocal items, have, made
            sequences, items = pack_group(items, length, False)
            rows = piece_rows(sequences, (part << 32) + made)
            made += len(sequences)
            have = sum(len(x.ids) for x in items)
            ids = [p.ids.astype("<u4").tobytes() if with_ids else None for s in sequences for p in s]
            return table(rows, ids, part)

        for b in common.pieces(batches):
            for d, ids in zip(b.column("doc_id").to_pylist(), enc.encode(b.column("text").to_pylist())):
                ids = np.append(ids, np.uint32(end_id))
                items.append(Item(d, 0, ids, len(ids)))
                have += len(ids)
            if have >= group_tokens:
                yield flush()
        yield flush()
        rows = [(p.doc_id, p.start, len(p.ids), 0, p.doc_tokens, None, None) for p in items]
        yield table(rows, [p.ids.astype("<u4").tobytes() for p in items], part)

    def run_rest(key, pdf):
        pdf = pdf.sort_values(["part", "doc_id", "start"])
        items = [Item(None if pd.isna(d) else int(d), s, np.frombuffer(i, "<u4"), n)
                 for d, s, i, n in zip(pdf["doc_id"], pdf["start"], pdf["ids"], pdf["doc_tokens"])]
        sequences, _ = pack_group(items, length, True)
        out = pd.DataFrame(piece_rows(sequences, REST_IDS + (int(key[0]) << 32)), columns=names)
        out["doc_id"] = out["doc_id"].astype("Int64")
        out["ids"] = [p.ids.astype("<u4").tobytes() if with_ids else None for s in sequences for p in s]
        return out

    kept = docs.select(docs["doc_id"].cast("long").alias("doc_id"), common.text_of(docs).alias("text"))
    with held_conf(docs.sparkSession, BATCH_ROWS, str(TEXTS)):
        first = materialize(kept.mapInArrow(run, PIECES + ", ids binary, part long"), "pack")
    rest = first.filter("sequence_id is null").withColumn("bunch", F.floor(F.col("part") / rest_partitions))
    second = rest.groupBy("bunch").applyInPandas(run_rest, PIECES + ", ids binary")
    out = first.filter("sequence_id is not null").select(*names, "ids").unionByName(second)
    return out if with_ids else out.drop("ids")
