"""Helpers shared by the operators: document columns, Arrow batches, word hashing in numpy.

All numpy code here runs inside Arrow batch functions on partitions that Spark made; nothing in
this module starts a job.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space that separates words, 0x20 and 0x09 to 0x0D.
WHITE = bytes([0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20])

BASE = 0x9E3779B97F4A7C15 | 1
U64 = np.uint64


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower_word(c: Column) -> Column:
    """A-Z to a-z in a short string; words of ASCII only, which most are, take the fast path."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(lower_ascii(c))


def text_of(df: DataFrame, column: str = "text") -> Column:
    """The text column with null as the empty string."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def id_text(c: Column) -> Column:
    """The id as text, null as the empty string, so that its crc32 is defined."""
    return F.coalesce(c.cast("string"), F.lit(""))


def held_out(c: Column, parts: int) -> Column:
    """True where crc32(id as text) mod ``parts`` is 1."""
    return F.crc32(id_text(c)) % parts == 1


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets, without copies. Nulls are empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]] if len(off) else raw, off - off[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``most`` bytes of text (one long row may exceed it)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, off = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finalizer (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: Random 64-bit value of each byte, from the rule mix(byte + 1).
BYTE_CODE = mix(np.arange(1, 257, dtype=U64))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) mod 2^64."""
    out = np.full(max(n, 1), base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


INVERSE = pow(BASE, -1, 1 << 64)


class PrefixHash:
    """Rolling sums of a byte array: a polynomial mod 2^64 over random byte codes, in O(1) a span after one pass. Good for
    choosing places (equal spans have equal values), not for telling spans apart: some different long spans collide for
    every base."""

    _pow = powers(BASE, 1)
    _inv = powers(INVERSE, 1)

    def __init__(self, raw: np.ndarray):
        n = len(raw)
        if len(PrefixHash._pow) < n + 1:
            size = max(n + 1, 1 << 16)
            PrefixHash._pow, PrefixHash._inv = powers(BASE, size), powers(INVERSE, size)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(BYTE_CODE[raw] * PrefixHash._pow[:n], out=self.sums[1:])


CHAINED = 512  # bytes up to which spans are hashed block by block; longer ones get a cryptographic digest


def blocks_of(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one little-endian number (zeros after the end)."""
    return np.ndarray(len(raw) + 1, "<u8", np.concatenate([raw, np.zeros(8, np.uint8)]), strides=(1,))


def block_at(blocks: np.ndarray, start: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next eight bytes of spans with ``left`` > 0 bytes to go; bytes behind a span's end read as zero."""
    return blocks[start] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (U64(8) * (U64(8) - np.minimum(left, 8).astype(U64))))


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit value of each span of bytes. Eight bytes at a time go through a bijective finalizer whose input is the
    value so far, so there is no algebra by which different spans meet: spans of one length up to 8 bytes never collide,
    others with the chance of random numbers. Spans above ``CHAINED`` bytes get eight bytes of BLAKE2b."""
    start, size = np.asarray(start, np.int64), np.asarray(end, np.int64) - start
    h = size.astype(U64) * U64(0xD6E8FEB86659FD93)
    blocks = blocks_of(raw)
    todo = np.flatnonzero(size <= CHAINED)
    at = 0
    while len(todo):
        left = size[todo] - at
        more = left > 0
        todo, left = todo[more], left[more]
        h[todo] = mix(h[todo] ^ block_at(blocks, start[todo] + at, left))
        at += 8
    for i in np.flatnonzero(size > CHAINED).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(raw[start[i]:start[i] + size[i]], digest_size=8).digest(), "little")
    return h


def same_spans(raw_a: np.ndarray, start_a: np.ndarray, raw_b: np.ndarray, start_b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether spans of equal size hold the same bytes."""
    a, b = blocks_of(raw_a), blocks_of(raw_b)
    same = np.ones(len(size), bool)
    todo, at = np.flatnonzero(size > 0), 0
    while len(todo):
        left = size[todo] - at
        equal = block_at(a, start_a[todo] + at, left) == block_at(b, start_b[todo] + at, left)
        same[todo[~equal]] = False
        todo, at = todo[equal & (left > 8)], at + 8
    return same


def lower_bytes(raw: np.ndarray) -> np.ndarray:
    """A-Z to a-z in UTF-8 bytes."""
    return np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw)


IS_WHITE = np.zeros(256, bool)
IS_WHITE[list(WHITE)] = True


def words(raw: np.ndarray, off: np.ndarray, white: np.ndarray = IS_WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each maximal run of non-``white`` bytes, and the row it is in. Runs never
    cross rows."""
    n = len(raw)
    inside = np.zeros(n + 2, np.int8)
    inside[1:-1] = ~white[raw]
    start_mark = inside[1:] > inside[:-1]
    end_mark = inside[1:] < inside[:-1]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    both = cut[(inside[cut] == 1) & (inside[cut + 1] == 1)]
    start_mark[both] = True
    end_mark[both] = True
    start, end = np.flatnonzero(start_mark), np.flatnonzero(end_mark)
    row = np.searchsorted(off, start, "right") - 1
    return start, end, row
