"""Exact duplicates against immutable snapshots, screened by static binary-fuse filters.

A snapshot is a written table of buckets (digest, normalised text, smallest doc_id, rows) and a
binary-fuse filter (three 8-bit slots for each key, about 9 bits a key) for every shard of digests.
A new batch is first grouped by digest and text itself: that is the byte check inside the batch,
and equal rows combine before the shuffle. Its distinct digests then meet the filters, shard by
shard; only digests that pass a filter join the snapshot's buckets, where texts are compared byte by byte.

Equal texts are those that are identical after each run of 0x20 and 0x09-0x0D became one blank.

Defined cases: a null text is empty; a null doc_id never stays when its group has another id (the
smallest id of a group of null ids is null); rows that share doc_id and text are one document that
is counted twice; an empty batch or snapshot list gives an empty or unscreened result; other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.llm import common
from colonnade.session import materialize

SHARD_KEYS = 200_000  # keys of a filter, on average
LEAST_SHARDS = 256
BATCHES = 2


def normalised(text: Column) -> Column:
    """White space runs as one blank; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


# ---- the filter -------------------------------------------------------------------------------


class BinaryFuse:
    """Static filter over distinct 64-bit keys: no false negatives, 1/256 false positives."""

    def __init__(self, seed: int, segment: int, spans: int, slots: np.ndarray):
        self.seed, self.segment, self.spans, self.slots = seed, segment, spans, slots

    @staticmethod
    def places(h: np.ndarray, segment: int, spans: int) -> np.ndarray:
        """The three slots of each hash: one in each of three neighbouring segments."""
        block = ((h >> np.uint64(32)) * np.uint64(spans)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        first = block * np.uint64(segment)
        return np.stack([first + (h & mask), first + np.uint64(segment) + ((h >> np.uint64(18)) & mask),
                         first + np.uint64(2 * segment) + ((common.mix(h) >> np.uint64(7)) & mask)]).astype(np.int64)

    @staticmethod
    def mark(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(29))) & np.uint64(0xFF)).astype(np.uint8)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        keys = np.unique(keys.astype(np.uint64))
        n = len(keys)
        segment = 1 << max(2, int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
        spans = max(1, math.ceil(max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 3))) * n / segment) - 2)
        for seed in range(1, 1000):
            if seed % 10 == 0:  # tiny sets may need more room
                spans += 1 + spans // 8
            h = common.mix(keys + np.uint64(seed * common.BASE % (1 << 64)))
            slots = cls._solve(h, segment, spans)
            if slots is not None:
                return cls(seed, segment, spans, slots)
        raise RuntimeError("no filter found")

    @classmethod
    def _solve(cls, h: np.ndarray, segment: int, spans: int) -> np.ndarray | None:
        """Peel keys that alone use a slot, round by round, then fill slots in reverse order."""
        at = cls.places(h, segment, spans)
        size = segment * (spans + 2)
        n = len(h)
        count = np.bincount(at.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)  # xor of the numbers of the keys that still use the slot
        np.bitwise_xor.at(owner, at.ravel(), np.tile(np.arange(n), 3))
        ready = np.flatnonzero(count == 1)
        rounds, left = [], n
        while len(ready):
            key, first = np.unique(owner[ready], return_index=True)
            rounds.append((key, ready[first]))
            left -= len(key)
            touched = at[:, key].ravel()
            np.subtract.at(count, touched, 1)
            np.bitwise_xor.at(owner, touched, np.tile(key, 3))
            touched = np.unique(touched)
            ready = touched[count[touched] == 1]
        if left:
            return None
        slots = np.zeros(size, np.uint8)
        for key, place in reversed(rounds):
            a = at[:, key]
            slots[place] = cls.mark(h[key]) ^ slots[a[0]] ^ slots[a[1]] ^ slots[a[2]] ^ slots[place]
        return slots

    def contains(self, keys: np.ndarray) -> np.ndarray:
        h = common.mix(keys.astype(np.uint64) + np.uint64(self.seed * common.BASE % (1 << 64)))
        a = self.places(h, self.segment, self.spans)
        return (self.slots[a[0]] ^ self.slots[a[1]] ^ self.slots[a[2]]) == self.mark(h)


# ---- batches and snapshots --------------------------------------------------------------------


def group_batch(docs: DataFrame, digest=sha256) -> DataFrame:
    """The distinct texts of a batch: digest, text, first_id, n. Grouping by the text itself is the
    byte check; equal rows combine before the shuffle."""
    text = normalised(docs["text"])
    rows = docs.select(digest(text).alias("digest"), text.alias("text"), docs["doc_id"].alias("doc_id"))
    return rows.groupBy("digest", "text").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))


def shards_for(keys: int) -> int:
    return max(LEAST_SHARDS, -(-keys // SHARD_KEYS))


def shard_of(digest: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(shards)).cast("int")


def build_filters(buckets: DataFrame, shards: int) -> DataFrame:
    """One binary-fuse filter for each shard of a snapshot's digests: shard, seed, segment, spans, slots."""

    def run(key, table):
        keys = table.column("key").to_numpy().view(np.uint64)
        f = BinaryFuse.build(keys)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "seed": pa.array([f.seed], pa.int64()), "segment": pa.array([f.segment], pa.int64()),
                         "spans": pa.array([f.spans], pa.int64()), "slots": pa.array([f.slots.tobytes()], pa.binary())})

    keys = buckets.select(shard_of(F.col("digest"), shards).alias("shard"), F.xxhash64("digest", F.lit(1)).alias("key"))
    return keys.groupBy("shard").applyInArrow(run, "shard int, seed long, segment long, spans long, slots binary")


def screen(groups: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """The distinct digests of a batch that a snapshot may hold. Each shard's digests meet its filter in
    one task; digests are distinct, so no shard is hot."""

    def run(key, left, right):
        if left.num_rows == 0 or right.num_rows == 0:
            return left.select(["digest"]).slice(0, 0)
        r = right.to_pylist()[0]
        f = BinaryFuse(r["seed"], r["segment"], r["spans"], np.frombuffer(r["slots"], np.uint8))
        hit = f.contains(left.column("key").to_numpy().view(np.uint64))
        return left.select(["digest"]).filter(pa.array(hit))

    incoming = groups.select("digest").distinct().select(
        "digest", shard_of(F.col("digest"), shards).alias("shard"), F.xxhash64("digest", F.lit(1)).alias("key"))
    return incoming.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(run, "digest string")


class Snapshot:
    """An immutable set of texts: the bucket table and its filters, both written once."""

    def __init__(self, buckets: DataFrame):
        self.buckets = buckets
        self.shards = shards_for(buckets.count())
        self.filters = materialize(build_filters(buckets, self.shards), "fuse-filters")


def admit(groups: DataFrame, snapshots: list[Snapshot]) -> DataFrame:
    """The distinct texts of a batch that an older snapshot holds: digest, text_key, owner (the number of
    that snapshot). A text is new in one snapshot only."""
    found = None
    for number, s in enumerate(snapshots):
        positive = screen(groups, s.filters, s.shards)
        new = groups.select("digest", "text").join(positive, "digest", "left_semi").alias("g")
        old = s.buckets.join(positive, "digest", "left_semi").alias("s")
        hit = new.join(old, (F.col("g.digest") == F.col("s.digest")) & (F.col("g.text") == F.col("s.text"))).select(
            F.col("g.digest").alias("digest"), text_key(F.col("g.text")).alias("text_key"), F.lit(number).alias("owner"))
        found = hit if found is None else found.unionByName(hit)
    return found


def text_key(text: Column) -> Column:
    """A second fingerprint, so that rows find their group even if two texts share a digest."""
    return F.struct(F.xxhash64(text), F.octet_length(text))


def dedup(docs: DataFrame, batches: int = BATCHES, digest=sha256) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256. The table is taken in
    as ``batches`` batches (by a hash of the id); each is screened against the snapshots of those before it."""
    snapshots: list[Snapshot] = []
    members = None
    batch_of = F.pmod(F.xxhash64(docs["doc_id"]), F.lit(batches)).cast("int")
    for b in range(batches):
        groups = materialize(group_batch(docs.filter(batch_of == b), digest), "fuse-buckets")
        own = groups.select("digest", text_key(F.col("text")).alias("text_key"), "first_id", "n", F.lit(b).alias("batch"))
        if snapshots:
            hits = materialize(admit(groups, snapshots), "fuse-hits")
            own = own.join(hits, ["digest", "text_key"], "left").withColumn("owner", F.coalesce("owner", F.lit(b)))
            if b + 1 < batches:
                keyed = groups.withColumn("text_key", text_key(F.col("text")))
                groups = materialize(keyed.join(hits, ["digest", "text_key"], "left_anti").drop("text_key"), "fuse-buckets")
        else:
            own = own.withColumn("owner", F.lit(b))
        members = own if members is None else members.unionByName(own)
        if b + 1 < batches:
            snapshots.append(Snapshot(groups))
    # the rows of one text, in whatever batch, have one owner
    totals = members.groupBy("owner", "digest", "text_key").agg(F.min("first_id").alias("keep_id"), F.sum("n").alias("group_size"))
    multiple = materialize(members.select("owner", "digest", "text_key", "batch").join(
        totals.filter("group_size > 1"), ["owner", "digest", "text_key"]).drop("owner"), "fuse-groups")
    text = normalised(docs["text"])
    rows = docs.select(docs["doc_id"].alias("doc_id"), batch_of.alias("batch"), digest(text).alias("digest"), text_key(text).alias("text_key"), sha256(text).alias("text_sha256"))
    joined = rows.join(multiple, ["batch", "digest", "text_key"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                         F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``docs`` without the rows whose text a row of smaller doc_id has; all columns stay. Of rows that
    share doc_id and text, one stays."""
    out = dedup(docs, batches)
    gone = out.filter(~F.col("kept")).select("doc_id", "text_sha256").distinct()
    mark = docs.withColumns({"__digest": sha256(normalised(docs["text"]))})
    left = mark.join(gone.select(F.col("doc_id").alias("__gone"), F.col("text_sha256").alias("__gone_digest")),
                     F.col("doc_id").eqNullSafe(F.col("__gone")) & (F.col("__digest") == F.col("__gone_digest")), "left_anti")
    repeated = out.filter("kept and group_size > 1")
    # rows that share a doc_id: only then can two rows of one text both be kept
    again = repeated.groupBy("doc_id", "text_sha256").count().filter("count > 1").limit(1).count()
    if again:
        return left.dropDuplicates(["doc_id", "__digest"]).drop("__digest")
    return left.drop("__digest")
