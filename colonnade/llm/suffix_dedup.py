"""Removal of repeated strings of ``LENGTH`` bytes by blockwise suffix sorting with a difference cover.

A suffix matters only if its first ``LENGTH`` bytes may start elsewhere too. Every such string holds
``LENGTH - GRAM + 1`` grams, and the place of its smallest gram hash depends on its bytes alone, so equal
strings share that hash: it names the suffix bucket. Suffixes whose bucket holds one place only are done;
neighbouring suffixes of one bucket form a run.

Buckets are then sorted one block of bounded size at a time. Inside a block, suffixes are ordered by their first
``PERIOD`` bytes; ties are resolved by ranks that were computed beforehand for the suffixes at a difference
cover's residues: for any two suffixes some shift below ``PERIOD`` takes both to ranked places, and one
comparison of ranks decides. All ties of a block are refined at once by a three-way quicksort in numpy.
Neighbours of the sorted order that share ``LENGTH`` bytes are repeated.

A bucket whose runs are all equal needs no sort: all its strings are repeated. In the others, equal runs are combined
and only one of each travels with its bytes. Inside a bucket, equal strings have one distance to the shared
gram, so a bucket too large for a block is cut by that distance; a bucket of more than ``MOST_RUNS`` distinct runs
is not sorted in one task at all: its strings are counted by their bytes in a distributed aggregate.

Defined cases: null is the empty text; texts shorter than ``LENGTH`` keep all bytes; a string counts as repeated
within one text too, overlaps included; rows that share doc_id and text repeat each other; null doc_ids work (rows
are told apart by a 64-bit hash of id and text); other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.llm import common
from colonnade.session import materialize, materialize_with, release

LENGTH = 200
GRAM = 32
PERIOD = 32
RANKED = 224  # bytes that a cover rank takes into account
BLOCK_SUFFIXES = 400_000
MOST_RUNS = 200_000

U64 = np.uint64


def difference_cover(period: int) -> np.ndarray:
    """Residues such that any two classes reach one of them by a common shift (chosen greedily)."""
    cover, have = [0, 1], {0, 1, period - 1}
    while len(have) < period:
        def gain(x):
            return len({(x - c) % period for c in cover} | {(c - x) % period for c in cover} | have)
        cover.append(max(range(period), key=lambda x: (gain(x), -x)))
        have |= {(a - b) % period for a in cover for b in cover}
    return np.array(sorted(cover))


COVER = difference_cover(PERIOD)


def shift_table(period: int, cover: np.ndarray) -> np.ndarray:
    """shift[a, b]: the least shift that takes residues a and b into the cover."""
    inside = np.zeros(period, bool)
    inside[cover] = True
    shift = np.full((period, period), period, np.int64)
    r = np.arange(period)
    for s in reversed(range(period)):
        both = inside[(r[:, None] + s) % period] & inside[(r[None, :] + s) % period]
        shift[both] = s
    return shift


SHIFT = shift_table(PERIOD, COVER)


# ---- runs -------------------------------------------------------------------------------------


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each window of w values: block-wise running minima from both ends."""
    n = len(x) - w + 1
    size = -(-len(x) // w) * w
    padded = np.full(size, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    blocks = padded.reshape(-1, w)
    head = np.minimum.accumulate(blocks, axis=1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n], head[w - 1:w - 1 + n])


def runs_of(raw: np.ndarray, off: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Maximal runs of string starts whose smallest gram is at one place: row, first and last start, place and hash."""
    n, w = len(raw), length - gram + 1
    empty = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, U64),)
    if n < length:
        return empty
    sums = common.PrefixHash(raw).sums
    h = common.mix((sums[gram:] - sums[:-gram]) * common.PrefixHash._inv[:n - gram + 1])
    low = U64((1 << 24) - 1)
    at = np.arange(len(h), dtype=U64) & low
    first = sliding_min((h & ~low) | at, w) & low  # the leftmost place of the smallest hash, modulo 2^24
    s = np.arange(len(first))
    place = s + ((first.astype(np.int64) - s) & int(low))
    row = np.searchsorted(off, s, "right") - 1
    valid = s + length <= off[row + 1]
    begin = valid & np.append(True, (place[1:] != place[:-1]) | ~valid[:-1] | (row[1:] != row[:-1]))
    end = valid & np.append((place[1:] != place[:-1]) | ~valid[1:] | (row[1:] != row[:-1]), True)
    lo, hi = np.flatnonzero(begin), np.flatnonzero(end)
    r = row[lo]
    return r, lo - off[r], hi - off[r], place[lo] - off[r], h[place[lo]]


def find_runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """mark, lo, shape, bucket, name of all runs. ``docs`` has mark (of row and text) and text. ``shape`` holds the last
    start and the gram's place, both as distances from ``lo``; ``name`` is a hash of the run's bytes and shape."""

    def run(batches):
        for b in common.pieces(batches):
            raw, off = common.utf8(b.column("text"))
            r, lo, hi, place, h = runs_of(raw, off, length, gram)
            shape = ((hi - lo) << 8) | (place - lo)
            name = common.mix(common.span_hashes(raw, off[r] + lo, off[r] + hi + length) + shape.astype(U64))
            yield pa.record_batch([b.column("mark").take(pa.array(r)), pa.array(lo, pa.int32()), pa.array(shape, pa.int32()),
                                   pa.array(h.view(np.int64)), pa.array(name.view(np.int64))], ["mark", "lo", "shape", "bucket", "name"])

    return docs.select("mark", "text").mapInArrow(run, "mark long, lo int, shape int, bucket long, name long")


def run_bytes(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """One run of each name with its bytes: bucket, name, lead (distance from the first start to the gram), body, n. Each
    document's runs meet its text in one join."""
    lists = runs.groupBy(F.col("mark").alias("r_mark")).agg(F.collect_list(F.struct("lo", "shape", "bucket", "name", "n")).alias("runs"))
    texts = docs.select("mark", "text")
    both = texts.join(lists, texts["mark"] == F.col("r_mark")).dropDuplicates(["mark"]).select("text", "runs")

    def run(batches):
        for b in common.pieces(batches):
            raw, off = common.utf8(b.column("text"))
            data = raw.tobytes()
            rows = b.column("runs")
            ends = rows.offsets.to_numpy() - rows.offsets[0].as_py()
            lo, shape, bucket, name, n = (rows.flatten().field(k) for k in range(5))
            lo, shape = lo.to_numpy(), shape.to_numpy()
            row = np.repeat(np.arange(b.num_rows), np.diff(ends))
            a = off[row] + lo
            z = a + (shape >> 8) + length
            body = [data[i:j] for i, j in zip(a.tolist(), z.tolist())]
            out = pa.record_batch([bucket, name, pa.array(shape & 255, pa.int32()), pa.array(body, pa.binary()), n], ["bucket", "name", "lead", "body", "n"])
            for i in range(0, out.num_rows, 20_000):
                yield out.slice(i, 20_000)

    return both.mapInArrow(run, "bucket long, name long, lead int, body binary, n long")


# ---- the sort of a block ----------------------------------------------------------------------


def words8(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a big-endian number."""
    n = len(text) - 8
    data = text.tobytes()
    out = np.empty(n, U64)
    for k in range(8):
        part = np.frombuffer(data, ">u8", (n - k + 7) // 8, k)
        out[k::8] = part
    return out


def dense(order: np.ndarray, differs: np.ndarray) -> np.ndarray:
    """Ranks from a sorted order and whether each element differs from the one before it."""
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(differs)
    return rank


def rank_first(w8: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    """Dense rank of the first 8 * count bytes at each place."""
    keys = [w8[at + 8 * k] for k in range(count)]
    order = np.lexsort(keys[::-1])
    differs = np.zeros(len(at), bool)
    for k in keys:
        k = k[order]
        differs[1:] |= k[1:] != k[:-1]
    return dense(order, differs)


def cover_ranks(w8: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of the RANKED bytes at the cover's places below n, and the number of each place (-1 elsewhere)."""
    inside = np.zeros(PERIOD, bool)
    inside[COVER] = True
    at = np.flatnonzero(np.tile(inside, -(-n // PERIOD))[:n])
    number = np.full(n + RANKED + PERIOD, -1, np.int64)
    number[at] = np.arange(len(at))
    rank = rank_first(w8, at, PERIOD // 8)

    def joined(rank, step):  # (rank here, rank ``step`` further on), ``step`` being a multiple of the period
        later = number[at + step]
        second = np.where(later >= 0, rank[later], -1) + 1
        return np.unique(rank * (int(rank.max(initial=0)) + 2) + second, return_inverse=True)[1]

    rank = joined(joined(rank, PERIOD), 2 * PERIOD)
    return joined(rank, RANKED - 4 * PERIOD), number


def sort_suffixes(text: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in suffix order (by RANKED bytes at least), and whether each starts with the PERIOD bytes of the one
    before it."""
    w8 = words8(text)
    n = len(text) - RANKED - 2 * PERIOD
    first = rank_first(w8, at, PERIOD // 8)
    order = np.argsort(first, kind="stable")
    place, group = at[order], first[order]
    ties = np.append(False, group[1:] == group[:-1])
    open_ = ties | np.append(ties[1:], False)
    if open_.any():
        rank, number = cover_ranks(w8, n + RANKED)
        slot = np.flatnonzero(open_)
        seg = np.cumsum(~ties[slot])  # neighbours in one group
        while len(slot):
            begin = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
            size = np.diff(np.append(begin, len(seg)))
            middle = np.repeat(begin + size // 2, size)
            here = place[slot]
            pivot = here[middle]
            shift = SHIFT[here % PERIOD, pivot % PERIOD]
            side = np.sign(rank[number[here + shift]] - rank[number[pivot + shift]])
            key = np.repeat(np.arange(len(begin)), size) * 3 + side + 1
            by = np.argsort(key, kind="stable")
            place[slot] = here[by]
            key = key[by]
            more = key % 3 != 1
            count = np.bincount(key)
            more &= count[key] > 1
            slot, seg = slot[more], key[more]
    return place, ties


def repeated_places(text: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Which of the places start a string of ``length`` bytes that another of them starts too."""
    place, ties = sort_suffixes(text, at)
    w8 = words8(text)
    same = ties.copy()
    for k in list(range(0, length - 7, 8)) + [length - 8]:
        one = np.flatnonzero(same)
        same[one] = w8[place[one] + k] == w8[place[one - 1] + k]
    hit = same | np.append(same[1:], False)
    out = np.zeros(len(text), bool)
    out[place[hit]] = True
    return out[at]


def repeated_in_runs(bodies: list[bytes], length: int, block: int = BLOCK_SUFFIXES, lead: list[int] | None = None) -> list[np.ndarray]:
    """For each run, which of its starts are repeated in the runs given. Too many starts for a block are taken by
    their distance to the shared gram, a range of distances at a time (only with ``lead``)."""
    starts = np.array([len(b) - length + 1 for b in bodies], np.int64)
    out = [np.zeros(k, bool) for k in starts]
    if lead is None or starts.sum() <= block:
        ranges = [(None, None)]
    else:
        far = np.array(lead)
        low, high = int((far - starts + 1).min()), int(far.max())
        step = max(1, int(block * (high - low + 1) // starts.sum()))
        ranges = [(d, min(d + step - 1, high)) for d in range(low, high + 1, step)]
    for d1, d2 in ranges:
        if d1 is None:
            cuts = [(i, 0, int(k)) for i, k in enumerate(starts)]
        else:  # the start at distance d of run i is number lead[i] - d
            cuts = [(i, max(0, lead[i] - d2), min(int(k), lead[i] - d1 + 1)) for i, k in enumerate(starts)]
            cuts = [c for c in cuts if c[1] < c[2]]
        if len(cuts) < 2:
            continue
        parts = [bodies[i][a:z + length - 1] for i, a, z in cuts]
        size = np.array([len(p) for p in parts])
        begin = np.cumsum(size) - size
        text = np.frombuffer(b"".join(parts) + bytes(2 * RANKED + 4 * PERIOD), np.uint8)
        n = np.array([z - a for _, a, z in cuts])
        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        hit = repeated_places(text, at, length)
        for (i, a, z), part in zip(cuts, np.split(hit, np.cumsum(n)[:-1])):
            out[i][a:z] = part
    return out


def sort_buckets(distinct: DataFrame, length: int, block: int) -> DataFrame:
    """(bucket, name, hits): the repeated starts of each distinct run as packed bits. A partition takes whole buckets,
    several small ones to a block."""

    def solve(rows):
        lead = [r[2] for r in rows] if len({r[0] for r in rows}) == 1 else None
        hits = repeated_in_runs([r[3] for r in rows], length, block, lead)
        keep = [(r[0], r[1], np.packbits(np.ones(len(h), bool) if r[4] > 1 else h, bitorder="little").tobytes())
                for r, h in zip(rows, hits) if r[4] > 1 or h.any()]
        cols = list(zip(*keep)) if keep else [(), (), ()]
        return pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary())], ["bucket", "name", "hits"])

    def run(batches):
        held, suffixes, bucket, own = [], 0, None, []

        def close(force):
            """Put the finished bucket to the block, or solve the block first."""
            nonlocal held, suffixes, own
            n = sum(len(r[3]) - length + 1 for r in own)
            if held and suffixes + n > block:
                yield solve(held)
                held, suffixes = [], 0
            held, suffixes, own = held + own, suffixes + n, []
            if held and (force or suffixes > block):
                yield solve(held)
                held, suffixes = [], 0

        for b in batches:
            cols = [b.column(c) for c in ("bucket", "name", "lead", "body", "n")]
            for r in zip(*(c.to_pylist() for c in cols)):
                if r[0] != bucket:
                    yield from close(False)
                    bucket = r[0]
                own.append(r)
        yield from close(True)

    return distinct.repartition("bucket").sortWithinPartitions("bucket").select("bucket", "name", "lead", "body", "n").mapInArrow(
        run, "bucket long, name long, hits binary")


def count_strings(distinct: DataFrame, length: int) -> DataFrame:
    """The same for buckets of too many runs, by counting every string: (bucket, name, hits)."""

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                body = b.column("body")[i].as_py()
                k = len(body) - length + 1
                names = [hashlib.blake2b(body[j:j + length], digest_size=16).digest() for j in range(k)]
                yield pa.record_batch([b.column("bucket").take(pa.array([i] * k)), b.column("name").take(pa.array([i] * k)), pa.array(np.arange(k), pa.int32()),
                                       pa.array([k] * k, pa.int32()), b.column("n").take(pa.array([i] * k)), pa.array(names, pa.binary())],
                                      ["bucket", "name", "j", "k", "n", "string"])

    strings = distinct.select("bucket", "name", "body", "n").mapInArrow(run, "bucket long, name long, j int, k int, n long, string binary")
    twice = strings.groupBy("string").agg(F.sum("n").alias("places")).filter("places > 1").select("string")
    hits = strings.join(twice, "string", "left_semi").groupBy("bucket", "name").agg(F.first("k").alias("k"), F.collect_set("j").alias("js"))

    def pack(batches):
        for b in batches:
            bits = []
            for k, js in zip(b.column("k").to_pylist(), b.column("js").to_pylist()):
                x = np.zeros(k, bool)
                x[js] = True
                bits.append(np.packbits(x, bitorder="little").tobytes())
            yield pa.record_batch([b.column("bucket"), b.column("name"), pa.array(bits, pa.binary())], ["bucket", "name", "hits"])

    return hits.mapInArrow(pack, "bucket long, name long, hits binary")


# ---- the operator -----------------------------------------------------------------------------


def repeated_runs(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK_SUFFIXES, most_runs: int = MOST_RUNS) -> DataFrame:
    """mark, lo, shape, hits: from byte lo on, which starts of a string of ``length`` bytes are repeated (null: all)."""
    runs = materialize(find_runs(docs, length, gram), "runs")
    places = runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"), F.min("name").alias("a"), F.max("name").alias("b"))
    shared = places.filter("k > 1").select("bucket", (F.col("a") == F.col("b")).alias("equal"))
    held = materialize(runs.join(shared, "bucket"), "shared-runs")
    release(runs)
    # buckets of different runs: one run of each name, with its bytes
    one = F.min(F.struct("mark", "lo", "shape")).alias("one")
    distinct = held.filter("not equal").groupBy("bucket", "name").agg(F.count(F.lit(1)).alias("n"), one).select("bucket", "name", "n", "one.*")
    distinct = materialize(run_bytes(docs, distinct, length), "run-bytes")
    sizes = distinct.groupBy("bucket").agg(F.count(F.lit(1)).alias("k"))
    large, seen = materialize_with(sizes.filter(F.col("k") > most_runs).select("bucket"), "large-buckets")
    hits = sort_buckets(distinct.join(large, "bucket", "left_anti") if seen["rows"] else distinct, length, block)
    if seen["rows"]:
        hits = hits.unionByName(count_strings(distinct.join(large, "bucket", "left_semi"), length))
    hits = materialize(hits, "hits")
    release(distinct)
    mixed = held.filter("not equal").select("bucket", "name", "mark", "lo", "shape").join(hits, ["bucket", "name"]).select("mark", "lo", "shape", "hits")
    return mixed.unionByName(held.filter("equal").select("mark", "lo", "shape", F.lit(None).cast("binary").alias("hits")))


def removed(n: int, runs: list[dict], length: int) -> np.ndarray:
    """Which of a text's n bytes a repeated string covers."""
    edge = np.zeros(n + 1, np.int64)
    for r in runs:
        if r["hits"] is None:
            starts = np.arange((r["shape"] >> 8) + 1) + r["lo"]
        else:
            starts = np.flatnonzero(np.unpackbits(np.frombuffer(r["hits"], np.uint8), bitorder="little")) + r["lo"]
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + length, -1)
    return np.cumsum(edge)[:n] > 0


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK_SUFFIXES, most_runs: int = MOST_RUNS,
                   with_text: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the bytes that stay if
    ``with_text``."""
    rows = docs.select("doc_id", common.text_of(docs).alias("text")).withColumn("mark", F.xxhash64("doc_id", "text"))
    found = repeated_runs(rows, length, gram, block, most_runs)
    lists = found.groupBy(F.col("mark").alias("r_mark")).agg(F.collect_set(F.struct("lo", "shape", "hits")).alias("runs"))
    both = rows.join(lists, rows["mark"] == F.col("r_mark"), "left").select("doc_id", "text", "runs")

    def run(batches):
        for b in common.pieces(batches):
            raw, off = common.utf8(b.column("text"))
            gone_n, spans, sha, kept = [], [], [], []
            for i, runs in enumerate(b.column("runs").to_pylist()):
                own = raw[off[i]:off[i + 1]]
                if runs:
                    gone = removed(len(own), runs, length)
                    gone_n.append(int(gone.sum()))
                    spans.append(int((gone & ~np.append(False, gone[:-1])).sum()))
                    own = own[~gone]
                else:
                    gone_n.append(0)
                    spans.append(0)
                own = own.tobytes()
                sha.append(hashlib.sha256(own).hexdigest())
                kept.append(own if with_text else None)
            yield pa.record_batch([b.column("doc_id"), pa.array(np.diff(off)), pa.array(gone_n, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha),
                                   pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = dict(docs.dtypes)["doc_id"]
    out = both.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if with_text else out.drop("kept")
