"""Language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions; a node is a context (the last 0 to ``DEPTH`` bytes) and the bits of the byte
known so far. Every node has a Krichevsky-Trofimov estimate of its next bit and the weighted probability
``P_w = 1/2 KT + 1/2 (product of its children's P_w)``; the block probabilities of all training bytes give each
node's share in the mixture over depths, and a text's code length is the sum over its bits.

The whole tree is kept: every context of the training bytes has its node at every input size. Texts are dealt into
chunks of about ``CHUNK`` bytes; the distinct (context, byte) keys of the chunks, with their counts, are
range-partitioned into parts of about ``PART_ROWS`` rows. A key begins with the byte before, so the range of a part
holds whole subtrees, except the contexts of its first and last key: their counts (at most 2 (``DEPTH`` + 1) contexts
a part) are added up on the driver and sent back. Each part scores its own keys and sends the scores to the chunks
that hold them. A node without data takes no part in the mixture. Only where a caller asks for it (``most``) is the
tree cut to the contexts that occur at least ``m`` times, the smallest power of two that leaves at most ``most``;
the others of a context then share one leaf.

Next to the model stands a plain unigram baseline of words. Counts of the ``FREQUENT`` most frequent words, about,
go to the workers (a bounded table); the other words of each text meet their counts in a join.

Texts are scored with A-Z lowered and one end mark (the byte 0xFF, which UTF-8 never has, also stands before the text).

Defined cases: null is the empty text, whose only symbol and token is the end; null ids count as the empty text in
the fold rule; repeated rows are learned and scored each; with no training rows every bit has probability 1/2 and
every word the count 0; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from colonnade.llm import common
from colonnade.session import materialize

DEPTH = 5
CHUNK = 32 << 20  # bytes of text that are scored together (one long text may exceed it)
PART_ROWS = 1 << 19  # (chunk, key) rows of a part of the tree
FREQUENT = 1 << 19
MERGE_AT = 2_000_000  # distinct counts a partition holds before it merges them
PIECE = 1 << 19  # bytes of text that a worker counts at once (one long text may exceed it)
END = 0xFF
END_TOKEN = np.uint64(0x5EED)
LOG10_HALF = np.log10(0.5)


# ---- bytes and words --------------------------------------------------------------------------


def symbol_keys(raw: np.ndarray, off: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each byte and end mark: the key (last byte, byte before it, .., this byte), and the row. Contexts begin
    with end marks and never cross rows."""
    n = len(off) - 1
    size = np.diff(off)
    padded = np.full(len(raw) + n * (depth + 1), END, np.uint64)
    begin = off[:-1] + np.arange(n) * (depth + 1) + depth
    text_row = np.repeat(np.arange(n), size)
    padded[np.arange(len(raw)) + (text_row + 1) * (depth + 1) - 1] = raw
    row = np.repeat(np.arange(n), size + 1)
    at = np.arange(len(row)) - np.repeat(off[:-1] + np.arange(n), size + 1) + np.repeat(begin, size + 1)
    key = padded[at]
    for k in range(1, depth + 1):
        key |= padded[at - k] << np.uint64(8 * (depth - k + 1))
    return key, row


def word_tokens(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each word, then of each row's end token."""
    start, end, row = common.words(raw, off)
    n = len(off) - 1
    return np.append(common.span_hashes(raw, start, end), np.full(n, END_TOKEN)), np.append(row, np.arange(n))


class Counter:
    """Counts of 64-bit keys, merged when many."""

    def __init__(self):
        self.parts, self.held = [], 0

    def add(self, keys: np.ndarray) -> None:
        keys = np.sort(keys)
        if len(keys):
            first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            self.parts.append((keys[first], np.diff(np.append(first, len(keys)))))
            self.held += len(first)
            if self.held > MERGE_AT:
                self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, n = np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.parts, self.held = [(keys[first], np.add.reduceat(n, first))], len(first)
        return self.parts[0]


def dealt(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` (doc_id, text, learn), written with a row number and a chunk: the number of the chunk's first row."""

    def run(batches):
        chunk, held = None, 0
        for b in batches:
            uid, size = b.column("uid").to_numpy(), np.diff(common.utf8(b.column("text"))[1]) + 1
            out = np.empty(len(uid), np.int64)
            for i, n in enumerate(size.tolist()):
                if chunk is None or held + n > CHUNK:
                    chunk, held = uid[i], 0
                held += n
                out[i] = chunk
            yield pa.record_batch([b.column("uid"), pa.array(out), *b.columns[1:]], ["uid", "chunk", *b.schema.names[1:]])

    numbered = rows.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "text", "learn")
    return materialize(numbered.mapInArrow(run, f"uid long, chunk long, doc_id {kind}, text string, learn boolean"), "chunks")


def key_counts(texts: DataFrame, depth: int) -> DataFrame:
    """(kind, chunk, key, n) of ``dealt`` texts: kind 0 has the (context, byte) keys of each chunk, n of them in rows to
    learn; kind 1 the word hashes of the rows to learn (chunk 0). A pair may have several rows."""

    def run(batches):
        grams, tokens = Counter(), Counter()

        def rows(kind, counter, chunk):
            keys, n = counter.merge()
            counter.parts, counter.held = [], 0
            if kind == 0 and len(keys):
                learned, keys = n * (keys & np.uint64(1)).astype(np.int64), keys >> np.uint64(1)
                first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                keys, n = keys[first], np.add.reduceat(learned, first)
            for i in range(0, len(keys), 1 << 17):
                k = keys[i:i + (1 << 17)]
                yield pa.record_batch([pa.array(np.full(len(k), kind, np.int32)), pa.array(np.full(len(k), chunk, np.int64)),
                                       pa.array(k.view(np.int64)), pa.array(n[i:i + (1 << 17)])], ["kind", "chunk", "key", "n"])

        current = 0
        for piece in common.pieces(batches, most=PIECE):
            chunks = piece.column("chunk").to_numpy()
            cuts = np.append(np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1])), len(chunks))
            for begin, end in zip(cuts[:-1], cuts[1:]):
                b = piece.slice(begin, end - begin)
                if chunks[begin] != current:
                    yield from rows(0, grams, current)
                    current = chunks[begin]
                raw, off = common.utf8(b.column("text"))
                raw = common.lower_bytes(raw)
                learn = b.column("learn").to_numpy(zero_copy_only=False).astype(bool)
                key, row = symbol_keys(raw, off, depth)
                grams.add(key << np.uint64(1) | learn[row].astype(np.uint64))
                token, token_row = word_tokens(raw, off)
                tokens.add(token[learn[token_row]])
                for kind, counter in ((0, grams), (1, tokens)):
                    if counter.held > MERGE_AT * 3 // 4 and len(counter.parts) == 1:  # all distinct: send and begin anew
                        yield from rows(kind, counter, current if kind == 0 else 0)
        yield from rows(0, grams, current)
        yield from rows(1, tokens, 0)

    return materialize(texts.select("chunk", "text", "learn").mapInArrow(run, "kind int, chunk long, key long, n long"), "key-counts")


# ---- the tree ---------------------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x) for x > 0: Stirling's series above 8, the recurrence below."""
    x = np.asarray(x, float)
    small = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        low = y < 8
        small += np.where(low, np.log(np.where(low, y, 1)), 0)
        y = np.where(low, y + 1, y)
    inverse = 1 / y
    square = inverse * inverse
    series = inverse * (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680)))
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - small


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the KT block probability of so many zeros and ones in any order."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


@dataclass
class Level:
    contexts: np.ndarray  # sorted keys of the kept contexts of this depth
    nodes: np.ndarray  # sorted (context number * 256 + bits known, with a leading one)
    one: np.ndarray  # KT estimate of a one
    other: np.ndarray  # the same for the contexts of the next depth that were not kept
    share: np.ndarray  # weight of the node's own estimate in the mixture


def bit_nodes(context: np.ndarray, symbol: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes with their counts of zeros and ones, from counts of bytes in contexts, sorted by context and byte: then the
    nodes of one bit place come in order, so each place is a running sum."""
    nodes, zeros, ones = [], [], []
    for k in range(8):
        key = context * 256 + ((1 << k) | (symbol >> (8 - k)))
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
        bit = (symbol >> (7 - k)) & 1
        nodes.append(key[first])
        ones.append(np.add.reduceat(n * bit, first) if len(first) else np.zeros(0))
        zeros.append((np.add.reduceat(n, first) if len(first) else np.zeros(0)) - ones[-1])
    node, zeros, ones = np.concatenate(nodes), np.concatenate(zeros), np.concatenate(ones)
    order = np.argsort(node)
    return node[order], zeros[order], ones[order]


def build_tree(tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[Level]:
    """Levels 0 to depth from (context key, byte, count) of the kept contexts of each depth; level 0 has the key 0."""
    levels: list[Level] = []
    below = None  # context's parent number, nodes, zeros, ones and ln P_w of the level below
    for depth in reversed(range(len(tables))):
        key, symbol, n = tables[depth]
        order = np.lexsort((symbol, key))
        key, symbol, n = key[order], symbol[order].astype(np.int64), n[order].astype(float)
        contexts, number = np.unique(key, return_inverse=True)
        node, zeros, ones = bit_nodes(number.astype(np.int64), symbol, n)
        kt = log_kt(zeros, ones)
        rest0, rest1, children = zeros.copy(), ones.copy(), np.zeros(len(node))
        if below is not None and len(below[0]):
            child_contexts, child_node, child0, child1, child_log = below
            parent = np.searchsorted(contexts, child_contexts >> np.uint64(8))
            at = np.searchsorted(node, parent[child_node >> 8] * 256 + (child_node & 255))
            rest0 -= np.bincount(at, child0, len(node))
            rest1 -= np.bincount(at, child1, len(node))
            children = np.bincount(at, child_log, len(node))
        log_w = np.logaddexp(kt, log_kt(rest0, rest1) + children) + np.log(0.5)
        own = (ones + 0.5) / (zeros + ones + 1)
        rest = np.where(rest0 + rest1 > 0, (rest1 + 0.5) / (rest0 + rest1 + 1), own)
        levels.append(Level(contexts, node, own.astype(np.float32), rest.astype(np.float32), np.exp(kt + np.log(0.5) - log_w).astype(np.float32)))
        below = (contexts, node, zeros, ones, log_w)
    return levels[::-1]


def fit_tree(counts: DataFrame, depth: int, most: int) -> list[Level]:
    """The tree cut to ``most`` contexts. ``counts`` has key and n of all (context, byte) pairs."""
    tables = []
    table = counts.select("key", "n")
    for d in range(depth, -1, -1):  # (context of depth d, byte), from the oldest byte dropped
        if d < depth:
            shorter = F.shiftleft(F.shiftrightunsigned("key", 16), 8).bitwiseOR(F.col("key").bitwiseAND(F.lit(255)))
            table = table.select(shorter.alias("key"), "n").groupBy("key").agg(F.sum("n").alias("n"))
            table = materialize(table, "contexts")
        tables.append(table)
    tables.reverse()
    sized = [t.groupBy(F.shiftrightunsigned("key", 8).alias("context")).agg(F.sum("n").alias("total")) for t in tables]
    sized = [materialize(s, "context-sizes") for s in sized]
    histogram: dict[int, int] = {}
    for s in sized:
        for r in s.groupBy(F.floor(F.log2("total")).cast("int").alias("power")).agg(F.count(F.lit(1)).alias("k")).collect():
            histogram[r["power"]] = histogram.get(r["power"], 0) + r["k"]
    kept, power = 0, max(histogram, default=0)
    while power >= 0 and kept + histogram.get(power, 0) <= most:
        kept += histogram.get(power, 0)
        power -= 1
    least = 1 << (power + 1)
    out = []
    for t, s in zip(tables, sized):
        rows = t.withColumn("context", F.shiftrightunsigned("key", 8)).join(s.filter(F.col("total") >= least).select("context"), "context")
        got = rows.select("context", F.col("key").bitwiseAND(F.lit(255)).cast("short").alias("symbol"), "n").toArrow()
        out.append((got.column("context").to_numpy().view(np.uint64), got.column("symbol").to_numpy(), got.column("n").to_numpy()))
    return build_tree(out)


def log10_of(levels: list[Level], keys: np.ndarray) -> np.ndarray:
    """log10 P(byte | context) of each key."""
    depth = len(levels) - 1
    symbol = (keys & np.uint64(255)).astype(np.int64)
    number = np.full((depth + 1, len(keys)), -1, np.int64)
    there = np.ones(len(keys), bool)
    for d, level in enumerate(levels):
        if len(level.contexts) == 0:
            break
        context = keys >> np.uint64(8 * (depth - d + 1)) if d else np.zeros(len(keys), np.uint64)
        at = np.minimum(np.searchsorted(level.contexts, context), len(level.contexts) - 1)
        there &= level.contexts[at] == context
        number[d] = np.where(there, at, -1)
    total = np.zeros(len(keys))
    for k in range(8):
        node = (1 << k) | (symbol >> (8 - k))
        bit = (symbol >> (7 - k)) & 1
        p, left, tail = np.zeros(len(keys)), np.ones(len(keys)), np.full(len(keys), 0.5)
        alive = np.ones(len(keys), bool)
        for d, level in enumerate(levels):
            kept = alive & (number[d] >= 0)
            # a next context that was not kept is one of the "other" contexts; one without data here takes no part
            want = number[d] * 256 + node
            at = np.minimum(np.searchsorted(level.nodes, want), max(len(level.nodes) - 1, 0))
            alive = kept & (level.nodes[at] == want) if len(level.nodes) else np.zeros(len(keys), bool)
            if not alive.any():
                break
            one, share = level.one[at], level.share[at]
            if d < depth:
                p += np.where(alive, left * share * one, 0)
                left = np.where(alive, left * (1 - share), left)
                tail = np.where(alive, np.where(number[d + 1] >= 0, one, level.other[at]), tail)
            else:
                p += np.where(alive, left * one, 0)
                left = np.where(alive, 0, left)
        p += left * tail
        total += np.log10(np.where(bit == 1, p, 1 - p))
    return total


# ---- the whole tree, in parts of its key range ------------------------------------------------


def mixed(d: int, depth: int, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Estimate of a one, share and ln P_w of nodes at depth ``d`` from the sum of their children's ln P_w."""
    kt = log_kt(zeros, ones)
    log_w = kt if d == depth else np.logaddexp(kt, children) + np.log(0.5)
    return (ones + 0.5) / (zeros + ones + 1), np.exp(kt + np.log(0.5) - log_w), log_w


def parents(node: np.ndarray) -> np.ndarray:
    """(context, bits known) nodes of the next smaller depth."""
    return node >> 16 << 8 | node & 255


def grow_part(keys: np.ndarray, n: np.ndarray, depth: int, closed: list | None = None) -> tuple[list[Level], list]:
    """Levels 0 to depth of the contexts in the range of the sorted ``keys``, and of each depth the open nodes: those of
    contexts that hold the first or last key, which other parts may share, as (node, zeros, ones, sum of the finished
    children's ln P_w). ``closed`` has the finished open nodes of all parts as (node, one, share)."""
    ends = keys[[0, -1]]
    key, count = keys[n > 0], n[n > 0].astype(float)
    levels, opened, below = [], [], None
    for d in reversed(range(depth + 1)):
        if d < depth:
            key = key >> np.uint64(16) << np.uint64(8) | key & np.uint64(255)
            order = np.argsort(key, kind="stable")
            key, count = key[order], count[order]
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
            key, count = key[first], np.add.reduceat(count, first) if len(first) else count
        node, zeros, ones = bit_nodes((key >> np.uint64(8)).astype(np.int64), (key & np.uint64(255)).astype(np.int64), count)
        children = np.zeros(len(node)) if below is None else np.bincount(np.searchsorted(node, parents(below[0])), below[1], len(node))
        shared = np.unique(ends >> np.uint64(8 * (depth - d + 1)) if d else ends * np.uint64(0)).astype(np.int64)
        edge = np.isin(node >> 8, shared)
        opened.append((node[edge], zeros[edge], ones[edge], children[edge]))
        node = node[~edge]
        one, share, log_w = mixed(d, depth, zeros[~edge], ones[~edge], children[~edge])
        below = node, log_w
        if closed is not None:
            own = np.isin(closed[d][0] >> 8, shared)
            node, one, share = (np.concatenate([x, y[own]]) for x, y in zip((node, one, share), closed[d]))
            order = np.argsort(node)
            node, one, share = node[order], one[order], share[order]
            contexts, number = np.unique(node >> 8, return_inverse=True)
            levels.append(Level(contexts.astype(np.uint64), number * 256 + (node & 255), one, one, share))
    return levels[::-1], opened[::-1]


def close_nodes(opened: list[list], depth: int) -> list:
    """The open nodes of all parts, finished: of each depth (node, one, share)."""
    out, below = [], None
    for d in reversed(range(depth + 1)):
        all_nodes, zeros, ones, children = (np.concatenate([part[d][i] for part in opened] or [np.zeros(0)]) for i in range(4))
        node, at = np.unique(all_nodes.astype(np.int64), return_inverse=True)
        zeros, ones, children = (np.bincount(at, x, len(node)) for x in (zeros, ones, children))
        if below is not None:
            children += np.bincount(np.searchsorted(node, parents(below[0])), below[1], len(node))
        one, share, log_w = mixed(d, depth, zeros, ones, children)
        below = node, log_w
        out.append((node, one, share))
    return out[::-1]


def pack_part(batches, depth: int):
    """One row for a range of keys: its distinct keys with their counts, which chunk holds which of them, open nodes."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    chunk, key, n = (table.column(c).to_numpy() for c in ("chunk", "key", "n"))
    keys, at = np.unique(key.view(np.uint64), return_inverse=True)
    count = np.bincount(at, n, len(keys)).astype(np.int64)
    order = np.argsort(chunk, kind="stable")
    opened = grow_part(keys, count, depth)[1]
    sizes = np.array([len(x[0]) for x in opened], np.int64)
    nodes = [np.concatenate([x[i] for x in opened]).astype(np.int64 if i == 0 else float) for i in range(4)]
    row = [keys, count, chunk[order], at[order].astype(np.int32), sizes, *nodes]
    yield pa.record_batch([pa.array([x.tobytes()], pa.binary()) for x in row], PACKED)


PACKED = ["keys", "counts", "chunks", "places", "sizes", "nodes", "zeros", "ones", "children"]


def open_nodes(parts: DataFrame) -> list[list]:
    """The open nodes of every part, by depth."""
    out = []
    for r in parts.select("sizes", "nodes", "zeros", "ones", "children").toArrow().to_pylist():
        cuts = np.cumsum(np.frombuffer(r["sizes"], np.int64))[:-1]
        columns = [np.split(np.frombuffer(r[c], np.int64 if c == "nodes" else float), cuts) for c in ("nodes", "zeros", "ones", "children")]
        out.append(list(zip(*columns)))
    return out


def key_scores(counts: DataFrame, depth: int, most: int | None) -> DataFrame:
    """(chunk, keys, logs): the sorted keys of a part's range that a chunk holds, and log10 P(byte | context) of each."""
    spark = counts.sparkSession
    n_parts = -(-counts.count() // PART_ROWS) or 1
    ranged = counts.select("chunk", "key", "n").repartitionByRange(n_parts, "key")
    parts = materialize(ranged.mapInArrow(lambda b: pack_part(b, depth), ", ".join(f"{c} binary" for c in PACKED)), "tree-parts")
    if most is None:
        shared = spark.sparkContext.broadcast(close_nodes(open_nodes(parts), depth))
    else:
        learned = counts.filter("n > 0").groupBy("key").agg(F.sum("n").alias("n"))
        shared = spark.sparkContext.broadcast(fit_tree(learned, depth, most))

    def run(batches):
        for b in batches:
            for r in range(b.num_rows):
                keys, count, chunk, place = (np.frombuffer(b.column(i)[r].as_buffer(), t) for i, t in enumerate((np.uint64, np.int64, np.int64, np.int32)))
                logs = log10_of(grow_part(keys, count, depth, shared.value)[0] if most is None else shared.value, keys)
                cuts = np.append(np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])), len(chunk))
                for begin, end in zip(cuts[:-1], cuts[1:]):
                    own = np.unique(place[begin:end])
                    yield pa.record_batch([pa.array([chunk[begin]]), pa.array([keys[own].tobytes()], pa.binary()), pa.array([logs[own].tobytes()], pa.binary())],
                                          ["chunk", "keys", "logs"])

    return parts.select(*PACKED[:4]).mapInArrow(run, "chunk long, keys binary, logs binary")


def joined(scores: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a chunk, sorted, and their scores: the ranges of the parts are disjoint, so they only need to stand in order."""
    pairs = [(np.frombuffer(k.as_buffer(), np.uint64), np.frombuffer(v.as_buffer(), float)) for k, v in zip(scores.column("keys"), scores.column("logs"))]
    pairs.sort(key=lambda p: int(p[0][0]))
    return tuple(np.concatenate([p[i] for p in pairs] or [np.zeros(0, t)]) for i, t in enumerate((np.uint64, float)))


def score(docs: DataFrame, learn: Column, depth: int = DEPTH, most: int | None = None, frequent: int = FREQUENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, n_known, train_tokens, base_score, score, n_bytes."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", common.text_of(docs).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    texts = dealt(rows, kind)
    counts = key_counts(texts, depth)
    words = materialize(counts.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n")), "words")
    stats = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    n_all, n_distinct = int(stats[0] or 0), int(stats[1])
    histogram = {r["power"]: r["k"] for r in words.groupBy(F.floor(F.log2("n")).cast("int").alias("power")).agg(F.count(F.lit(1)).alias("k")).collect()}
    kept, power = 0, max(histogram, default=0)
    while power >= 0 and kept + histogram.get(power, 0) <= frequent:
        kept += histogram.get(power, 0)
        power -= 1
    got = words.filter(F.col("n") >= (1 << (power + 1))).toArrow()
    word_keys, word_n = got.column("key").to_numpy().view(np.uint64), got.column("n").to_numpy()
    order = np.argsort(word_keys)
    scale = np.log10(n_all + 0.5 * (n_distinct + 1))
    shared = spark.sparkContext.broadcast((word_keys[order], word_n[order]))
    unseen_known = power < 0  # every training word is in the table, so any other has the count 0

    def run(texts_of_chunk: pa.Table, scores: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(scored_rows(texts_of_chunk, scores)), fields)

    def scored_rows(texts_of_chunk, scores):
        keys, n = shared.value
        known, logs = joined(scores)
        for b in common.pieces(texts_of_chunk.to_batches(), most=PIECE):
            raw, off = common.utf8(b.column("text"))
            raw = common.lower_bytes(raw)
            m = b.num_rows
            key, row = symbol_keys(raw, off, depth)
            distinct, inverse = np.unique(key, return_inverse=True)
            model = np.bincount(row, weights=logs[np.searchsorted(known, distinct)][inverse], minlength=m)
            token, token_row = word_tokens(raw, off)
            at = np.minimum(np.searchsorted(keys, token), max(len(keys) - 1, 0))
            held = keys[at] == token if len(keys) else np.zeros(len(token), bool)
            c = np.where(held, n[at] if len(n) else 0, 0)
            sure = held | unseen_known
            base = np.bincount(token_row[sure], weights=np.log10(c[sure] + 0.5) - scale, minlength=m)
            rare_row, rare = token_row[~sure], token[~sure].view(np.int64)
            by_row = np.argsort(rare_row, kind="stable")
            ends = np.searchsorted(rare_row[by_row], np.arange(m + 1))
            yield pa.record_batch([
                b.column("uid"), b.column("doc_id"), pa.array(np.diff(off)), pa.array(np.bincount(token_row, minlength=m)),
                pa.array(np.bincount(token_row[held], minlength=m)), pa.array(base.astype(float)), pa.array(model.astype(float)),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(rare[by_row]))], schema=fields)

    fields = pa.schema([("uid", pa.int64()), ("doc_id", to_arrow_type(texts.schema["doc_id"].dataType)), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                        ("n_held", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("rare", pa.list_(pa.int64()))])
    of_chunk = key_scores(counts.filter("kind = 0"), depth, most).groupBy("chunk")
    scored = materialize(texts.select("chunk", "uid", "doc_id", "text").groupBy("chunk").cogroup(of_chunk).applyInArrow(
        run, f"uid long, doc_id {kind}, n_bytes long, n_tokens long, n_held long, base double, score double, rare array<long>"), "scored")
    rare = scored.select("uid", F.explode("rare").alias("key")).groupBy("uid", "key").agg(F.count(F.lit(1)).alias("k"))
    found = rare.join(words, "key", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = found.groupBy("uid").agg(F.sum(F.col("k") * (F.log10(F.col("n") + 0.5) - F.lit(float(scale)))).alias("rare_base"),
                                    F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("rare_known"))
    return scored.drop("rare").join(sums, "uid", "left").select(
        "doc_id", "n_tokens", (F.col("n_held") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"), "score", "n_bytes")
