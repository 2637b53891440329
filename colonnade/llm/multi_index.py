"""Hard negatives from an inverted multi-index.

Vectors are cut in two halves. Each half has a codebook (k-means on a bounded sample, every row is indexed): a row's cell is its
pair of nearest codewords, and each codeword has a radius, the greatest distance of a row's half from it. For an anchor q a
half-score bound of a codeword c is ``q.c + |q| radius`` on that half; the sum of two bounds all rows of a cell. The
multi-sequence heap pops cells by falling sums: from (i, j) in the two sorted codebooks it pushes (i + 1, j) and (i, j + 1).

First the ``k`` best rows of the anchor's own label are searched: an anchor is done when its k-th best score is above the
bound of the next cell. Then, for each of these positives, the best rows of other labels within the window of scores
``low * positive <= 100 * score <= 100 * positive``: a window is certified when it has k rows and the next bound is below the
last of them, or when the next bound is below the window. Anchors go on in rounds that visit ever larger shares of the rows
(``SHARES``, the last is all of them); cells are joined in blocks of bounded size, so a cell may hold any number of rows.

Defined cases: see ``vectors`` for rows that take no part, unequal lengths and repeated ids (of rows that share an id the one with
the smallest vector, then label, counts). Null ids and null labels take no part. Ties go to the smaller id; fewer rows than k
give what there is; an anchor without positives, or a window without rows, gives none. Other columns are ignored. Scores
beyond the range of a long are undefined.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colonnade.llm import vectors
from colonnade.session import materialize

CODEWORDS = 16  # of each half
SAMPLE = 8192  # rows to which the codebooks are fitted
ROUNDS = 12
SHARES = (1 / 32, 1 / 4, 1.0)  # of the rows that an anchor has visited after each round, at least
BLOCK = 4096
GROUP = 1024
LOW = 80  # per cent of the positive's score at which the window begins


class Index:
    """Two codebooks with radii and the number of rows in each cell (i * codewords + j); at most codewords^2 numbers."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.books = (first, second)
        self.half = first.shape[1]
        self.width = max(len(second), 1)
        self.radii = (np.zeros(len(first)), np.zeros(len(second)))
        self.rows: dict[int, int] = {}

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, :self.half], x[:, self.half:]

    def assign(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Codeword of each half of each row and the distance from it."""
        code, far = [], []
        for part, book in zip(self.halves(x.astype(float)), self.books):
            square = (part * part).sum(1)[:, None] - 2 * part @ book.T + (book * book).sum(1)[None, :]
            code.append(square.argmin(1))
            far.append(np.sqrt(((part - book[code[-1]]) ** 2).sum(1)))
        return code, far

    def half_scores(self, q: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Scores of the codewords of each half with ``q``, and how far a row's may lie from them."""
        centre, spread = [], []
        for part, book, radius in zip(self.halves(q[None, :].astype(float)), self.books, self.radii):
            centre.append(book @ part[0])
            spread.append(np.linalg.norm(part[0]) * radius * (1 + 1e-9) + 1e-9 * (np.abs(book) @ np.abs(part[0])) + 0.5)
        return centre, spread

    def visits(self, q: np.ndarray):
        """(upper bound, lower bound, cell) of the cells with rows, by falling upper bound: the multi-sequence heap."""
        centre, spread = self.half_scores(q)
        high = [c + s for c, s in zip(centre, spread)]
        low = [c - s for c, s in zip(centre, spread)]
        order = [np.argsort(-h, kind="stable") for h in high]
        heap, pushed = [], set()

        def push(i, j):
            if i < len(order[0]) and j < len(order[1]) and (i, j) not in pushed:
                pushed.add((i, j))
                heapq.heappush(heap, (-(high[0][order[0][i]] + high[1][order[1][j]]), i, j))

        push(0, 0)
        while heap:
            bound, i, j = heapq.heappop(heap)
            push(i + 1, j)
            push(i, j + 1)
            a, b = int(order[0][i]), int(order[1][j])
            if self.rows.get(a * self.width + b):
                yield -bound, low[0][a] + low[1][b], a * self.width + b


def codebook(x: np.ndarray, n: int, rounds: int = ROUNDS) -> np.ndarray:
    """k-means from spread-out rows of a bounded sample."""
    x = x.astype(float)
    distinct = np.unique(x, axis=0)
    if len(distinct) <= n:
        return distinct
    centres = [distinct[0]]
    near = ((distinct - centres[0]) ** 2).sum(1)
    while len(centres) < n:
        centres.append(distinct[near.argmax()])
        near = np.minimum(near, ((distinct - centres[-1]) ** 2).sum(1))
    centres = np.array(centres)
    for _ in range(rounds):
        own = ((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None, :]).argmin(1)
        size = np.bincount(own, minlength=n)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    return centres


def build(rows: DataFrame, codewords: int, most: int) -> tuple[DataFrame, Index]:
    """``rows`` (vec_id, label, x) with their cells, written, and the index."""
    _, some = vectors.sample(rows, most)
    half = (some.shape[1] + 1) // 2
    index = Index(codebook(some[:, :half], codewords), codebook(some[:, half:], codewords))

    def run(batches):
        for b in batches:
            if b.num_rows:
                code, far = index.assign(vectors.matrix(b.column("x")))
                yield pa.record_batch([*b.columns, pa.array((code[0] * index.width + code[1]).astype(np.int32)), pa.array(far[0]), pa.array(far[1])],
                                      ["vec_id", "label", "x", "cell", "far_0", "far_1"])

    table = materialize(rows.select("vec_id", "label", "x").mapInArrow(run, "vec_id long, label long, x array<long>, cell int, far_0 double, far_1 double"), "multi-index")
    for r in table.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far_0").alias("far_0"), F.max("far_1").alias("far_1")).collect():
        index.rows[r["cell"]] = r["n"]
        for h, code in enumerate(divmod(r["cell"], index.width)):
            index.radii[h][code] = max(index.radii[h][code], r[f"far_{h}"])
    return table.select("vec_id", "label", "x", "cell"), index


ANCHOR = "anchor_id long, label long, x array<long>, highs array<long>, lows array<long>, seen int"


def visited(anchors: DataFrame, index: Index, upto: float) -> DataFrame:
    """``anchors`` with the cells of this round, the number of cells seen after it, and the bound of the next cell (null: none is left).
    Cells above the highest window are passed over."""
    total = sum(index.rows.values())

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cells, seen, bounds = [], [], []
            for x, highs, skip in zip(vectors.matrix(b.column("x")), b.column("highs").to_pylist(), b.column("seen").to_pylist()):
                top = max(highs) if highs else float("inf")
                own, rows, n, bound = [], 0, 0, None
                for high, low, cell in index.visits(x):
                    if n >= skip and rows >= upto * total:
                        bound = high
                        break
                    rows += index.rows[cell]
                    n += 1
                    if n > skip and low <= top:
                        own.append(cell)
                cells.append(own)
                seen.append(n)
                bounds.append(bound)
            kept = [b.column(c) for c in ("anchor_id", "label", "x", "highs", "lows")]
            yield pa.record_batch([*kept, pa.array(seen, pa.int32()), pa.array(cells, pa.list_(pa.int32())), pa.array(bounds, pa.float64())],
                                  ["anchor_id", "label", "x", "highs", "lows", "seen", "cells", "bound"])

    return materialize(anchors.select("anchor_id", "label", "x", "highs", "lows", "seen").mapInArrow(run, ANCHOR + ", cells array<int>, bound double"), "visits")


def same_label(ids, labels, scores, anchor, label, highs, lows, k):
    """The k best other rows of the anchor's label."""
    own = np.flatnonzero((labels == label) & (ids != anchor) & (scores >= lows[0]))
    top = own[vectors.best_first(scores[own], ids[own], k)]
    return [(0, top)]


def in_windows(ids, labels, scores, anchor, label, highs, lows, k):
    """The k best rows of other labels in every window."""
    own = np.flatnonzero((labels != label) & (ids != anchor) & (scores <= max(highs)) & (scores >= min(lows)))
    own = own[np.lexsort((ids[own], -scores[own]))]
    falling = -scores[own]
    for j, (high, low) in enumerate(zip(highs, lows)):
        begin, end = np.searchsorted(falling, -high, "left"), np.searchsorted(falling, -low, "right")
        yield j, own[begin:min(end, begin + k)]


LOWEST = -(1 << 62)


def search(table: DataFrame, index: Index, anchors: DataFrame, take, k: int, block: int, group: int) -> DataFrame:
    """(anchor_id, j, vec_id, score, rank): the first k rows of each window j of each anchor that ``take`` finds in the cells, which
    are visited until every window is certified."""
    total = None
    rest = anchors

    def compare(rows_in: pa.Table, asks_in: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)] for _ in range(4)]
        if rows_in.num_rows and asks_in.num_rows:
            ids, labels = rows_in.column("vec_id").to_numpy(), rows_in.column("label").to_numpy()
            scores = vectors.inner(vectors.matrix(asks_in.column("x")), vectors.matrix(rows_in.column("x")))
            asked = zip(asks_in.column("anchor_id").to_pylist(), asks_in.column("label").to_pylist(), asks_in.column("highs").to_pylist(), asks_in.column("lows").to_pylist())
            for s, (anchor, label, highs, lows) in zip(scores, asked):
                for j, places in take(ids, labels, s, anchor, label, highs, lows, k):
                    for column, values in zip(out, (np.full(len(places), anchor), np.full(len(places), j), ids[places], s[places])):
                        column.append(values)
        return pa.table([np.concatenate(c) for c in out], ["anchor_id", "j", "vec_id", "score"])

    best = Window.partitionBy("anchor_id", "j").orderBy(F.col("score").desc(), "vec_id")
    for upto in SHARES:
        plan = visited(rest, index, upto)
        asks = plan.select("anchor_id", "label", "x", "highs", "lows", F.explode("cells").alias("cell"))
        asks_of = {r["cell"]: r["n"] for r in asks.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        found = vectors.in_blocks(table, asks, index.rows, asks_of, block, group, "vec_id", "anchor_id").applyInArrow(
            compare, "anchor_id long, j long, vec_id long, score long")
        found = materialize(found, "block-bests")
        total = found if total is None else total.select("anchor_id", "j", "vec_id", "score").unionByName(found)
        total = materialize(total.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "bests")
        if upto >= 1:
            break
        # a window goes on while the next cell may hold a row that it still wants
        last = total.filter(F.col("rank") == k).select("anchor_id", "j", F.col("score").alias("last"))
        windows = plan.filter("bound is not null").select("anchor_id", "label", "x", "seen", "bound", F.posexplode(F.arrays_zip("highs", "lows")).alias("j", "window"))
        windows = windows.join(last, ["anchor_id", "j"], "left").select(
            "anchor_id", "label", "x", "seen", "bound", "j", F.col("window.highs").alias("high"), F.greatest("window.lows", F.coalesce("last", F.lit(LOWEST))).alias("low"))
        goes_on = (F.col("bound") >= F.col("low")) & (F.col("low") <= F.col("high"))
        rest = windows.groupBy("anchor_id").agg(F.any_value("label").alias("label"), F.any_value("x").alias("x"), F.any_value("seen").alias("seen"),
                                                F.array_sort(F.collect_list(F.struct("j", "high", "low"))).alias("w"), F.max(goes_on).alias("more"))
        rest = rest.filter("more").select("anchor_id", "label", "x", F.transform("w", lambda w: w["high"]).alias("highs"), F.transform("w", lambda w: w["low"]).alias("lows"), "seen")
        rest = materialize(rest, "open-anchors")
        if rest.isEmpty():
            break
    return total


def mine(embeddings: DataFrame, anchors: Column, label: Column, k: int = 5, codewords: int = CODEWORDS, block: int = BLOCK, group: int = GROUP, most: int = SAMPLE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for each row for which ``anchors`` holds and each
    of its k best rows of the same ``label``, the first k rows of other labels in the positive's window."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), "embedding").filter("vec_id is not null and label is not null")
    one = vectors.integer_rows(rows).groupBy("vec_id").agg(F.min(F.struct("x", "label")).alias("r"))
    rows = materialize(one.select("vec_id", "r.label", "r.x"), "labelled-vectors")
    if rows.isEmpty():
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    table, index = build(rows, codewords, most)
    nothing = F.array(F.lit((1 << 62)))
    begin = table.filter(anchors).select(F.col("vec_id").alias("anchor_id"), "label", "x", nothing.alias("highs"), F.array(F.lit(LOWEST)).alias("lows"), F.lit(0).alias("seen"))
    positives = search(table, index, begin, same_label, k, block, group)
    positives = positives.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), (F.col("rank") - 1).alias("j"))
    low = F.expr(f"positive_score * {LOW} div 100 + if(positive_score * {LOW} % 100 > 0, 1, 0)")  # rounded up
    listed = positives.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("j", F.col("positive_score").alias("high"), low.alias("low")))).alias("w"))
    asked = begin.select("anchor_id", "label", "x", "seen").join(listed, "anchor_id").select(
        "anchor_id", "label", "x", F.transform("w", lambda w: w["high"]).alias("highs"), F.transform("w", lambda w: w["low"]).alias("lows"), "seen")
    negatives = search(table, index, materialize(asked, "windows"), in_windows, k, block, group)
    return positives.join(negatives, ["anchor_id", "j"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
