"""Exact top-k search by inner product with a pivot table.

``PIVOTS`` rows, spread out by farthest-first choice from a bounded sample, are pivots. Every row's distances to all pivots
are computed once and written: the pivot table. For a query q and a row x the triangle inequality gives
``|q - x| >= max over pivots |d(q, p) - d(x, p)|``, and with the norms an upper bound of the score:
``q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2``. Rows are dealt into cells by their nearest pivot; a cell's extremes of every pivot's
distance bound all its rows at once, so a query meets only cells that may hold one of its best. Its first threshold is the
k-th best score among the sampled rows. Inside a block of a cell, rows whose bound is below the threshold are eliminated, the
others are evaluated in the order of their bounds, and evaluation stops when the next bound is below the k-th best score so far.

Bounds are in single precision, widened by more than their rounding error; scores are exact integers.

Defined cases: see ``vectors`` for rows that take no part, unequal lengths and repeated ids. A null id is no row. Ties go to the
smaller id; with fewer than k others a query returns all of them; without queries or rows the result is empty. Other columns
are ignored. Scores beyond the range of a long are undefined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colonnade.llm import vectors
from colonnade.session import materialize

PIVOTS = 32
SAMPLE = 4096  # rows among which pivots are chosen and first thresholds are found
BLOCK = 4096  # rows that one task compares
GROUP = 1024  # queries that it compares them with
FIRST = 256  # candidates of a query evaluated at first; then twice as many each time


def choose_pivots(x: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each further pivot is the row whose nearest pivot is farthest away. Fewer if rows repeat."""
    x = x.astype(float)
    if len(x) == 0:
        return x
    picked = [0]
    near = ((x - x[0]) ** 2).sum(1)
    while len(picked) < min(n, len(x)) and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, ((x - x[picked[-1]]) ** 2).sum(1))
    return x[picked]


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of every row to every pivot, by differences (exact to rounding)."""
    out = np.empty((len(x), len(pivots)))
    for p, pivot in enumerate(pivots):
        out[:, p] = np.sqrt(((x - pivot) ** 2).sum(1))
    return out


def upper_bounds(gap: np.ndarray, reach: np.ndarray, q_square: np.ndarray, x_square: np.ndarray) -> np.ndarray:
    """Highest possible score given a lower bound ``gap`` of the distance, which rounding may have raised by a millionth of ``reach``."""
    gap = np.maximum(gap - 1e-6 * reach, 0)
    bound = (q_square + x_square - gap * gap) / 2
    return bound + 1e-9 * (q_square + x_square) + 1


def pivot_table(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """vec_id, x, cell (nearest pivot), square (squared norm) and d (distances to the pivots) of every row, written."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = vectors.matrix(b.column("x")).astype(float)
                d = pivot_distances(x, pivots)
                yield pa.record_batch([b.column("vec_id"), b.column("x"), pa.array(d.argmin(1).astype(np.int32)), pa.array((x * x).sum(1)), vectors.lists(d)],
                                      ["vec_id", "x", "cell", "square", "d"])

    return materialize(rows.select("vec_id", "x").mapInArrow(run, "vec_id long, x array<long>, cell int, square double, d array<double>"), "pivot-table")


def cell_extremes(table: DataFrame, n: int) -> tuple[dict[int, int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of every cell with rows: number of rows, and (cells, least and greatest distance to each pivot, greatest squared norm).
    At most ``n`` cells of ``n`` pairs."""
    counts = {r["cell"]: r for r in table.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.max("square").alias("square")).collect()}
    each = table.select("cell", F.posexplode("d")).groupBy("cell", "pos").agg(F.min("col").alias("lo"), F.max("col").alias("hi")).collect()
    cells = np.array(sorted(counts), np.int32)
    lo, hi = np.zeros((len(cells), n)), np.zeros((len(cells), n))
    for r in each:
        at = np.searchsorted(cells, r["cell"])
        lo[at, r["pos"]], hi[at, r["pos"]] = r["lo"], r["hi"]
    return {c: r["rows"] for c, r in counts.items()}, cells, lo, hi, np.array([counts[c]["square"] for c in cells])


def top_of_block(ids, x, square, d, asks, own, q_square, q_d, least, k):
    """Of one block, each question's k best rows: (question number, row number, score). The pivot table orders and
    eliminates the rows; only rows that may still enter are scored."""
    reach = float(max(d.max(), q_d.max()))
    d32, q32 = np.ascontiguousarray(d.T, np.float32), q_d.astype(np.float32)
    gap = np.empty(len(x), np.float32)
    out = []
    for i in range(len(asks)):
        gap[:] = 0
        for p in range(len(d32)):
            np.maximum(gap, np.abs(d32[p] - q32[i, p]), out=gap)
        bound = upper_bounds(gap.astype(float), reach, q_square[i], square)
        alive = np.flatnonzero((bound >= least[i]) & (ids != own[i]))
        alive = alive[np.argsort(-bound[alive], kind="stable")]
        places, scores, at, step = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, FIRST
        while at < len(alive):
            if len(places) == k and bound[alive[at]] < scores[-1]:
                break
            part = alive[at:at + step]
            places = np.concatenate([places, part])
            scores = np.concatenate([scores, vectors.inner(asks[i:i + 1], x[part])[0]])
            top = vectors.best_first(scores, ids[places], k)
            places, scores = places[top], scores[top]
            at, step = at + step, step * 2
        out.append((np.full(len(places), i), places, scores))
    return tuple(np.concatenate([o[j] for o in out] or [np.zeros(0, np.int64)]) for j in range(3))


def top_k(embeddings: DataFrame, queries: Column, k: int = 5, n_pivots: int = PIVOTS, block: int = BLOCK, group: int = GROUP, most: int = SAMPLE) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` best other rows of every row for which ``queries`` holds."""
    spark = embeddings.sparkSession
    rows = vectors.integer_rows(embeddings.filter("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"))
    rows = materialize(rows.groupBy("vec_id").agg(F.min("x").alias("x")), "vectors")
    seed_ids, seeds = vectors.sample(rows, most)
    pivots = choose_pivots(seeds, n_pivots)
    if len(pivots) == 0:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    table = pivot_table(rows, pivots)
    rows_of, cells, lo, hi, cell_square = cell_extremes(table, len(pivots))

    def ask(batches):  # first thresholds, and the cells that may reach them
        for b in batches:
            if not b.num_rows:
                continue
            ids, x, d, square = b.column("vec_id").to_numpy(), vectors.matrix(b.column("x")), vectors.matrix(b.column("d"), float), b.column("square").to_numpy()
            score = vectors.inner(x, seeds)
            least = np.full(len(ids), float("-inf"))
            for i in range(len(ids)):
                others = score[i][seed_ids != ids[i]]
                if len(others) >= k:
                    least[i] = np.partition(others, len(others) - k)[len(others) - k]
            number, cell = [], []
            for i in range(len(ids)):
                gap = np.maximum(np.maximum(d[i] - hi, lo - d[i]).max(1), 0)
                reach = float(max(hi.max(), d[i].max()))
                may = np.flatnonzero(upper_bounds(gap, reach, square[i], cell_square) >= least[i])
                number.append(np.full(len(may), i))
                cell.append(cells[may])
            at = pa.array(np.concatenate(number))
            yield pa.record_batch([b.column("vec_id").take(at), b.column("x").take(at), b.column("square").take(at), b.column("d").take(at), pa.array(least).take(at), pa.array(np.concatenate(cell))],
                                  ["query_id", "x", "square", "d", "least", "cell"])

    asked = materialize(table.filter(queries).select("vec_id", "x", "square", "d").mapInArrow(
        ask, "query_id long, x array<long>, square double, d array<double>, least double, cell int"), "asked")
    asks_of = {r["cell"]: r["n"] for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}

    def compare(rows_in: pa.Table, asks_in: pa.Table) -> pa.Table:
        if rows_in.num_rows == 0 or asks_in.num_rows == 0:
            return pa.table([pa.array([], pa.int64())] * 3, ["query_id", "vec_id", "score"])
        ids, own = rows_in.column("vec_id").to_numpy(), asks_in.column("query_id").to_numpy()
        q, r, s = top_of_block(ids, vectors.matrix(rows_in.column("x")), rows_in.column("square").to_numpy(), vectors.matrix(rows_in.column("d"), float),
                               vectors.matrix(asks_in.column("x")), own, asks_in.column("square").to_numpy(), vectors.matrix(asks_in.column("d"), float),
                               asks_in.column("least").to_numpy(), k)
        return pa.table([pa.array(own[q]), pa.array(ids[r]), pa.array(s)], ["query_id", "vec_id", "score"])

    found = vectors.in_blocks(table, asked, rows_of, asks_of, block, group, "vec_id", "query_id").applyInArrow(compare, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = materialize(found, "block-bests").withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
