"""Whitened principal components by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

The fit list is each distinct vector once: n rows with sums S. A is the n x d matrix of the rows minus S / n, over sqrt(n).
A step multiplies by A and by its transpose: one pass over the written fit list gives, for the direction v of the step, the sums
of A'(Av), of |Av|^2 and of Av against every earlier left vector. Left vectors are never stored: each is A p for a vector p of
length d that the driver keeps, so a pass computes the rows' entries of all of them anew. Left vectors are orthogonalised against
all earlier ones by those sums, right vectors against all earlier ones on the driver (twice). Where a vector vanishes (the Krylov space
is exhausted, as it is when an eigenvalue repeats), the process goes on with a new direction orthogonal to all earlier ones, so
d steps give the whole bidiagonal matrix. Its singular values and right vectors, an SVD of at most d x d numbers, are those of A:
the components, and the deviations along them.

n, S and the sum of squares are exact integers; partial sums of a pass are added up by Spark, in two stages where there are many
partitions. The driver holds a few d x d matrices.

Defined cases: see ``vectors`` for rows that take no part and unequal lengths; every remaining row is returned, rows that share an id
and null ids as well. Components whose variance is zero to rounding do not exist, so a table with fewer than two different
vectors gives no rows. The entry of a component that is largest in absolute value is positive. A deviation beyond the range of
a long is null. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.llm import vectors
from colonnade.session import materialize

COMPONENTS = 4
MOST_PARTS = 256  # partial sums that the driver adds up itself
VANISHED = 1e-7  # of the largest norm so far: what is left of a vector that lies in the space of the earlier ones
LONGEST = (1 << 63) - 1


def added_up(rows: DataFrame, columns: list[str], partial) -> np.ndarray:
    """The sum of ``partial(matrix)`` (a vector of doubles) over Arrow batches of the list column x. Each task adds its batches; above
    ``MOST_PARTS`` tasks their sums are added in about as many groups as the root of their number before the driver adds those."""

    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                part = partial(vectors.matrix(b.column("x"), float))
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def again(batches):
        total = None
        for b in batches:
            for value in b.column("sums"):
                part = np.frombuffer(value.as_buffer())
                total = part if total is None else total + part
        if total is not None:
            yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["sums"])

    parts = rows.select(*columns).mapInArrow(run, "sums binary")
    n = rows.rdd.getNumPartitions()
    if n > MOST_PARTS:
        parts = parts.repartition(math.ceil(math.sqrt(n))).mapInArrow(again, "sums binary")
    got = parts.toArrow().column("sums")
    return sum(np.frombuffer(v.as_buffer()) for v in got) if len(got) else np.zeros(0)


def exact_totals(rows: DataFrame) -> tuple[int, list[int], int]:
    """Number of rows, the sum of each entry, and the sum of all squares, as exact integers (decimal sums in Spark)."""
    n = rows.count()
    each = rows.select(F.posexplode("x").alias("i", "c")).withColumn("c", F.col("c").cast("decimal(19,0)")).groupBy("i").agg(
        F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("square")).collect()
    sums = [0] * len(each)
    for r in each:
        sums[r["i"]] = int(r["s"])
    return n, sums, sum(int(r["square"]) for r in each)


def without(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """``v`` made orthogonal to the orthonormal ``basis``, twice against rounding."""
    if basis:
        b = np.array(basis)
        for _ in range(2):
            v = v - b.T @ (b @ v)
    return v


def bidiagonalise(rows: DataFrame, mean: np.ndarray, n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(B, V): the d x d upper bidiagonal matrix and the right vectors (columns), A V = U B."""
    d = len(mean)
    rng = np.random.default_rng(seed)
    root = math.sqrt(n)

    def fresh(basis):
        while True:
            v = without(rng.standard_normal(d), basis)
            if np.linalg.norm(v) > 1e-3:
                return v / np.linalg.norm(v)

    def products(v: np.ndarray, left: list[np.ndarray]):
        """A'(A v), |A v|^2 and A v against the left vectors A p."""
        maps = np.array([v, *left]).T / root

        def partial(x):
            a = x - mean
            t = a @ maps
            return np.concatenate([a.T @ t[:, 0] / root, t.T @ t[:, 0]])

        out = added_up(rows, ["x"], partial)
        return out[:d], out[d], out[d + 1:]

    right, left, gradients = [fresh([])], [], []  # gradients: A' of the left vectors
    b = np.zeros((d, d))
    largest = 0.0
    for k in range(d):
        v = right[k]
        p, g, norm = v, None, 0.0
        for _ in range(2):  # again where most of it went, so that the difference of sums is not rounding
            g, square, dots = products(p, left)
            if left:
                p = p - np.array(left).T @ dots
                g = g - np.array(gradients).T @ dots
            whole, rest = square, max(square - float(dots @ dots), 0.0)
            norm = math.sqrt(rest)
            if rest > 0.1 * whole or not left:
                break
        largest = max(largest, norm)
        if norm <= VANISHED * largest or norm == 0.0:  # A v lies in the space of the earlier left vectors
            norm = 0.0
            g = np.zeros(d)
        else:
            p, g = p / norm, g / norm
        b[k, k] = norm
        if norm:
            left.append(p)
            gradients.append(g)
        else:
            left.append(np.zeros(d))
            gradients.append(np.zeros(d))
        if k + 1 < d:
            w = without(g - norm * v, right)
            beta = float(np.linalg.norm(w))
            if beta <= VANISHED * largest or beta == 0.0:
                right.append(fresh(right))
            else:
                b[k, k + 1] = beta
                right.append(without(w / beta, right))
                right[-1] /= np.linalg.norm(right[-1])
    return b, np.array(right).T


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of each remaining row and component."""
    spark = embeddings.sparkSession
    rows = materialize(vectors.integer_rows(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")), "vectors")
    fit = materialize(rows.select("x").distinct(), "fit-list")
    n, sums, squares = exact_totals(fit)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    trace = n * squares - sum(s * s for s in sums)  # n^2 times the trace of the covariance
    if not trace:
        return spark.createDataFrame([], schema)
    mean = np.array([s / n for s in sums])
    b, right = bidiagonalise(fit, mean, n)
    _, sigma, turn = np.linalg.svd(b)
    axes = (right @ turn.T)[:, :components]
    sigma = sigma[:components]
    real = sigma > 1e-10 * sigma[0]
    axes, sigma = axes[:, real], sigma[real]
    k = len(sigma)
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(k)])
    scale = axes / sigma
    share = sigma ** 2 / (trace / n ** 2)

    def second_moment(x):
        w = (x - mean) @ scale
        return np.concatenate([w.sum(0), (w.T @ w).ravel()])

    moments = added_up(fit, ["x"], second_moment)
    centre = moments[:k] / n
    error = float(np.abs(moments[k:].reshape(k, k) / n - np.outer(centre, centre) - np.eye(k)).max())
    largest = max(abs(s) for s in sums)

    def deviations(x: np.ndarray) -> list[int | None]:
        if (float(n) * float(np.abs(x).max(initial=0)) + largest) ** 2 * x.shape[1] < LONGEST:
            return ((x * n - np.array(sums, np.int64)) ** 2).sum(1).tolist()
        exact = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
        return [v if v <= LONGEST else None for v in exact]

    def project(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                x = vectors.matrix(b.column("x"))
                m = len(x)
                again = pa.array(np.repeat(np.arange(m), k))
                yield pa.record_batch([b.column("vec_id").take(again), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)),
                                       pa.array(deviations(x), pa.int64()).take(again), pa.array(((x - mean) @ scale).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * k, error))],
                                      ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.select("vec_id", "x").mapInArrow(project, schema)
