"""Spectral embeddings and clusters from the eigenvectors of a graph's affinity.

For a symmetric affinity A with row sums D the leading eigenvectors of ``M = D^-1/2 A D^-1/2`` come from a block Lanczos process
with restarts. A step multiplies the last block of the basis by M: for a graph of edges that is a join and an aggregate, for the rbf
kernel ``exp(-gamma d^2)`` blocks of points are compared and only the products leave a block (the n x n kernel is never written).
All inner products of the basis and its images are sums that Spark adds up; the driver sees matrices of (block x steps)^2
numbers. The small Rayleigh-Ritz problem gives the leading vectors and their residuals; the process starts anew from them until
all residuals are below the tolerance. Blocks find eigenvalues that repeat, as they do in a graph of several components.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.ml.neighbors import Space, knn_graph, matrix
from colonnade.session import materialize

STEPS = 6  # blocks of the basis before a restart
EXTRA = 2  # a block has twice the vectors that are wanted, and so many more: the wider, the faster it converges


def lists(rows: np.ndarray) -> pa.Array:
    n, d = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * d, pa.int32()), pa.array(np.ascontiguousarray(rows).ravel()))


class GraphAffinity:
    """Edges (src, dst, weight), symmetric."""

    def __init__(self, edges: DataFrame, vertices: DataFrame):
        self.edges = materialize(edges.select("src", "dst", "weight"), "edges")
        self.vertices = vertices.select("id")

    def times(self, x: DataFrame, width: int) -> DataFrame:
        """(id, y) with y = A x for x (id, x array<double>)."""
        joined = self.edges.join(x.withColumnRenamed("id", "dst"), "dst")
        sums = joined.groupBy("src").agg(*[F.sum(F.col("weight") * F.col("x")[k]).alias(f"y{k}") for k in range(width)])
        return sums.select(F.col("src").alias("id"), F.array(*[f"y{k}" for k in range(width)]).alias("y"))


class RbfAffinity:
    """exp(-gamma d^2) between all points of a space."""

    def __init__(self, space: Space, gamma: float):
        self.space, self.gamma = space, gamma
        self.vertices = space.points.select(F.col("_id").alias("id"))
        self.sent = space.sent(space.asks(float("inf")), space.sizes, space.radius)

    def times(self, x: DataFrame, width: int) -> DataFrame:
        space, gamma = self.space, self.gamma

        def compare(a, p):
            q, v, have = matrix(a.column("vi")), matrix(p.column("_v")), matrix(p.column("x"))
            out = np.empty((len(q), width))
            step = max(1, (1 << 21) // max(len(v), 1))
            for at in range(0, len(q), step):
                part = q[at:at + step]
                d2 = np.maximum((part * part).sum(1)[:, None] + (v * v).sum(1)[None, :] - 2 * part @ v.T, 0)
                out[at:at + step] = np.exp(-gamma * d2) @ have
            return pa.table([a.column("i"), lists(out)], ["i", "y"])

        points = space.points.join(x.withColumnRenamed("id", "_id"), "_id")
        met = space.meet(self.sent, points, compare, f"i {space.kind}, y array<double>")
        sums = met.groupBy("i").agg(*[F.sum(F.col("y")[k]).alias(f"y{k}") for k in range(width)])
        return sums.select(F.col("i").alias("id"), F.array(*[f"y{k}" for k in range(width)]).alias("y"))


def rbf_graph(space: Space, gamma: float, least: float = 0.0) -> DataFrame:
    """(src, dst, weight = exp(-gamma d^2)) of all pairs with weight > ``least`` (and of every pair for 0): the dense graph, as rows."""
    reach = float("inf") if least <= 0 else float(np.sqrt(-np.log(least) / gamma))
    near = space.within(space.points, reach)
    weight = F.exp(-F.lit(float(gamma)) * F.col("dist") * F.col("dist"))
    return near.select(F.col("i").alias("src"), F.col("j").alias("dst"), weight.alias("weight")).where(F.col("weight") > least)


def cross_products(rows: DataFrame, columns: list[str]) -> np.ndarray:
    """B'B over all rows of the matrix B of the list columns side by side. Each task sends its sum once, as one list, and Spark adds
    them by position."""

    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                part = np.concatenate([matrix(b.column(c)) for c in columns], 1)
                total = part.T @ part if total is None else total + part.T @ part
        if total is not None:
            yield pa.RecordBatch.from_pandas(pd.DataFrame({"i": np.arange(total.size), "s": total.ravel()}), preserve_index=False)

    sums = rows.select(*columns).mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros(sums.num_rows)
    out[sums.column("i").to_numpy()] = sums.column("s").to_numpy()
    n = int(round(np.sqrt(len(out))))
    return out.reshape(n, n)


def mapped(rows: DataFrame, columns: list[str], maps: dict[str, np.ndarray], keep: list[str]) -> DataFrame:
    """``keep`` and the list columns [columns side by side] @ map for each of ``maps``."""
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep) + "".join(f", {m} array<double>" for m in maps)

    def run(batches):
        for b in batches:
            if b.num_rows:
                part = np.concatenate([matrix(b.column(c)) for c in columns], 1)
                yield pa.record_batch([*[b.column(c) for c in keep], *[lists(part @ m) for m in maps.values()]], [*keep, *maps])

    return rows.select(*dict.fromkeys([*keep, *columns])).mapInArrow(run, kinds)


def orthonormal(gram: np.ndarray, least: float = 1e-14) -> np.ndarray:
    """A map C such that B C has orthonormal columns, for B with the given B'B (directions that vanish are left out)."""
    values, vectors = np.linalg.eigh(gram)
    keep = values > least * max(values.max(), 1e-300)
    return vectors[:, keep] / np.sqrt(values[keep])


def leading(affinity, k: int, tol: float = 1e-6, max_products: int = 200, steps: int = STEPS, seed: int = 0) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The ``k`` leading eigenvectors of D^-1/2 A D^-1/2 as (id, degree, v array<double>), their eigenvalues and residual norms."""
    ones = affinity.vertices.select("id", F.array(F.lit(1.0)).alias("x"))
    degrees = affinity.vertices.join(affinity.times(ones, 1), "id", "left").select("id", F.coalesce(F.col("y")[0], F.lit(0.0)).alias("degree"))
    root = F.when(F.col("degree") > 0, 1 / F.sqrt("degree")).otherwise(0.0)
    degrees = materialize(degrees.withColumn("scale", root), "degrees")
    n = degrees.count()
    k = min(k, n)
    width = min(2 * k + EXTRA, n)
    noise = lambda j: (F.pmod(F.xxhash64("id", F.lit(seed * 1000 + j)), F.lit(1 << 30)) / F.lit(float(1 << 30))) - 0.5
    first = F.when(F.col("degree") > 0, F.sqrt("degree")).otherwise(0.0)  # the leading vector of a connected graph
    block = degrees.select("id", "degree", "scale", F.array(first, *[noise(j) for j in range(1, width)]).alias("b"))
    products = 1
    while True:
        # one restart: blocks b0, b1, .. and their images m0, m1, ..
        c = orthonormal(cross_products(block, ["b"]))
        table = materialize(mapped(block, ["b"], {"b0": c}, ["id", "degree", "scale"]), "block")
        size, number = [c.shape[1]], 0
        while True:
            scaled = table.select("id", F.transform(F.col(f"b{number}"), lambda v: v * F.col("scale")).alias("x"))
            image = affinity.times(scaled, size[number])
            table = table.join(image, "id", "left").withColumn(f"m{number}", F.coalesce(
                F.transform("y", lambda v: v * F.col("scale")), F.array_repeat(F.lit(0.0), size[number]))).drop("y")
            table = materialize(table, "basis")
            products += 1
            basis, images = [f"b{i}" for i in range(number + 1)], [f"m{i}" for i in range(number + 1)]
            gram = cross_products(table, basis + images)
            p = sum(size)
            inner, across, outer = gram[:p, :p], gram[:p, p:], gram[p:, p:]
            turn = orthonormal(inner)
            ritz, small = np.linalg.eigh(turn.T @ ((across + across.T) / 2) @ turn)
            ritz, small = ritz[::-1], turn @ small[:, ::-1]
            # |M v - theta v|^2 of the Ritz vectors v = B s, from the sums alone
            left = [s @ outer @ s - 2 * t * (s @ across @ s) + t * t * (s @ inner @ s) for t, s in zip(ritz[:k], small.T[:k])]
            residual = np.sqrt(np.maximum(left, 0))
            if len(ritz) >= k and residual.max(initial=0) <= tol or p >= n or products >= max_products or number + 1 >= steps:
                break
            # the next block: the last image, orthogonal to the basis; its inner products follow from those already summed
            last = slice(p - size[number], p)
            fit = np.linalg.lstsq(inner, across[:, last], rcond=None)[0]
            select = np.zeros((2 * p, size[number]))
            select[:p], select[p:][last] = -fit, np.eye(size[number])
            c = orthonormal(select.T @ gram @ select, 1e-12)
            if c.shape[1] == 0:
                break
            number += 1
            table = mapped(table, basis + images, {f"b{number}": select @ c}, [*table.columns])
            size.append(c.shape[1])
        done = residual.max(initial=0) <= tol or p >= n or products >= max_products
        want = small[:, :k if done else min(width, small.shape[1])]
        basis = [f"b{i}" for i in range(len(size))]
        block = mapped(table, basis, {"b": want}, ["id", "degree", "scale"])
        if done:
            return materialize(block.select("id", "degree", F.col("b").alias("v")), "eigenvectors"), ritz[:k], residual
        if want.shape[1] < width:  # the basis lost directions: fill up
            block = block.withColumn("b", F.concat("b", F.array(*[noise(products * 100 + j) for j in range(width - want.shape[1])])))


def embedding(affinity, k: int, tol: float = 1e-6, max_products: int = 200) -> DataFrame:
    """(id, x): entries of the k leading eigenvectors over the root of the degree."""
    vectors, _, _ = leading(affinity, k, tol, max_products)
    return vectors.select("id", F.transform("v", lambda v: F.when(F.col("degree") > 0, v / F.sqrt("degree")).otherwise(0.0)).alias("x"))


def spectral(space: Space, n_clusters: int, affinity: str = "nearest_neighbors", n_neighbors: int = 10, gamma: float = 1.0,
             tol: float = 1e-6, max_products: int = 200, seed: int = 0) -> DataFrame:
    """Spectral clustering: k-means on the spectral embedding of the kNN graph 0.5 (A + A') or of the rbf kernel.  (id, cluster)."""
    if affinity == "nearest_neighbors":
        of = GraphAffinity(knn_graph(space, n_neighbors), space.points.select(F.col("_id").alias("id")))
    elif affinity == "rbf":
        of = RbfAffinity(space, gamma)
    else:
        raise ValueError("affinity is 'nearest_neighbors' or 'rbf'")
    x = materialize(embedding(of, n_clusters, tol, max_products).select("id", array_to_vector("x").alias("features")), "embedding")
    model = KMeans(k=n_clusters, seed=seed, maxIter=50).fit(x)
    return model.transform(x).select("id", F.col("prediction").alias("cluster"))
