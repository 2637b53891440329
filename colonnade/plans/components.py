"""Connected components of an edge table: forests of bounded chunks, then alternating large-star and small-star steps.

First every run of ``CHUNK`` edges is replaced by the stars of its own components (a forest that connects the same
vertices, found in numpy inside one Arrow task, whose memory ``CHUNK`` bounds). If all edges were one chunk, its stars are the
result. Otherwise the stars of the chunks are joined by steps of one aggregate and one join; rounds grow with the
logarithm of the longest path, and the loop ends when the edges no longer change (no round limit). No vertex' neighbours are
collected: a hub is a skewed join key, which the adaptive join splits. Every round is a written table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colonnade.session import materialize, materialize_with

CHUNK = 1 << 19  # edges that one task joins at a time


def least_reachable(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest number that each of the numbers 0 to n - 1 is connected with by the edges (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        for end in (a, b):
            np.minimum.at(label, label[end], low)  # the roots move as well
            np.minimum.at(label, end, low)
        while True:  # pointers to the end
            further = label[label]
            if (further == label).all():
                break
            label = further
        if (label == before).all():
            break
    return label


def forests(ends: DataFrame, chunk: int) -> DataFrame:
    """(u, v) with u > v: each chunk's vertices and the smallest vertex of their component in it."""

    def run(batches):
        held, rows = [], 0

        def stars():
            table = pa.Table.from_batches(held).combine_chunks()
            u, v = (table.column(c).combine_chunks() for c in ("u", "v"))
            names = pa.concat_arrays([u, v]).unique()
            names = names.take(pa.compute.sort_indices(names))
            a, b = (pa.compute.index_in(x, value_set=names).to_numpy().astype(np.int64) for x in (u, v))
            label = least_reachable(a, b, len(names))
            own = np.flatnonzero(label < np.arange(len(names)))
            for i in range(0, len(own), 1 << 16):
                part = own[i:i + (1 << 16)]
                yield pa.record_batch([names.take(pa.array(part)), names.take(pa.array(label[part]))], ["u", "v"])

        for b in batches:
            if b.num_rows:
                held.append(b)
                rows += b.num_rows
                if rows >= chunk:
                    yield from stars()
                    held, rows = [], 0
        if held:
            yield from stars()

    return ends.select("u", "v").mapInArrow(run, ends.select("u", "v").schema)


def _write(star: DataFrame) -> tuple[DataFrame, tuple]:
    """The written edges and a fingerprint of them, from one job."""
    part = lambda *c: F.sum(F.pmod(F.xxhash64(*c), F.lit(1 << 31)))
    out, seen = materialize_with(star, "star", a=part("u", "v"), b=part("v", "u", F.lit(1)))
    return out, (seen["rows"], seen["a"], seen["b"])


def connected_components(edges: DataFrame, u: str = "u", v: str = "v", chunk: int = CHUNK) -> DataFrame:
    """(vertex, component) for every vertex of an edge, component being the smallest vertex it is connected with.

    Edges are undirected; null ends and loops add nothing (a vertex with a loop only is its own component);
    repeated edges are fine; vertices may be of any ordered type.
    """
    ends = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u is not null and v is not null")
    ends, state = _write(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    vertices = ends.select(F.col("u").alias("vertex")).union(ends.select("v")).distinct()
    one = state[0] <= chunk
    star = materialize(forests(ends.filter("u <> v").coalesce(1) if one else ends.filter("u <> v"), chunk), "forests")
    while not one:
        # large star: every larger neighbour of a vertex links to the smallest of its neighbourhood
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a vertex and its smaller neighbours link to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star, now = _write(small.union(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        if now == state:
            break
        state = now
    return vertices.join(star.select(F.col("u").alias("vertex"), F.col("v").alias("component")), "vertex", "left").select(
        "vertex", F.coalesce("component", "vertex").alias("component"))
