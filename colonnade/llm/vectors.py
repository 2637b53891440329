"""Integer vectors for the embedding operators: what takes part, exact inner products, bounded samples, block joins.

A row takes part if its id and vector are not null and no component is null, NaN or infinite. Each component c, as a double,
becomes floor(256 * c) as a long (saturated at the ends of its range). Vectors shorter than the longest are continued with
zeros. Where rows share an id, the one with the smallest vector (entry by entry) stands for them.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
EXACT = float(1 << 53)  # integers below are exact in a double


def finite(c: Column) -> Column:
    """No component is null, NaN or infinite (and the vector is not null)."""
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return c.isNotNull() & F.coalesce(fine, F.lit(False))


def integers(c: Column, scale: int = SCALE) -> Column:
    return F.transform(c, lambda x: F.floor(x.cast("double") * float(scale)))


def integer_rows(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``df`` without the rows that take no part, ``vector`` replaced by x array<long>, all of one length."""
    rows = df.filter(finite(df[vector])).withColumn("x", integers(df[vector])).drop(vector)
    dim = rows.agg(F.max(F.size("x"))).first()[0] or 0
    return rows.withColumn("x", F.when(F.size("x") == dim, F.col("x")).otherwise(F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("x")))))


def matrix(column: pa.Array | pa.ChunkedArray, kind: type = np.int64) -> np.ndarray:
    """The rows of a list column, all of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(n, len(flat) // n if n else 0).astype(kind, copy=False)


def lists(rows: np.ndarray) -> pa.Array:
    """A list column of the rows of a matrix."""
    n, d = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * d, pa.int32()), pa.array(rows.ravel()))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All integer inner products of the rows of two integer matrices: in doubles where every partial sum is exact, else
    in 64-bit integers."""
    if a.size == 0 or b.size == 0:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def sample(rows: DataFrame, most: int, id_col: str = "vec_id") -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of the at most ``most`` rows that a hash of the id picks."""
    got = rows.select(id_col, "x").orderBy(F.xxhash64(F.col(id_col), F.lit(11)), id_col).limit(most).toArrow()
    return got.column(id_col).to_numpy(), matrix(got.column("x"))


def best_first(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id, in order."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        places = np.flatnonzero(score >= least)
    else:
        places = np.arange(len(score))
    return places[np.lexsort((ids[places], -score[places]))[:k]]


def in_blocks(rows: DataFrame, asks: DataFrame, rows_of: dict[int, int], asks_of: dict[int, int], block: int, group: int, id_col: str, ask_col: str):
    """Both sides grouped for a cogroup by (cell, row slice, question slice): no slice holds much more than ``block`` rows or
    ``group`` questions, whatever a cell holds. Row and question counts of a cell come from bounded tables of cells."""
    spark = rows.sparkSession
    cells = [(c, math.ceil(n / block), math.ceil(asks_of[c] / group)) for c, n in rows_of.items() if asks_of.get(c) and n]
    sizes = F.broadcast(spark.createDataFrame(cells or [(-1, 1, 1)], "cell int, slices int, parts int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.join(sizes, "cell").withColumn("slice", F.pmod(F.xxhash64(id_col, F.lit(3)), F.col("slices")).cast("int")).withColumn("part", each("parts"))
    right = asks.join(sizes, "cell").withColumn("part", F.pmod(F.xxhash64(ask_col, F.lit(5)), F.col("parts")).cast("int")).withColumn("slice", each("slices"))
    keys = ["cell", "slice", "part"]
    return left.drop("slices", "parts").groupBy(*keys).cogroup(right.drop("slices", "parts").groupBy(*keys))
