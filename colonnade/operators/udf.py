"""User functions over rows, elements, groups and column pairs.

All Python runs in Arrow batches (``mapInPandas`` / ``pandas_udf`` /
``applyInPandas``), never row at a time.  A plain per-group apply holds one
whole group in one task, so it is only for groups of bounded size; the
``apply_group_partial`` form splits large groups into salted chunks and
merges the partial results with Spark aggregates, which keeps hot groups
spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


CHUNK_ROWS = 4096  # rows of a group that one call takes without salt


def apply_rows(df: DataFrame, func: Callable[[pd.Series], pd.Series | dict], schema: str | T.StructType,
               result_type: str = "expand") -> DataFrame:
    """``func`` on every row (axis=1) of each Arrow batch; ``expand`` turns a
    returned Series / dict into the columns of ``schema``."""
    names = (T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fieldNames()

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                yield pd.DataFrame({n: [] for n in names})
                continue
            out = pdf.apply(func, axis=1, result_type=result_type)
            yield out[names] if isinstance(out, pd.DataFrame) else out.to_frame(names[0])

    return df.mapInPandas(run, schema)


def apply_columns(df: DataFrame, func: Callable, cols: Sequence[str]) -> DataFrame:
    """Column-wise (axis=0) function given as a Column -> Column mapping."""
    return df.withColumns({c: func(F.col(c)) for c in cols})


def applymap(df: DataFrame, func: Callable, cols: Sequence[str], return_type: T.DataType = T.DoubleType(),
             na_action: str | None = None) -> DataFrame:
    """Element-wise Python function as a vectorized pandas UDF.
    ``na_action='ignore'`` leaves nulls untouched; any other string fails."""
    if na_action not in (None, "ignore"):
        raise ValueError(f"unknown na_action {na_action!r}")

    @F.pandas_udf(return_type)
    def elementwise(s: pd.Series) -> pd.Series:
        return s.map(func, na_action=na_action)

    return df.withColumns({c: elementwise(F.col(c)) for c in cols})


def apply_group(df: DataFrame, by: Sequence[str], func: Callable[[pd.DataFrame], pd.DataFrame],
                schema: str | T.StructType) -> DataFrame:
    """``func`` per whole group (``group_keys``: include the keys in the
    output schema).  One group is one task: only for bounded groups."""
    return df.groupBy(*by).applyInPandas(func, schema)


def apply_group_partial(df: DataFrame, by: Sequence[str], partial: Callable[[pd.DataFrame], pd.DataFrame],
                        partial_schema: str, merge: Sequence, salt_buckets: int = 64,
                        salt_key: str | None = None) -> DataFrame:
    """Decomposable per-group function.  A group of more than
    ``CHUNK_ROWS`` rows is split into ``salt_buckets`` chunks by a hash of
    ``salt_key`` (a row id); ``partial`` maps a chunk to one row of additive
    statistics (``partial_schema`` must include the ``by`` columns) and
    ``merge`` (Spark aggregate expressions) combines the chunk rows per
    group.  A hot group spreads over ``salt_buckets`` tasks instead of one;
    a small group, of which there are many, is one call."""
    large = df.groupBy(*by).count().where(F.col("count") > CHUNK_ROWS).select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)],
                                                                              F.lit(salt_buckets).alias("_chunks"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)])
    rows = df.withColumn("_row", F.col(salt_key) if salt_key else F.monotonically_increasing_id()).join(F.broadcast(large), same, "left")
    salt = F.pmod(F.xxhash64("_row"), F.coalesce("_chunks", F.lit(1)))
    chunks = rows.withColumn("_salt", salt).select(*df.columns, "_salt").groupBy(*by, "_salt").applyInPandas(partial, partial_schema)
    return chunks.groupBy(*by).agg(*merge)


def corr_callable(df: DataFrame, cols: Sequence[str], partial: Callable[[np.ndarray, np.ndarray], np.ndarray],
                  finish: Callable[[np.ndarray], float], width: int) -> DataFrame:
    """Custom pair statistic from additive partial sums.

    For every column pair, ``partial(x, y)`` maps the pairwise-complete
    values of one Arrow batch to a vector of ``width`` sums; Spark adds the
    vectors over all batches and ``finish`` turns the total into the
    statistic.  The diagonal is 1 and the matrix symmetric."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    out_schema = "col_a string, col_b string, " + ", ".join(f"s{k} double" for k in range(width))

    def run(batches):
        for pdf in batches:
            rows = []
            for a, b in pairs:
                m = pdf[a].notna() & pdf[b].notna()
                v = partial(pdf.loc[m, a].to_numpy(float), pdf.loc[m, b].to_numpy(float))
                rows.append([a, b, *map(float, v)])
            yield pd.DataFrame(rows, columns=["col_a", "col_b", *[f"s{k}" for k in range(width)]])

    sums = df.select(*cols).mapInPandas(run, out_schema).groupBy("col_a", "col_b") \
        .agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(width)])

    @F.pandas_udf(T.DoubleType())
    def fin(*vecs: pd.Series) -> pd.Series:
        mat = np.column_stack([v.to_numpy(float) for v in vecs])
        return pd.Series([finish(r) for r in mat])

    half = sums.select("col_a", "col_b", fin(*[F.col(f"s{k}") for k in range(width)]).alias("value"))
    mirror = half.select(F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "value")
    diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, value double")
    return half.unionByName(mirror).unionByName(diag)


def pearson_partial(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Additive sums for Pearson: n, sx, sy, sxx, syy, sxy."""
    return np.array([len(x), x.sum(), y.sum(), (x * x).sum(), (y * y).sum(), (x * y).sum()])


def pearson_finish(s: np.ndarray) -> float:
    n, sx, sy, sxx, syy, sxy = s
    cov = sxy - sx * sy / n
    return float(cov / np.sqrt((sxx - sx * sx / n) * (syy - sy * sy / n)))
