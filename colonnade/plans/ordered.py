"""Order-dependent scans that scale: range partitions plus boundary carry.

A window ``partitionBy(keys).orderBy(order)`` puts a whole key group into one
task, and a window without ``partitionBy`` puts the whole table into one task.
Both break when one key holds a large share of the rows.  ``ordered_scan``
instead:

1. range-partitions the rows by ``(keys, order)`` into P balanced partitions
   (a hot key is split over several partitions; P follows the bytes of the
   scanned tables), sorts inside them and computes every scan locally, one
   pass over Arrow data: the only exchange of the rows;
2. writes the result, which fixes partition ids and local values under
   retries;
3. summarizes only the key groups that touch a partition boundary (at most
   two per partition, so at most 2P rows) and folds those summaries across
   partitions with a window over that small table;
4. broadcasts the carry (at most 2P rows of fixed width, a proven bound) and
   combines it with the local results.  Lags and leads that reach over a
   boundary are looked up by position: only rows within the distance of a
   boundary take part, whatever the distance.

Supported scans: position in the key group (from the start or the end), running sum, forward fill,
backward fill (with the position of the value used), lag and lead by n.
The order must be a total order (add a unique tie breaker).  There is one plan for every input size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.session import materialize

PARTITION_BYTES = 64 << 20  # input bytes of one range partition, about
BATCH_ROWS = 1 << 16


@dataclass(frozen=True)
class Pos:
    name: str


@dataclass(frozen=True)
class RPos:
    """0-based position counted from the end of the key group."""
    name: str


@dataclass(frozen=True)
class CumSum:
    col: str
    name: str


@dataclass(frozen=True)
class FFill:
    col: str
    name: str
    pos_name: str | None = None


@dataclass(frozen=True)
class BFill:
    col: str
    name: str
    pos_name: str | None = None


@dataclass(frozen=True)
class Lag:
    col: str
    n: int
    name: str


@dataclass(frozen=True)
class Lead:
    col: str
    n: int
    name: str


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the tables that a plan scans (its leaves; estimates of joins are not used)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def partitions_for(df: DataFrame) -> int:
    """Range partitions by input size, and at least the session's shuffle partitions."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, min(-(-scanned_bytes(df) // PARTITION_BYTES), 1_000_000))


def _key_eq(left: str, right: str, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


# -- the local pass (inside tasks) ---------------------------------------------

def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """True where a sorted column's value differs from the row before (nulls and NaN equal themselves)."""
    codes = column.combine_chunks().dictionary_encode() if not pa.types.is_dictionary(column.type) else column.combine_chunks()
    codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
    idx = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    return np.append(True, idx[1:] != idx[:-1])[:len(idx)]


def _take(column: pa.ChunkedArray, idx: np.ndarray) -> pa.ChunkedArray:
    """Rows of a column; null where the index is negative."""
    return column.take(pa.array(np.where(idx < 0, 0, idx), mask=idx < 0))


def _running_sum(column: pa.ChunkedArray, group: np.ndarray, integral: bool) -> pa.Array:
    """Running sum within groups of consecutive rows; null until the first value."""
    values = column.combine_chunks()
    valid = values.is_valid().to_numpy(zero_copy_only=False)
    x = values.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64 if integral else np.float64)
    sums = pd.Series(x).groupby(group, sort=False).cumsum().to_numpy()
    seen = pd.Series(valid.astype(np.int64)).groupby(group, sort=False).cumsum().to_numpy() > 0
    return pa.array(sums, mask=~seen)


def _local_columns(table: pa.Table, keys: Sequence[str], ops: Sequence, part: int) -> pa.Table:
    """The partition's rows with their local results (see ``ordered_scan``)."""
    n = table.num_rows
    change = np.zeros(n, bool)
    change[:1] = True
    for k in keys:
        change |= _changes(table.column(k))
    group = np.cumsum(change) - 1
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], n)
    begin, end = starts[group], ends[group]
    at = np.arange(n)
    out = {"_pid": pa.array(np.full(n, part, np.int32)), "_lpos": pa.array(at - begin), "_lcnt": pa.array(end - begin),
           "_bnd": pa.array((group == 0) | (group == len(starts) - 1))}
    for i, op in enumerate(ops):
        if isinstance(op, (Pos, RPos)):
            continue
        c = table.column(op.col)
        if isinstance(op, CumSum):
            out[f"_l{i}"] = _running_sum(c, group, pa.types.is_integer(c.type))
            continue
        if isinstance(op, (FFill, BFill)):
            valid = c.combine_chunks().is_valid().to_numpy(zero_copy_only=False)
            if isinstance(op, FFill):
                src = np.maximum.accumulate(np.where(valid, at, -1))
                src = np.where(src >= begin, src, -1)
            else:
                src = np.minimum.accumulate(np.where(valid, at, n)[::-1])[::-1]
                src = np.where(src < end, src, -1)
            out[f"_p{i}"] = pa.array(np.where(src < 0, 0, src - begin), mask=src < 0)
        elif isinstance(op, Lag):
            src = np.where(at - op.n >= begin, at - op.n, -1)
        else:
            src = np.where(at + op.n < end, at + op.n, -1)
        out[f"_l{i}"] = _take(c, src)
    for name, col in out.items():
        table = table.append_column(name, col)
    return table


def _local_scan(df: DataFrame, keys: Sequence[str], ops: Sequence) -> DataFrame:
    fields = [*df.schema.fields, T.StructField("_pid", T.IntegerType()), T.StructField("_lpos", T.LongType()),
              T.StructField("_lcnt", T.LongType()), T.StructField("_bnd", T.BooleanType())]
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    for i, op in enumerate(ops):
        if isinstance(op, (Pos, RPos)):
            continue
        kind = df.schema[op.col].dataType
        if isinstance(op, CumSum):
            if isinstance(kind, T.DecimalType) or not isinstance(kind, T.NumericType):
                raise TypeError(f"running sums need an integer or floating column, {op.col} is {kind.simpleString()}")
            kind = T.LongType() if isinstance(kind, integral) else T.DoubleType()
        elif isinstance(op, (FFill, BFill)):
            fields.append(T.StructField(f"_p{i}", T.LongType()))
        fields.append(T.StructField(f"_l{i}", kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rows = [b for b in batches if b.num_rows]
        if rows:  # one partition of bounded size
            yield from _local_columns(pa.Table.from_batches(rows), keys, ops, TaskContext.get().partitionId()) \
                .combine_chunks().to_batches(max_chunksize=BATCH_ROWS)

    return df.mapInArrow(run, T.StructType(fields))


# -- the scan ---------------------------------------------------------------------

def ordered_scan(df: DataFrame, order: Sequence[Column], keys: Sequence[str] = (),
                 ops: Sequence = (), partitions: int | None = None) -> DataFrame:
    """Add the columns of ``ops`` computed along ``order`` within ``keys``."""
    for op in ops:
        if isinstance(op, (Lag, Lead)) and op.n < 1:
            raise ValueError("lag and lead distances begin at 1")
    keys = list(keys)
    if not keys:
        df = df.withColumn("_k0", F.lit(0))
        keys = ["_k0"]
    user_cols = [c for c in df.columns if c != "_k0"]
    by = [*[F.col(k).asc_nulls_first() for k in keys], *order]
    ranged = df.repartitionByRange(partitions or partitions_for(df), *by).sortWithinPartitions(*by)
    # fixes partition ids and local results: the summary and the final join read the written rows
    r = materialize(_local_scan(ranged, keys, ops), "ordered")

    # -- boundary groups: first and last key group of every partition (<= 2P rows)
    aggs = [F.count(F.lit(1)).alias("_cnt")]
    for i, op in enumerate(ops):
        c = F.col(op.col) if hasattr(op, "col") else None
        if isinstance(op, CumSum):
            aggs.append(F.sum(c).alias(f"_s{i}"))
        elif isinstance(op, (FFill, BFill)):
            at = F.when(c.isNotNull(), F.col("_lpos"))
            pick, end = (F.max_by, F.max) if isinstance(op, FFill) else (F.min_by, F.min)
            aggs += [pick(c, at).alias(f"_s{i}"), end(at).alias(f"_q{i}")]
    summary = r.where("_bnd").groupBy("_pid", *keys).agg(*aggs)

    wk = Window.partitionBy(*keys).orderBy("_pid")
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    after = wk.rowsBetween(1, Window.unboundedFollowing)
    summary = summary.withColumn("_base", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    carry = {"_base": F.col("_base"), "_after": F.coalesce(F.sum("_cnt").over(after), F.lit(0))}
    for i, op in enumerate(ops):
        if isinstance(op, CumSum):
            carry[f"_c{i}"] = F.sum(f"_s{i}").over(before)
        elif isinstance(op, (FFill, BFill)):
            held = F.when(F.col(f"_q{i}").isNotNull(),
                          F.struct((F.col("_base") + F.col(f"_q{i}")).alias("p"), F.col(f"_s{i}").alias("v")))
            carry[f"_c{i}"] = F.last(held, ignorenulls=True).over(before) if isinstance(op, FFill) \
                else F.first(held, ignorenulls=True).over(after)
    carry_df = summary.select("_pid", *keys, *[v.alias(k) for k, v in carry.items()])

    j = r.alias("r").join(F.broadcast(carry_df.alias("c")),
                          (F.col("r._pid") == F.col("c._pid")) & _key_eq("r", "c", keys), "left")
    base, after_n = F.coalesce(F.col("c._base"), F.lit(0)), F.coalesce(F.col("c._after"), F.lit(0))
    lpos, lcnt = F.col("r._lpos"), F.col("r._lcnt")
    out = {}
    far = [(i, op) for i, op in enumerate(ops) if isinstance(op, (Lag, Lead))]
    for i, op in enumerate(ops):
        if isinstance(op, Pos):
            out[op.name] = base + lpos
        elif isinstance(op, RPos):
            out[op.name] = after_n + lcnt - 1 - lpos
        elif isinstance(op, CumSum):
            lv, cv = F.col(f"r._l{i}"), F.col(f"c._c{i}")
            out[op.name] = F.when(lv.isNull() & cv.isNull(), F.lit(None)).otherwise(
                F.coalesce(lv, F.lit(0)) + F.coalesce(cv, F.lit(0)))
        elif isinstance(op, (FFill, BFill)):
            lv, lp, cv = F.col(f"r._l{i}"), F.col(f"r._p{i}"), F.col(f"c._c{i}")
            out[op.name] = F.when(lp.isNotNull(), lv).otherwise(cv["v"])
            if op.pos_name:
                out[op.pos_name] = F.when(lp.isNotNull(), base + lp).otherwise(cv["p"])
        else:
            out[op.name] = F.col(f"r._l{i}")
    if not far:
        return j.select(*[F.col(f"r.{c}") for c in user_cols], *[v.alias(k) for k, v in out.items()])

    # rows whose lag or lead lies beyond their partition, and the rows it may lie in
    needs = [(lpos < op.n) & (base > 0) if isinstance(op, Lag) else (lcnt - lpos <= op.n) & (after_n > 0) for _, op in far]
    some = needs[0]
    for x in needs[1:]:
        some = some | x
    wide = j.select(*[F.col(f"r.{c}") for c in user_cols], *[F.col(f"r.{k}").alias(k) for k in keys if k not in user_cols],
                    *[v.alias(k) for k, v in out.items()], (base + lpos).alias("_gpos"), (lcnt - 1 - lpos).alias("_left"), lpos.alias("_here"),
                    F.coalesce(some, F.lit(False)).alias("_far"), F.col("r._bnd").alias("_edge"), F.col("c._after").alias("_more"), F.col("c._base").alias("_less"))
    near = wide.where(~F.col("_far"))
    looked = wide.where("_far")
    for i, op in far:
        source = wide.where(F.col("_edge") & ((F.col("_left") < op.n) if isinstance(op, Lag) else (F.col("_here") < op.n)))
        source = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys], F.col("_gpos").alias("_s_pos"), F.col(op.col).alias("_s_val"))
        target = F.col("_gpos") - op.n if isinstance(op, Lag) else F.col("_gpos") + op.n
        cond = target == F.col("_s_pos")
        for k in keys:
            cond = cond & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
        beyond = (F.col("_here") < op.n) & (F.coalesce(F.col("_less"), F.lit(0)) > 0) if isinstance(op, Lag) else \
            (F.col("_left") < op.n) & (F.coalesce(F.col("_more"), F.lit(0)) > 0)
        looked = looked.join(source, cond, "left").withColumn(op.name, F.when(beyond, F.col("_s_val")).otherwise(F.col(op.name))) \
            .drop("_s_pos", "_s_val", *[f"_s_{k}" for k in keys])
    names = [*user_cols, *[op.name if not isinstance(op, (FFill, BFill)) else n for op in ops
                           for n in ([op.name] if not isinstance(op, (FFill, BFill)) else [op.name, op.pos_name] if op.pos_name else [op.name])]]
    return near.select(*names).unionByName(looked.select(*names))


def row_number(df: DataFrame, order: Sequence[Column], keys: Sequence[str] = (),
               name: str = "row_id", partitions: int | None = None) -> DataFrame:
    """0-based position along ``order`` (within ``keys``) without a global window."""
    return ordered_scan(df, order, keys, [Pos(name)], partitions)
