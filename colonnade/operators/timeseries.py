"""Time series: buckets (resample), regular grids (asfreq), periods.

Buckets are Spark ``window`` / ``date_trunc`` expressions, so the same
function body runs on a batch or a streaming frame.  Empty buckets are
added by a left join from a bucket calendar built by ``sequence`` over the
observed range (its size is the number of buckets, not the number of rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colonnade.plans.ordered import FFill, BFill, ordered_scan

_TRUNC = {"D": "day", "H": "hour", "M": "month", "Q": "quarter", "Y": "year", "W": "week", "T": "minute",
          "min": "minute", "S": "second"}


_MICROS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
           "hour": 3_600_000_000, "day": 86_400_000_000, "week": 7 * 86_400_000_000}


def _every_micros(every: str) -> int | None:
    """Microseconds of a fixed-width interval string such as '10 minutes'."""
    parts = every.strip().lower().split()
    if len(parts) != 2:
        return None
    n, unit = parts
    unit = unit.rstrip("s")
    return int(n) * _MICROS[unit] if unit in _MICROS and n.isdigit() else None


def time_grid(df: DataFrame, ts, every: str, name: str, start: Column | None = None,
              end: Column | None = None) -> DataFrame:
    """Grid points start, start + every, ..., <= end (default: min / max of
    ``ts``) as a distributed ``spark.range`` over the number of points, so a
    fine grid over a long span is spread over partitions instead of being
    exploded from one row.  Calendar units (months, years) use ``sequence``,
    whose size is the number of calendar steps."""
    c = F.col(ts) if isinstance(ts, str) else ts
    lo, hi = df.agg((start if start is not None else F.min(c)).alias("lo"),
                    (end if end is not None else F.max(c)).alias("hi")).first()
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], f"{name} timestamp_ntz")
    step = _every_micros(every)
    if step is None:
        return spark.createDataFrame([(lo, hi)], "lo timestamp_ntz, hi timestamp_ntz").select(
            F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {every}"))).alias(name))
    span = int((hi - lo).total_seconds() * 1_000_000)
    n = span // step + 1
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), n // 100_000 + 1))
    base = F.lit(lo).cast("timestamp_ntz")
    return spark.range(0, n, 1, parts).select(
        (base + F.make_dt_interval(secs=(F.col("id") * F.lit(step)).cast("decimal(38,6)") / F.lit(1_000_000)))
        .cast("timestamp_ntz").alias(name))


def bucket(ts, every: str, offset: str | None = None) -> Column:
    """Start of the fixed-width bucket (epoch aligned, moved by ``offset``) holding ``ts``."""
    return F.window(ts, every, every, offset).start if offset else F.window(ts, every).start


def resample(df: DataFrame, ts: str, every: str, aggs: Sequence[Column], fill_empty: bool = True,
             label: str = "left", closed: str = "left", count_cols: Sequence[str] = (), offset: str | None = None) -> DataFrame:
    """Time-bucket aggregate.  ``every`` is a Spark interval string such as
    ``"6 hours"``; buckets are closed on their left or right side, start at multiples of ``every`` plus ``offset``
    (an interval string too) and are labelled by their start
    (``label='right'`` labels by the end).  Empty buckets appear with null
    aggregates when ``fill_empty``; the columns named in ``count_cols`` are 0 there."""
    if closed not in ("left", "right"):
        raise ValueError("closed is left or right")
    start = bucket(ts, every, offset)
    if closed == "right":  # a time on a border belongs to the bucket that ends there
        start = F.when(F.col(ts) == start, start - F.expr(f"INTERVAL {every}")).otherwise(start)
    g = df.groupBy(start.alias("bucket")).agg(*aggs)
    if fill_empty:
        cal = time_grid(df, start, every, "bucket")
        g = cal.join(g, "bucket", "left")
        if count_cols:
            g = g.fillna(0, subset=list(count_cols))
    if label == "right":
        g = g.withColumn("bucket", F.col("bucket") + F.expr(f"INTERVAL {every}"))
    return g


def asfreq(df: DataFrame, ts: str, every: str, cols: Sequence[str], method: str | None = None,
           fill_value=None) -> DataFrame:
    """Rows at each grid point from the first to the last timestamp.

    Without ``method`` a grid point takes the row at exactly that time;
    ``ffill`` / ``bfill`` take the last row at or before / first row at or
    after it (an as-of lookup done as one ordered scan over the union of
    grid points and rows, so no group or global order sits in one task).
    ``fill_value`` only fills grid points that got no value."""
    grid = time_grid(df, ts, every, ts)
    if method is None:
        out = grid.join(df.select(ts, *cols), ts, "left")
    else:
        rows = df.select(ts, F.lit(1).alias("_row"), *cols)
        g = grid.select(ts, F.lit(0).alias("_row"), *[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in cols])
        u = rows.unionByName(g)
        if method == "ffill":
            order = [F.col(ts).asc(), F.col("_row").desc()]
            ops = [FFill(f"_v_{c}", f"_o_{c}") for c in cols]
        elif method == "bfill":
            order = [F.col(ts).asc(), F.col("_row").asc()]
            ops = [BFill(f"_v_{c}", f"_o_{c}") for c in cols]
        else:
            raise ValueError(method)
        # carry a (present, value) pair so a null value in a matched row is kept
        u = u.withColumns({f"_v_{c}": F.when(F.col("_row") == 1, F.struct(F.col(c).alias("v"))) for c in cols})
        s = ordered_scan(u, order, [], ops)
        out = s.where("_row = 0").select(ts, *[F.col(f"_o_{c}")["v"].alias(c) for c in cols])
    if fill_value is not None:
        out = out.fillna(fill_value, subset=list(cols))
    return out


def to_period(ts, freq: str) -> Column:
    """Timestamp to the start of its period (``D``, ``W``, ``M``, ``Q``, ``Y``,
    ``H``...), as a naive timestamp.  Calendar units truncate the date part
    (independent of the session time zone)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    unit = _TRUNC.get(freq, freq)
    if unit == "day":
        return F.to_date(c).cast("timestamp_ntz")
    if unit in ("week", "month", "quarter", "year"):
        return F.trunc(F.to_date(c), unit).cast("timestamp_ntz")
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def period_label(ts, freq: str) -> Column:
    """Period as text: ``2024-01`` for months, ``2024Q1`` quarters, ``2024`` years, dates otherwise."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if freq == "M":
        return F.date_format(c, "yyyy-MM")
    if freq == "Q":
        return F.concat(F.year(c).cast("string"), F.lit("Q"), F.quarter(c).cast("string"))
    if freq == "Y":
        return F.year(c).cast("string")
    return F.date_format(to_period(c, freq), "yyyy-MM-dd")


_INTERVAL = {"D": "1 DAY", "W": "7 DAYS", "M": "1 MONTH", "Q": "3 MONTHS", "Y": "1 YEAR", "H": "1 HOUR"}


def to_timestamp(period_start, freq: str, how: str = "start") -> Column:
    """Period back to a timestamp: its start, or its last microsecond."""
    c = F.col(period_start) if isinstance(period_start, str) else period_start
    start = to_period(c, freq)
    if how == "start":
        return start
    return (start + F.expr(f"INTERVAL {_INTERVAL[freq]}") - F.expr("INTERVAL 1 MICROSECOND")).cast("timestamp_ntz")
