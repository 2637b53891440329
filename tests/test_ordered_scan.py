"""The range-partition + carry scan equals plain windows, for global and
keyed orders, whatever the number of partitions (hot keys are split)."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from colonnade.plans.ordered import BFill, CumSum, FFill, Lag, Lead, Pos, RPos, ordered_scan

OPS = [Pos("pos"), RPos("rpos"), CumSum("v", "cs"), FFill("v", "ff", "ffp"), BFill("v", "bf", "bfp"), Lag("v", 3, "lag3"),
       Lead("v", 2, "lead2")]


def _reference(df, keys):
    w = Window.partitionBy(*keys).orderBy("o") if keys else Window.orderBy("o")
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    dn = w.rowsBetween(0, Window.unboundedFollowing)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys) if keys else Window.partitionBy())
    return df.select("o", (F.row_number().over(w) - 1).alias("pos"),
                     (n - F.row_number().over(w)).alias("rpos"), F.sum("v").over(up).alias("cs"),
                     F.last("v", True).over(up).alias("ff"), F.first("v", True).over(dn).alias("bf"),
                     F.lag("v", 3).over(w).alias("lag3"), F.lead("v", 2).over(w).alias("lead2"))


def _check(spark, rows, keys, parts):
    df = spark.createDataFrame(rows, "o long, k long, v long")
    got = ordered_scan(df, [F.col("o")], keys, OPS, partitions=parts) \
        .select("o", "pos", "rpos", "cs", "ff", "bf", "lag3", "lead2")
    want = _reference(df, keys)
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("parts", [1, 3, 7])
def test_hot_key(spark, keys, parts):
    # key 0 holds most of the rows, nulls in runs
    rows = [(i, 0 if i % 5 else i % 3, None if (i // 4) % 3 == 0 else i % 11) for i in range(300)]
    _check(spark, rows, keys, parts)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-5, 5))), min_size=1, max_size=60),
       st.integers(1, 6))
def test_random(spark, data, parts):
    rows = [(i, k, v) for i, (k, v) in enumerate(data)]
    _check(spark, rows, ["k"], parts)


@pytest.mark.parametrize("n", [1, 40, 137, 250])
def test_far_lag_and_lead(spark, n):
    """Distances longer than a partition are looked up by position."""
    rows = [(i, 0 if i % 5 else 1, None if i % 7 == 0 else i) for i in range(300)]
    df = spark.createDataFrame(rows, "o long, k long, v long")
    got = ordered_scan(df, [F.col("o")], ["k"], [Lag("v", n, "a"), Lead("v", n, "b"), Lag("v", 2, "c"), Pos("p")], partitions=6)
    w = Window.partitionBy("k").orderBy("o")
    want = df.select("o", F.lag("v", n).over(w).alias("a"), F.lead("v", n).over(w).alias("b"), F.lag("v", 2).over(w).alias("c"),
                     (F.row_number().over(w) - 1).alias("p"))
    assert sorted(got.select("o", "a", "b", "c", "p").collect(), key=repr) == sorted(want.collect(), key=repr)


def test_types_and_nan_keys(spark):
    """Fills keep the column's type; null and NaN keys are groups of their own."""
    df = spark.createDataFrame([(i, [None, float("nan"), 1.5][i % 3], None if i % 4 else f"s{i}", None if i % 5 else [i]) for i in range(60)],
                               "o long, k double, s string, a array<int>")
    got = ordered_scan(df, [F.col("o")], ["k"], [FFill("s", "fs"), BFill("a", "ba"), Lag("s", 1, "ls")], partitions=4)
    w = Window.partitionBy("k").orderBy("o")
    want = df.select("o", F.last("s", True).over(w).alias("fs"), F.first("a", True).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("ba"),
                     F.lag("s").over(w).alias("ls"))
    assert sorted(got.select("o", "fs", "ba", "ls").collect(), key=repr) == sorted(want.collect(), key=repr)


def test_empty_input(spark):
    df = spark.range(0).select(F.col("id").alias("o"), F.col("id").alias("v"))
    assert ordered_scan(df, [F.col("o")], [], [Pos("p"), CumSum("v", "s"), Lag("v", 1, "l")]).count() == 0
