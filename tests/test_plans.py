"""Physical-plan properties the design relies on."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from colonnade.plans.ordered import CumSum, Pos, ordered_scan
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    for key in ("getitem", "filter_mask", "query_expr"):
        plan = _plan(E.queries()[key](spark, SF_SMALL))
        assert "PushedFilters: [" in plan and "GreaterThan" in plan, key
    plan = _plan(E.queries()["getitem"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in plan


def test_membership_is_a_broadcast_join(spark):
    plan = _plan(E.queries()["in1d"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_range_carry_scan_has_no_single_partition_step(spark):
    df = spark.range(0, 5000).select(F.col("id").alias("o"), (F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = ordered_scan(df, [F.col("o")], [], [Pos("p"), CumSum("v", "s")], partitions=4)
    plan = _plan(out)
    assert "SinglePartition" not in plan
    assert sorted(r["p"] for r in out.select("p").collect()) == list(range(5000))


def test_pivot_margins_single_shuffle(spark):
    plan = _plan(E.queries()["pivot_margins"](spark, SF_SMALL))
    assert plan.count("Exchange hashpartitioning") == 1
