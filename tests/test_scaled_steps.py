"""Steps whose number of calls, tasks or passes over the input decides how they grow."""

import ast

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from colonnade.corpus import sources as SO
from colonnade.ml import features as FT
from colonnade.ml import linear as LN
from colonnade.operators import udf as U

SOURCE = '''
if True:
    try:
        @cache
        def f(a):
            """Parameters
-----
a"""
    except ValueError:
        class C:
            """Parameters
-----
b"""
            def m(self):
                """Parameters
-----
c"""
match x:
    case 1:
        def g():
            """Parameters
-----
d"""
            return lambda: 1
'''


def test_extract_defs_is_spread(spark):
    src = spark.createDataFrame([("l", "s", f"p{i}", SOURCE) for i in range(64)], "lib string, sha string, filepath string, source string").coalesce(1)
    out = SO.extract_defs(src)
    assert out.select(F.spark_partition_id()).distinct().count() >= 4
    got = {(r["kind"], r["name"], r["parent"], r["line"]) for r in out.collect()}
    lines = {n.name: n.lineno for n in ast.walk(ast.parse(SOURCE)) if hasattr(n, "name") and n.name}
    assert got == {("function", "f", None, lines["f"]), ("class", "C", None, lines["C"]), ("method", "m", "C", lines["m"]), ("function", "g", None, lines["g"])}
    assert out.count() == 4 * 64


def test_small_groups_are_one_call(spark):
    def sizes(pdf):
        return pd.DataFrame({"k": pdf["k"].iloc[:1].astype("Int64").to_numpy(object, na_value=None), "n": [len(pdf)], "calls": [1]})

    df = spark.range(6000 + 300).select(F.when(F.col("id") < 6000, F.lit(-1)).when(F.col("id") < 6200, F.col("id") % 10).cast("long").alias("k"), "id")
    out = U.apply_group_partial(df, ["k"], sizes, "k long, n long, calls long", [F.sum("n").alias("n"), F.sum("calls").alias("calls")], salt_buckets=8, salt_key="id")
    got = {r["k"]: (r["n"], r["calls"]) for r in out.collect()}
    assert got == {-1: (6000, 8), None: (100, 1), **{i: (20, 1) for i in range(10)}}


def test_tfidf_norms_without_a_second_join(spark):
    docs = spark.createDataFrame([(1, "aa bb bb"), (1, "cc"), (2, "aa cc dd dd"), (None, "aa bb"), (3, None)], "doc_id long, text string")
    for norm, total in (("l1", lambda v: abs(v)), ("l2", lambda v: v * v)):
        out = FT.tfidf(docs, norm=norm)
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
        rows = out.collect()
        assert {r["doc_id"] for r in rows} == {1, 2}
        for d in (1, 2):
            assert abs(sum(total(r["tfidf"]) for r in rows if r["doc_id"] == d) - 1) < 1e-12


def test_linear_fit_computes_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    x = np.random.default_rng(1).normal(size=(80, 2))
    df = spark.createDataFrame([(float(a), float(b), float(a + b + 0.7 * (i % 3 - 1) > 0)) for i, (a, b) in enumerate(x)], "a double, b double, y double")
    counted = df.mapInArrow(count, df.schema)
    weighted = LN.fit(counted, ["a", "b"], "y", [1.0], class_weight={0.0: 2.0, 1.0: 1.0})
    assert seen.value == 80
    own = LN.fit(df.withColumn("w", F.when(F.col("y") == 0, 2.0).otherwise(1.0)), ["a", "b"], "y", [1.0], weight="w")
    assert np.allclose(weighted.coef, own.coef, atol=1e-8) and np.allclose(weighted.intercept, own.intercept, atol=1e-8)
