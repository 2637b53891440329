"""2.11 UDF / UDAF surface."""

import pandas as pd
from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.catalog.q_frame import NULLED_VALUE, events_with_nulls
from colonnade.operators import udf as U
from colonnade.sources.tables import Tables


def _net(row: pd.Series) -> dict:
    return {"l_orderkey": row["l_orderkey"], "l_linenumber": row["l_linenumber"],
            "net": row["l_extendedprice"] * (1 - row["l_discount"]), "big": bool(row["l_quantity"] > 25)}


@query("apply_rows", sql="""SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net,
  l_quantity > 25 AS big FROM lineitem""")
def q_apply_rows(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_quantity")
    return U.apply_rows(li, _net, "l_orderkey long, l_linenumber int, net double, big boolean")


def _double_plus_one(x):
    return x * 2 + 1


@query("applymap", sql=f"SELECT event_id, ({NULLED_VALUE}) * 2 + 1 AS value FROM events")
def q_applymap(spark, d):
    ev = events_with_nulls(Tables(spark, d)).select("event_id", "value")
    return U.applymap(ev, _double_plus_one, ["value"], na_action="ignore")


def _moments(pdf: pd.DataFrame) -> pd.DataFrame:
    v = pdf["value"].dropna()
    return pd.DataFrame({"user_id": [pdf["user_id"].iloc[0]], "n": [len(v)], "s": [v.sum()], "ss": [(v * v).sum()]})


@query("apply_group", sql=f"""SELECT user_id, count(v) AS n, round(avg(v), 6) AS mean, round(var_samp(v), 6) AS var
FROM (SELECT user_id, {NULLED_VALUE} AS v FROM events) GROUP BY user_id""")
def q_apply_group(spark, d):
    ev = events_with_nulls(Tables(spark, d)).select("event_id", "user_id", "value")
    n, s, ss = F.sum("n"), F.sum("s"), F.sum("ss")
    out = U.apply_group_partial(ev, ["user_id"], _moments, "user_id long, n long, s double, ss double",
                                [n.alias("n"), (s / n).alias("mean"), ((ss - s * s / n) / (n - 1)).alias("var")],
                                salt_key="event_id", salt_buckets=8)
    return out.select("user_id", "n", F.round("mean", 6).alias("mean"), F.round("var", 6).alias("var"))


_CC = ["l_quantity", "l_extendedprice", "l_discount"]


@query("corr_callable", sql="\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST(1.0 AS DOUBLE) AS value" if a == b else
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS value FROM lineitem"
    for a in _CC for b in _CC))
def q_corr_callable(spark, d):
    out = U.corr_callable(Tables(spark, d).lineitem, _CC, U.pearson_partial, U.pearson_finish, 6)
    return out.withColumn("value", F.round("value", 9))
