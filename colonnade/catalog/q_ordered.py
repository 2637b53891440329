"""2.5 Window / order-dependent operators and 2.6 sort, top-n, dedupe."""

from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.catalog.q_frame import NULLED_VALUE, events_with_nulls
from colonnade.operators import ordered as R
from colonnade.sources.tables import Tables

_EV = f"(SELECT event_id, ts, user_id, {NULLED_VALUE} AS v FROM events)"
_W_USER = "(PARTITION BY user_id ORDER BY ts, event_id)"
_W_ALL = "(ORDER BY ts, event_id)"
_ORDER = ["ts", "event_id"]


@query("shift", sql=f"""SELECT event_id, user_id, v AS value, lag(v, 2, 0.0) OVER {_W_USER} AS value_lag2,
  lead(v, 1) OVER {_W_USER} AS value_lead1 FROM {_EV}""")
def q_shift(spark, d):
    ev = events_with_nulls(Tables(spark, d)).select("event_id", "ts", "user_id", "value")
    ev = R.shifts(ev, [("value", 2, "value_lag2", 0.0), ("value", -1, "value_lead1", None)], _ORDER, by=["user_id"])
    return ev.select("event_id", "user_id", "value", "value_lag2", "value_lead1")


@query("diff", sql=f"SELECT event_id, v AS value, v - lag(v, 1) OVER {_W_ALL} AS value_diff FROM {_EV}")
def q_diff(spark, d):
    ev = events_with_nulls(Tables(spark, d)).select("event_id", "ts", "value")
    return R.diff(ev, ["value"], 1, _ORDER).select("event_id", "value", "value_diff")


@query("ffill", sql=f"""
WITH s AS (SELECT *, row_number() OVER {_W_USER} - 1 AS pos FROM {_EV}),
f AS (SELECT *, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS fv,
             last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS fp
      FROM s)
SELECT event_id, user_id, CASE WHEN v IS NOT NULL THEN v WHEN pos - fp <= 2 THEN fv END AS value FROM f""")
def q_ffill(spark, d):
    ev = events_with_nulls(Tables(spark, d)).select("event_id", "ts", "user_id", "value")
    return R.ffill(ev, ["value"], _ORDER, by=["user_id"], limit=2).select("event_id", "user_id", "value")


@query("bfill", sql=f"""SELECT event_id, coalesce(v, first_value(v IGNORE NULLS) OVER (ORDER BY ts, event_id
  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS value FROM {_EV}""")
def q_bfill(spark, d):
    ev = events_with_nulls(Tables(spark, d)).select("event_id", "ts", "value")
    return R.bfill(ev, ["value"], _ORDER).select("event_id", "value")


@query("interpolate", sql=f"""
WITH s AS (SELECT *, row_number() OVER {_W_ALL} - 1 AS pos FROM {_EV}),
f AS (SELECT *,
  last_value(v IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS pv,
  last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS pp,
  first_value(v IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
  first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS) OVER (ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
  FROM s)
SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v WHEN pv IS NOT NULL AND nv IS NOT NULL THEN pv + (nv - pv) * (pos - pp) / (np - pp)
  WHEN pv IS NOT NULL THEN pv END, 9) AS value FROM f""")
def q_interpolate(spark, d):
    ev = events_with_nulls(Tables(spark, d)).select("event_id", "ts", "value")
    out = R.interpolate(ev, ["value"], _ORDER)
    return out.select("event_id", F.round("value", 9).alias("value"))


@query("transform", sql="""SELECT l_orderkey, l_linenumber, l_suppkey,
  round(l_extendedprice - avg(l_extendedprice) OVER (PARTITION BY l_suppkey), 6) AS centered,
  count(*) OVER (PARTITION BY l_suppkey) AS n_supp FROM lineitem""")
def q_transform(spark, d):
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    out = R.transform(li, ["l_suppkey"], {"mean_price": F.avg("l_extendedprice"), "n_supp": F.count(F.lit(1))})
    return out.select("l_orderkey", "l_linenumber", "l_suppkey",
                      F.round(F.col("l_extendedprice") - F.col("mean_price"), 6).alias("centered"), "n_supp")


@query("duplicated", sql="""SELECT o_orderkey, o_custkey, o_orderstatus,
  row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) > 1 AS duplicated FROM orders""")
def q_duplicated(spark, d):
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return R.duplicated(o, ["o_custkey", "o_orderstatus"], "first", ["o_orderkey"])


_NULL_PRICE = "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END"


@query("sort_values", sql=f"""SELECT *, row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderdate ASC NULLS LAST, o_orderkey) - 1 AS place
FROM (SELECT * REPLACE ({_NULL_PRICE} AS o_totalprice) FROM orders)""")
def q_sort_values(spark, d):
    o = Tables(spark, d).orders.withColumn("o_totalprice", F.expr(_NULL_PRICE))
    return R.sort_values(o, ["o_totalprice", "o_orderdate", "o_orderkey"], ascending=[False, True, True], position="place")


@query("sort_index", sql="SELECT *, row_number() OVER (ORDER BY c_nationkey, c_custkey) - 1 AS place FROM customer")
def q_sort_index(spark, d):
    return R.sort_index(Tables(spark, d).customer, ["c_nationkey", "c_custkey"], position="place")


@query("nlargest", sql="""WITH v AS (SELECT * REPLACE (CASE WHEN l_quantity > 1 THEN NULL ELSE l_quantity END AS l_quantity) FROM lineitem),
r AS (SELECT *, rank() OVER (ORDER BY l_quantity DESC NULLS LAST) AS rk FROM v)
SELECT * EXCLUDE (rk) FROM r WHERE rk <= (SELECT count(l_quantity) + 1 FROM v)""")
def q_nlargest(spark, d):
    """The n-th row has a null key: all rows with a value and all null rows stay."""
    li = Tables(spark, d).lineitem.withColumn("l_quantity", F.when(F.col("l_quantity") <= 1, F.col("l_quantity")))
    n = li.where("l_quantity is not null").count() + 1
    return R.nlargest(li, n, ["l_quantity"], keep="all")


@query("nsmallest", sql="SELECT * FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10")
def q_nsmallest(spark, d):
    return R.nsmallest(Tables(spark, d).orders, 10, ["o_totalprice"], keep="first", tiebreak=["o_orderkey"])


@query("drop_duplicates", sql="""SELECT * FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def q_drop_duplicates(spark, d):
    return R.drop_duplicates(Tables(spark, d).orders, ["o_custkey"], "first", ["o_orderdate", "o_orderkey"])


@query("set_index", sql="SELECT * FROM orders")
def q_set_index(spark, d):
    return R.set_index(Tables(spark, d).orders, ["o_orderkey"], verify_integrity=True)


@query("reset_index", sql="SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index FROM orders")
def q_reset_index(spark, d):
    return R.reset_index(Tables(spark, d).orders, ["o_orderdate", "o_orderkey"], name="row_index")
