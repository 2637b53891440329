"""2.10 Time series."""

from pyspark.sql import functions as F

from colonnade.catalog import query
from colonnade.operators import timeseries as TS
from colonnade.sources.tables import Tables


@query("resample", sql="""
WITH b AS (SELECT time_bucket(INTERVAL 10 MINUTES, ts) AS bucket, count(*) AS n, round(sum(value), 2) AS total
           FROM events GROUP BY 1),
cal AS (SELECT unnest(generate_series(min(bucket), max(bucket), INTERVAL 10 MINUTES)) AS bucket FROM b)
SELECT bucket, coalesce(n, 0) AS n, total FROM cal LEFT JOIN b USING (bucket)""")
def q_resample(spark, d):
    ev = Tables(spark, d).events
    return TS.resample(ev, "ts", "10 minutes", [F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")],
                       count_cols=["n"])


@query("asfreq", sql="""
WITH g AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM events)
SELECT g.ts, e.value, e.user_id FROM g ASOF LEFT JOIN events e ON g.ts >= e.ts""")
def q_asfreq(spark, d):
    return TS.asfreq(Tables(spark, d).events, "ts", "1 hour", ["value", "user_id"], method="ffill")


@query("to_period", sql="""SELECT o_orderkey, date_trunc('month', o_orderdate) AS month_start,
  strftime(o_orderdate, '%Y-%m') AS month, CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
  date_trunc('week', o_orderdate) AS week_start FROM orders""")
def q_to_period(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", TS.to_period("o_orderdate", "M").alias("month_start"),
                    TS.period_label("o_orderdate", "M").alias("month"), TS.period_label("o_orderdate", "Q").alias("quarter"),
                    TS.to_period("o_orderdate", "W").alias("week_start"))


@query("to_timestamp", sql="""SELECT o_orderkey, date_trunc('quarter', o_orderdate) AS q_start,
  date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 MICROSECOND AS q_end,
  date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 MICROSECOND AS m_end FROM orders""")
def q_to_timestamp(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", TS.to_timestamp("o_orderdate", "Q", "start").alias("q_start"),
                    TS.to_timestamp("o_orderdate", "Q", "end").alias("q_end"),
                    TS.to_timestamp("o_orderdate", "M", "end").alias("m_end"))
