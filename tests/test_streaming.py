"""Streaming forms agree with the batch functions after availableNow."""

from pyspark.sql import functions as F

from colonnade.ml import features as FT
from colonnade.session import scratch_path
from colonnade.operators import timeseries as TS
from colonnade.sources.tables import Tables
from colonnade.streaming import jobs as S
from tests.conftest import SF_SMALL


def _split_events(spark):
    ev = Tables(spark, SF_SMALL).events
    d = scratch_path(spark, "stream-source")
    # four files written in time order (the stream source reads by file age)
    bounds = ev.agg(F.min("ts"), F.max("ts")).first()
    lo, hi = bounds[0], bounds[1]
    step = (hi - lo) / 4
    for i in range(4):
        a, b = lo + step * i, (lo + step * (i + 1) if i < 3 else hi)
        cond = (F.col("ts") >= F.lit(a)) & ((F.col("ts") < F.lit(b)) if i < 3 else (F.col("ts") <= F.lit(b)))
        ev.where(cond).coalesce(1).write.mode("append").parquet(d + "/events.parquet")
    return ev, d


def test_resample_stream_matches_batch(spark):
    ev, d = _split_events(spark)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(d + "/events.parquet")
    _, out = S.resample_stream(stream, "ts", "1 day", {"n": F.count(F.lit(1)), "total": F.sum("value")}, "1 hour")
    batch = TS.resample(ev, "ts", "1 day", [F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")],
                        fill_empty=False)
    got = {r["bucket"]: (r["n"], round(r["total"], 6)) for r in out.collect()}
    want = {r["bucket"]: (r["n"], round(r["total"], 6)) for r in batch.collect()}
    assert got and all(want[b] == v for b, v in got.items())
    # only buckets the watermark has not closed yet may be missing
    assert len(want) - len(got) <= 1


def test_partial_fit_stream_matches_batch(spark):
    ev, d = _split_events(spark)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(d + "/events.parquet")
    st = {r["column"]: r for r in S.partial_fit_stream(stream, ["value", "user_id"]).collect()}
    ref = FT.fit_std_scaler(ev, ["value", "user_id"])
    for c in ("value", "user_id"):
        assert st[c]["n"] == ref.n[c]
        assert abs(st[c]["mean"] - ref.mean[c]) < 1e-9
        assert abs(st[c]["var"] - ref.var[c]) < 1e-6


def _state(spark, path):
    return {r["column"]: (r["n"], r["mean"], r["m2"]) for r in S._read_state(spark, path, None)}


def test_replayed_batch_counts_once(spark):
    """A batch that runs again (its output was written, its commit was not) leaves the same state; one that failed before
    its state was written starts from the batch before it."""
    ev, d = _split_events(spark)
    path = scratch_path(spark, "scaler")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(d + "/events.parquet")
    S.partial_fit_stream(stream, ["value"], path)
    want = _state(spark, path)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def remove(p):
        p = jvm.org.apache.hadoop.fs.Path(p)
        assert p.getFileSystem(conf).delete(p, True)

    remove(f"{path}_ckpt/commits/3")  # the last batch is not committed: it runs again over its own state
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(d + "/events.parquet")
    S.partial_fit_stream(stream, ["value"], path)
    assert _state(spark, path) == want
    remove(f"{path}_ckpt/commits/3")
    remove(f"{path}/batch=3")  # as after a crash between the batch and its state
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(d + "/events.parquet")
    S.partial_fit_stream(stream, ["value"], path)
    assert _state(spark, path) == want
