"""Streaming jobs.

* ``resample_stream``: event-time buckets with a watermark; each closed
  bucket is appended once to a parquet sink (exactly-once file sink with a
  checkpoint in the shared folder, so a restarted query resumes).
* ``partial_fit_stream``: incremental standard-scaler state.  Every
  micro-batch computes its (n, mean, M2) per column and merges them into the
  running state with the parallel-variance formula; the state is a small
  table, one folder per batch number under the shared checkpoint folder, so a
  replayed batch replaces its own state and never counts twice.

Both finish with ``trigger(availableNow=True)``, so a test or a scheduled
run processes everything present and stops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colonnade.session import scratch_path


def file_stream(spark: SparkSession, directory: str, name: str, schema: T.StructType,
                max_files_per_trigger: int = 1) -> DataFrame:
    """A streaming read of ``{directory}/{name}.parquet`` files (one test table)."""
    return (spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(directory))


def resample_stream(stream: DataFrame, ts: str, every: str, aggs: dict[str, Column], watermark: str,
                    out_path: str | None = None) -> tuple[str, DataFrame]:
    """Append-mode bucket aggregates (a bucket is emitted once the watermark
    passes its end).  Returns (sink path, batch reader of the sink)."""
    spark = stream.sparkSession
    out_path = out_path or scratch_path(spark, "resample_stream")
    ntz = isinstance(stream.schema[ts].dataType, T.TimestampNTZType)
    if ntz:
        # watermarks need zoned timestamps; the bucket goes back to naive time
        stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    bucket = F.col("w.start").cast("timestamp_ntz") if ntz else F.col("w.start")
    agg = stream.withWatermark(ts, watermark).groupBy(F.window(ts, every).alias("w")) \
        .agg(*[c.alias(n) for n, c in aggs.items()]) \
        .select(bucket.alias("bucket"), *aggs)
    q = (agg.writeStream.outputMode("append").format("parquet")
         .option("checkpointLocation", out_path + "_ckpt").option("path", out_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path, spark.read.parquet(out_path)


def partial_fit_stream(stream: DataFrame, cols: Sequence[str], state_path: str | None = None) -> DataFrame:
    """Run the incremental scaler over a stream; returns the final state
    (one row per column: n, mean, var (population))."""
    spark = stream.sparkSession
    state_path = state_path or scratch_path(spark, "scaler_state")
    cols = list(cols)

    def merge(batch: DataFrame, epoch: int) -> None:
        b = batch.agg(*[F.struct(F.count(c).cast("double").alias("n"), F.avg(c).alias("mean"),
                                 (F.var_pop(c) * F.count(c)).alias("m2")).alias(c) for c in cols]).first()
        prev = {r["column"]: r for r in _read_state(spark, state_path, epoch)}
        rows = []
        for c in cols:
            nb, mb, m2b = b[c]["n"] or 0.0, b[c]["mean"], b[c]["m2"]
            if c in prev and prev[c]["n"]:
                na, ma, m2a = prev[c]["n"], prev[c]["mean"], prev[c]["m2"]
                if nb:
                    n = na + nb
                    delta = mb - ma
                    ma, m2a, na = ma + delta * nb / n, m2a + m2b + delta * delta * na * nb / n, n
                rows.append((c, na, ma, m2a))
            else:
                rows.append((c, nb, mb, m2b if nb else None))
        # one folder per batch: a batch that runs again starts from the batch before it and writes the same state
        spark.createDataFrame(rows, "column string, n double, mean double, m2 double") \
            .write.mode("overwrite").parquet(f"{state_path}/batch={epoch}")

    q = (stream.select(*cols).writeStream.foreachBatch(merge)
         .option("checkpointLocation", state_path + "_ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    st = spark.createDataFrame(_read_state(spark, state_path, None), "column string, n double, mean double, m2 double")
    return st.select("column", F.col("n").cast("long").alias("n"), "mean", (F.col("m2") / F.col("n")).alias("var"))


def _read_state(spark: SparkSession, path: str, before: int | None) -> list:
    """The state rows (one per column) of the last complete batch lower than ``before`` (any batch for None); empty when
    there is none.  A folder counts once its writer committed it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    done = []
    for f in fs.listStatus(folder):
        name = f.getPath().getName()
        if name.startswith("batch=") and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")):
            done.append(int(name[6:]))
    done = [n for n in done if before is None or n < before]
    return spark.read.parquet(f"{path}/batch={max(done)}").collect() if done else []
