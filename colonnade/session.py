"""Session helpers: local sessions for tests/bench and the shared scratch folder."""

from __future__ import annotations

import contextlib
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "colonnade") -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; where it is unset, the
    warehouse folder serves, which all executors share as well.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf:
        conf = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/colonnade-scratch"
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex}")
    _WRITTEN.append(path)
    return path


_WRITTEN: list[str] = []  # scratch paths of this process, oldest first


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables this process has written so far and return their number.  Call it when the results
    built on them have been consumed."""
    n = 0
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return n


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage with a table written under the shared checkpoint folder
    (reliable storage: survives executor loss).  One write job, then a
    plain parquet scan; unlike ``Dataset.checkpoint`` the input is computed
    only once."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with held_conf(spark, SHUFFLE_CLEANUP, "true"):
        df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._scratch = path
    return out


#: Spark removes a query's shuffle files when the query ends; what it wrote replaces them.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of a batch that goes to Python and back.
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def held_conf(spark: SparkSession, key: str, value: str):
    """Inside, the session's setting ``key`` is ``value``."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: Up to this size Spark broadcasts one side of a join. It goes by encoded files; the relation that the driver builds is several times as large.
BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


def least_broadcast(spark: SparkSession, most: int) -> str:
    """The session's broadcast threshold, ``most`` bytes where it is larger (a threshold that forbids broadcasts stays)."""
    return str(min(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold(), most))


def release(df: DataFrame) -> None:
    """Delete the scratch table behind a result of ``materialize`` that nothing will read any more."""
    path = getattr(df, "_scratch", None)
    if path in _WRITTEN:
        _WRITTEN.remove(path)
        spark = df.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize_with(df: DataFrame, name: str = "stage", **metrics: Column) -> tuple[DataFrame, dict]:
    """``materialize``, and aggregates of the written rows (at least their number ``rows``)."""
    out = materialize(df, name)
    return out, out.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in metrics.items()]).first().asDict()
