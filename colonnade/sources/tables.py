"""Table sources and sinks.

Sources read parquet with the scan left to Catalyst (column pruning and
filter pushdown reach the file reader).  Sinks write to a fresh path under
the shared checkpoint folder and read the result back, so a query that ends
in a sink is still a lazily evaluated DataFrame over the written files.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from colonnade.session import scratch_path

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table, ``{sf_dir}/{name}.parquet``."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


class Tables:
    """Lazy accessor: ``t = Tables(spark, dir); t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return load(self.spark, self.sf_dir, name)
        raise AttributeError(name)


def to_parquet(df: DataFrame, path: str | None = None, partition_cols=None,
               compression: str = "snappy") -> DataFrame:
    """Write parquet (optionally partitioned) and return the re-read table."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "parquet")
    w = df.write.mode("overwrite").option("compression", compression)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)
    return spark.read.parquet(path)


def to_orc(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ORC and return the re-read table."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "orc")
    df.write.mode("overwrite").orc(path)
    return spark.read.orc(path)


def to_xml(df: DataFrame, path: str | None = None, root_name: str = "data",
           row_name: str = "row", na_rep: str | None = None) -> DataFrame:
    """Write one ``row_name`` element per row under ``root_name`` and read it
    back with the frame's own schema (no inference)."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "xml")
    w = df.write.mode("overwrite").format("xml").option("rootTag", root_name) \
        .option("rowTag", row_name)
    if na_rep is not None:
        w = w.option("nullValue", na_rep)
    w.save(path)
    r = spark.read.format("xml").option("rowTag", row_name).schema(df.schema)
    if na_rep is not None:
        r = r.option("nullValue", na_rep)
    return r.load(path)


def to_json_lines(df: DataFrame, path: str | None = None, partition_cols=None) -> DataFrame:
    """Write JSON lines (optionally partitioned) and read back with the schema."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "json")
    w = df.write.mode("overwrite")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.json(path)
    schema = df.schema
    if partition_cols:
        schema = T.StructType([f for f in schema.fields if f.name not in partition_cols]
                              + [schema[c] for c in partition_cols])
    return spark.read.schema(schema).json(path)
