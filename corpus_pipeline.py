"""The corpus pipeline: toxicity filter, exact dedup, near dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents that stay, with all their columns; the last
returns the pieces of the packed sequences. ``run`` writes every stage as Parquet under the shared checkpoint
folder and reads it again as the next stage's input, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from colonnade.llm import chosen_path, cost_packing, decontaminate, fuse_dedup, ordinal_toxicity, tokens
from colonnade.session import materialize
from colonnade.sources.tables import load


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression rejects go."""
    return ordinal_toxicity.drop_toxic(docs, load(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays."""
    return fuse_dedup.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the row with the smallest doc_id stays."""
    return chosen_path.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens of the documents that are left."""
    return cost_packing.pack(docs, tokens.vocabulary_path(), 2048, end_id=1)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

#: No SQL: the fitted regression and the tokenizer have none. tests/llm checks run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
