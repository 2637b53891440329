"""Words that few labelled texts hold take part in the toxicity fit."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from colonnade.llm import ordinal_toxicity


def test_rare_toxic_words_get_weights(spark):
    rare = [f"rareword{k}" for k in range(6)]
    at = F.col("id") % 10 == 0  # toxic rows
    word = F.when(F.col("id") < 360, F.concat(F.lit(" rareword"), (F.col("id") / 60).cast("int").cast("string"))).otherwise("")
    rows = spark.range(16_000).select(
        F.col("id").alias("doc_id"), at.cast("int").alias("toxic"),
        F.concat(F.lit("plain text number "), F.col("id").cast("string"), F.when(at, F.concat(F.lit(" nasty"), word)).otherwise(" kind")).alias("text"))
    model = ordinal_toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"))
    wanted = ordinal_toxicity.word_hashes(pa.array([" ".join(rare)]))[1]
    assert np.isin(wanted, model.words).all()
